"""The metrics view: instruments resolved by preference, calibrated and labelled.

A lazy DataFrame: a bound on ts goes down to the scan of the wide table through
the projections and left joins above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures
from ..operators import joins

# Quantity -> sources in order of preference; the first that is not null counts.
CHAINS: dict[str, tuple[str, ...]] = {
    "awa": ("n2k_windangle_apparent", "mwv_wind_angle_r"),
    "awa_raw": ("n2k_bandg_raw_wind_a", "xdr_raw_wind_a"),
    "aws": ("n2k_windspeed_apparent", "mwv_wind_speed_r"),
    "aws_raw": ("n2k_bandg_raw_wind_s", "xdr_raw_wind_s"),
    "twa": ("n2k_windangle_true_boat_referenced", "mwv_wind_angle_t"),
    "tws": ("n2k_windspeed_true_boat_referenced", "mwv_wind_speed_t"),
    "twd": ("n2k_windangle_magnetic_ground_referenced_to_magnetic_north", "mwd_direction_magnetic"),
    "tws_ground": ("n2k_windspeed_magnetic_ground_referenced_to_magnetic_north",),
    "stw": ("n2k_speedwaterreferenced", "vhw_water_speed_knots"),
    "stw_raw": ("xdr_raw_bsp",),
    "log_total": ("n2k_log",),
    "log_trip": ("n2k_triplog",),
    "sog": ("n2k_sog", "rmc_spd_over_grnd", "vtg_spd_over_grnd_kts"),
    "cog": ("n2k_cog", "rmc_true_course", "vtg_true_track"),
    "hdg": ("n2k_heading_magnetic", "hdg_heading", "hdm_heading"),
    "hdg_raw": ("n2k_bandg_raw_heading",),
    "heel": ("n2k_roll", "xdr_roll", "xdr_m5_heel"),
    "pitch": ("n2k_pitch", "xdr_pitch", "xdr_m5_pitch"),
    "rot": ("n2k_rate", "rot_rate_of_turn"),
    "rudder": ("n2k_position_0", "rsa_rsa_starboard"),
    "lat": ("n2k_latitude", "rmc_latitude", "gll_latitude"),
    "lon": ("n2k_longitude", "rmc_longitude", "gll_longitude"),
    "depth": ("n2k_depth", "dbt_depth_meters"),
    "temp_sea": ("n2k_actualtemperature_0_sea_temperature", "mda_water_temp"),
    "temp_air": ("n2k_actualtemperature_0_outside_temperature",),
    "pressure": ("n2k_pressure_0_atmospheric",),
    "batt_v": ("n2k_voltage_0", "xdr_battv"),
    "gps_time": ("n2k_gps_time", "n2k_gps_time_gps", "rmc_gps_time"),
    "gnss_hdop": ("n2k_hdop",),
    "gnss_sats": ("n2k_numberofsvs",),
    "gnss_method_code": ("n2k_method_code",),
    "gnss_integrity_code": ("n2k_integrity_code",),
    "gnss_type_code": ("n2k_gnsstype_code",),
    "bus_set": ("n2k_set",),
    "bus_drift": ("n2k_drift",),
    "bus_variation": ("n2k_variation_magnetic", "n2k_variation_wmm_2020"),
    "bus_leeway": ("n2k_leewayangle",),
}
CODES = ("gnss_method_code", "gnss_integrity_code", "gnss_type_code")
#: The calibration that scales speed through water.
SPEED_FACTOR = "man_bsp_adj"


def code(x: str) -> str:
    """SQL of a number as a code."""
    return f"CAST(bround({x}) AS INT)"


def resolve(table: DataFrame, chains: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """ts and one column a quantity: the first of its sources that is not null; columns that the table does not have count as null."""
    chains, have = CHAINS if chains is None else chains, set(table.columns)
    first = lambda chain: f"coalesce({', '.join([*(f'`{c}`' for c in chain if c in have), 'CAST(NULL AS DOUBLE)'])})"
    return table.selectExpr("ts", *(f"{code(first(c)) if q in CODES else first(c)} AS {q}" for q, c in chains.items()))


def define_view(name: str, table: DataFrame, calibrations: DataFrame, sessions: DataFrame, segments: DataFrame) -> None:
    """The view under a name in SQL; it is computed where it is read, with the bounds that are asked for."""
    metrics(table, calibrations, sessions, segments).createOrReplaceTempView(name)


def metrics(table: DataFrame, calibrations: DataFrame, sessions: DataFrame, segments: DataFrame) -> DataFrame:
    """The view. calibrations: cal_id, effective_from, param_name, param_value; sessions: session_id, name, type, t_start,
    t_end; segments: seg_id, session_id, no, leg_type, mainsail, headsail, t_start, t_end."""
    base = resolve(table)
    factors = calibrations.where(F.col("param_name") == SPEED_FACTOR).select("cal_id", "effective_from", "param_value")
    out = joins.asof(base, factors).withColumnsRenamed({"param_value": SPEED_FACTOR, "effective_from": "cal_effective_from"})
    out = out.withColumn("adj_stw", measures.adjusted_speed(F.col("stw"), F.col(SPEED_FACTOR)))
    out = out.withColumn("corrected_stw", measures.corrected_speed(F.col("adj_stw"), F.col("heel")))
    out = out.withColumn("leeway", measures.leeway(F.col("heel"), F.col("corrected_stw")))
    s = sessions.select("session_id", F.col("name").alias("session_name"), F.col("type").alias("session_type"), "t_start", "t_end")
    out = joins.interval_join(out, s, open_to_now=True).drop("t_start", "t_end")
    g = segments.select("seg_id", "session_id", F.col("no").alias("leg_no"), "leg_type", "mainsail", "headsail", "t_start", "t_end")
    out = joins.equi_range_join(out, g, ["session_id"])
    labels = ["session_id", "session_name", "session_type", "seg_id", "leg_no", "leg_type", "mainsail", "headsail"]
    return out.select("ts", *CHAINS, SPEED_FACTOR, "cal_effective_from", "cal_id", "adj_stw", *labels, "corrected_stw", "leeway")
