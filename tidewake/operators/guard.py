"""The range guard: impossible values go before arbitration, and are counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive bounds by field, as results must have them. Fields
# that are not named pass: raw counts and set points have no physical bound.
BEARING = (0.0, 360.0)
BEARINGS = (
    "rmc_true_course",
    "vtg_true_track",
    "hdm_heading",
    "hdg_heading",
    "mwd_direction_magnetic",
    "n2k_cog",
    "n2k_heading_magnetic",
    "n2k_set",
    "n2k_windangle_magnetic_ground_referenced_to_magnetic_north",
)
#: Wide enough for either convention of a relative angle.
RELATIVE = (-180.0, 360.0)
RELATIVES = ("mwv_wind_angle_r", "mwv_wind_angle_t", "n2k_windangle_apparent", "n2k_windangle_true_boat_referenced")
OTHERS = {
    "rmc_latitude": (-90.0, 90.0),
    "gll_latitude": (-90.0, 90.0),
    "n2k_latitude": (-90.0, 90.0),
    "rmc_longitude": (-180.0, 180.0),
    "gll_longitude": (-180.0, 180.0),
    "n2k_longitude": (-180.0, 180.0),
    "xdr_m5_heel": (-90.0, 90.0),
    "xdr_roll": (-90.0, 90.0),
    "n2k_roll": (-90.0, 90.0),
    "xdr_m5_pitch": (-90.0, 90.0),
    "xdr_pitch": (-90.0, 90.0),
    "n2k_pitch": (-90.0, 90.0),
    "mda_water_temp": (0.0, 40.0),
    "n2k_actualtemperature_0_sea_temperature": (0.0, 40.0),
    "n2k_temperature_0_sea_temperature": (0.0, 40.0),
    "n2k_watertemperature": (0.0, 40.0),
    "n2k_outsideambientairtemperature": (-30.0, 60.0),
    "mwv_wind_speed_r": (0.0, 100.0),
    "mwv_wind_speed_t": (0.0, 100.0),
    "n2k_windspeed_apparent": (0.0, 100.0),
    "n2k_windspeed_true_boat_referenced": (0.0, 100.0),
}
RANGES: dict[str, tuple[float, float]] = dict.fromkeys(BEARINGS, BEARING) | dict.fromkeys(RELATIVES, RELATIVE) | OTHERS


def in_range(field: Column, value: Column, ranges: dict[str, tuple[float, float]] | None = None) -> Column:
    """True where the value is possible, or nothing is known of the field; NaN fails a bound."""
    ranges = RANGES if ranges is None else ranges
    if not ranges:
        return F.lit(True)
    bounds = F.create_map(*(x for name, (low, high) in ranges.items() for x in (F.lit(name), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")))))
    own = F.try_element_at(bounds, field)
    return own.isNull() | (F.coalesce(value >= own.low, F.lit(False)) & F.coalesce(value <= own.high, F.lit(False)) & ~F.coalesce(F.isnan(value), F.lit(False)))


def guard(samples: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The possible samples."""
    return samples.where(in_range(F.col("field"), F.col("value"), ranges))


def guard_counts(samples: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """One row: samples seen, and dropped as out of range."""
    return samples.agg(F.count("*").alias("seen"), F.count_if(~in_range(F.col("field"), F.col("value"), ranges)).alias("dropped"))
