"""Joins, models, resampling and clock checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures
from ..operators import joins, resample
from ..plans import metrics as view
from .tables import events, plain, registered, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

CALS = "cals AS (SELECT event_id AS cal_id, date_trunc('day', ts) AS effective_from, 1 + value / 10000 AS param_value FROM events)"
SPANS = f"{CALS}, spans AS (SELECT *, lead(effective_from) OVER (ORDER BY effective_from, cal_id) AS effective_to FROM cals)"
SESSIONS = """sessions AS (SELECT CAST(day(d) AS BIGINT) AS session_id, 'session ' || day(d) AS name, CASE WHEN day(d) % 2 = 0 THEN 'race' ELSE 'training' END AS type,
  d + INTERVAL 8 HOUR AS t_start, CASE WHEN day(d) % 10 <> 0 THEN d + INTERVAL 18 HOUR END AS t_end FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM events) WHERE day(d) % 3 <> 0)"""


def calibrations(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select(F.col("event_id").alias("cal_id"), F.date_trunc("day", "ts").alias("effective_from"), (1 + F.col("value") / 10000).alias("param_value"))


def sessions(spark: SparkSession, d: str) -> DataFrame:
    day = events(spark, d).select(F.date_trunc("day", "ts").alias("d")).distinct().where(F.dayofmonth("d") % 3 != 0)
    n = F.dayofmonth("d")
    end = F.when(n % 10 != 0, F.expr("d + interval 18 hours"))
    return day.select(n.cast("long").alias("session_id"), F.concat(F.lit("session "), n).alias("name"), F.when(n % 2 == 0, "race").otherwise("training").alias("type"), F.expr("d + interval 8 hours").alias("t_start"), end.alias("t_end"))


@registered(QUERIES, ORACLES, f"WITH {SPANS} SELECT * FROM spans")
def lead_spans(spark: SparkSession, d: str) -> DataFrame:
    s = joins.spans(calibrations(spark, d))
    return s.withColumns({c: plain(c) for c in ("effective_from", "effective_to")})


ASOF = f"""WITH {SPANS} SELECT e.event_id, c.cal_id, c.effective_from, c.param_value FROM events e
LEFT JOIN spans c ON e.ts >= c.effective_from AND (c.effective_to IS NULL OR e.ts < c.effective_to)"""


@registered(QUERIES, ORACLES, ASOF)
def asof_calibration(spark: SparkSession, d: str) -> DataFrame:
    out = joins.asof(events(spark, d).select("event_id", "ts"), calibrations(spark, d))
    return out.select("event_id", "cal_id", plain("effective_from").alias("effective_from"), "param_value")


@registered(QUERIES, ORACLES, ASOF)
def asof_calibration_union(spark: SparkSession, d: str) -> DataFrame:
    """The way for dimensions with many rows an hour."""
    out = joins.asof_union(events(spark, d).select("event_id", "ts"), calibrations(spark, d))
    return out.select("event_id", "cal_id", plain("effective_from").alias("effective_from"), "param_value")


# Every order as a calibration, and line items as facts by their ship date.
ORDER_CALS = "cals AS (SELECT o_orderkey AS cal_id, o_orderdate AS effective_from, 1 + o_totalprice / 1000000 AS param_value FROM orders)"


def order_calibrations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("cal_id"), F.col("o_orderdate").alias("effective_from"), (1 + F.col("o_totalprice") / 1000000).alias("param_value"))


def shipped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"))


@registered(QUERIES, ORACLES, f"WITH {ORDER_CALS} SELECT *, lead(effective_from) OVER (ORDER BY effective_from, cal_id) AS effective_to FROM cals")
def lead_spans_orders(spark: SparkSession, d: str) -> DataFrame:
    """lead_spans over a whole table."""
    return joins.spans(order_calibrations(spark, d))


# In force is the last start, and of equal starts the greatest id.
ASOF_ORDERS = f"""WITH {ORDER_CALS}, last AS (SELECT * FROM cals QUALIFY row_number() OVER (PARTITION BY effective_from ORDER BY cal_id DESC) = 1)
SELECT l.l_orderkey, l.l_linenumber, c.cal_id, c.effective_from, c.param_value FROM lineitem l ASOF LEFT JOIN last c ON l.l_shipdate >= c.effective_from"""


@registered(QUERIES, ORACLES, ASOF_ORDERS)
def asof_calibration_orders(spark: SparkSession, d: str) -> DataFrame:
    """asof_calibration with a whole table as calibrations."""
    return joins.asof(shipped(spark, d), order_calibrations(spark, d)).select("l_orderkey", "l_linenumber", "cal_id", "effective_from", "param_value")


@registered(QUERIES, ORACLES, ASOF_ORDERS)
def asof_calibration_orders_union(spark: SparkSession, d: str) -> DataFrame:
    return joins.asof_union(shipped(spark, d), order_calibrations(spark, d)).select("l_orderkey", "l_linenumber", "cal_id", "effective_from", "param_value")


IN_SESSION = f"""WITH {SESSIONS} SELECT e.event_id, s.session_id, s.name, s.type FROM events e
LEFT JOIN sessions s ON e.ts >= s.t_start AND e.ts < coalesce(s.t_end, TIMESTAMP '2100-01-01')"""


@registered(QUERIES, ORACLES, IN_SESSION)
def interval_session(spark: SparkSession, d: str) -> DataFrame:
    return joins.interval_join(events(spark, d), sessions(spark, d), open_to_now=True).select("event_id", "session_id", "name", "type")


@registered(QUERIES, ORACLES, IN_SESSION.replace("TIMESTAMP '2100-01-01'", "TIMESTAMP '2024-02-15'"))
def interval_session_binned(spark: SparkSession, d: str) -> DataFrame:
    """The same with an end for all ranges, in bins of a day."""
    s = sessions(spark, d).withColumn("t_end", F.coalesce("t_end", F.lit("2024-02-15").cast("timestamp")))
    return joins.interval_join(events(spark, d), s, bin_seconds=86_400).select("event_id", "session_id", "name", "type")


@registered(QUERIES, ORACLES, """WITH r AS (SELECT s_suppkey, TIMESTAMP '2024-01-30' - to_minutes(CAST(s_suppkey * 7919 % 43200 AS INT)) - to_minutes(CAST(CASE WHEN s_suppkey % 22 > 15 THEN 1 << (s_suppkey % 22) ELSE 0 END AS INT)) AS a,
  1 << (s_suppkey % 22) AS n FROM supplier),
s AS (SELECT s_suppkey, a AS t_start, CASE WHEN s_suppkey % 50 = 0 THEN TIMESTAMP '2100-01-01' ELSE a + to_minutes(CAST(n AS INT)) END AS t_end FROM r)
SELECT s_suppkey, count(*) AS events, CAST(sum(event_id) AS BIGINT) AS ids FROM events e LEFT JOIN s ON e.ts >= s.t_start AND e.ts < s.t_end GROUP BY s_suppkey""")
def interval_long(spark: SparkSession, d: str) -> DataFrame:
    """Events in ranges of a minute to four years, some of them still open, one for each supplier."""
    k = F.col("s_suppkey")
    minutes = F.expr("shiftleft(1, cast(s_suppkey % 22 as int))")
    begin = F.lit("2024-01-30").cast("timestamp") - F.make_dt_interval(mins=(k * 7919 % 43200).cast("int")) - F.make_dt_interval(mins=F.when(k % 22 > 15, minutes).otherwise(0))
    ranges = table(spark, d, "supplier").select(k, begin.alias("t_start")).withColumn("t_end", F.when(k % 50 != 0, F.col("t_start") + F.make_dt_interval(mins=minutes)))
    totals = joins.interval_totals(events(spark, d).select("event_id", "ts"), ranges, ["s_suppkey"], "event_id", open_to_now=True)
    return totals.withColumnsRenamed({"n": "events", "total": "ids"})


@registered(QUERIES, ORACLES, """SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, o.o_orderpriority FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_shipdate >= o.o_orderdate AND l.l_shipdate < CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_orderdate + INTERVAL 60 DAY END""")
def equi_range_leg(spark: SparkSession, d: str) -> DataFrame:
    legs = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("t_start"), F.when(F.col("o_orderkey") % 7 != 0, F.expr("o_orderdate + interval 60 days")).alias("t_end"), "o_custkey", "o_orderpriority")
    facts = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_shipdate")
    return joins.equi_range_join(facts, legs, ["key"], ts="l_shipdate").select(F.col("key").alias("l_orderkey"), "l_linenumber", "o_custkey", "o_orderpriority")


# Line items as speeds and heels, with nulls.
BOAT = """boat AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 11 <> 0 THEN l_quantity / 4 END AS stw, CASE WHEN l_orderkey % 13 <> 0 THEN round(l_discount * 200, 0) - 10 END AS heel,
  CASE WHEN l_linenumber % 3 = 0 THEN 1 + l_tax END AS factor FROM lineitem), adj AS (SELECT *, stw * coalesce(factor, 1.0) AS adj_stw FROM boat)"""
CORRECTED = """corr AS (SELECT *, abs(adj_stw) AS v, abs(adj_stw) + 2.2162 * (1 - exp(-least(abs(adj_stw) / 0.5, 700))) / (1 + exp(least(abs(adj_stw) / 1.2698, 700)))
  - (CASE WHEN heel < 0 THEN 0.1294 ELSE 0.1166 END) * pow(least(abs(coalesce(heel, 0)), 30) / 20.0, 2) * (1 - exp(-least(abs(adj_stw) / 1.0, 700))) AS corrected_stw FROM adj)"""


def boat(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("l_orderkey")
    out = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(key % 11 != 0, F.col("l_quantity") / 4).alias("stw"), F.when(key % 13 != 0, F.round(F.col("l_discount") * 200, 0) - 10).alias("heel"),
        F.when(F.col("l_linenumber") % 3 == 0, 1 + F.col("l_tax")).alias("factor"),
    )
    return out.withColumn("adj_stw", measures.adjusted_speed(F.col("stw"), F.col("factor")))


@registered(QUERIES, ORACLES, f"WITH {BOAT} SELECT l_orderkey, l_linenumber, round(adj_stw, 6) AS adj_stw FROM adj")
def lateral_adj_stw(spark: SparkSession, d: str) -> DataFrame:
    return boat(spark, d).select("l_orderkey", "l_linenumber", F.round("adj_stw", 6).alias("adj_stw"))


@registered(QUERIES, ORACLES, f"WITH {BOAT}, {CORRECTED} SELECT l_orderkey, l_linenumber, round(corrected_stw, 6) AS corrected_stw FROM corr")
def corrected_stw(spark: SparkSession, d: str) -> DataFrame:
    b = boat(spark, d)
    return b.select("l_orderkey", "l_linenumber", F.round(measures.corrected_speed(F.col("adj_stw"), F.col("heel")), 6).alias("corrected_stw"))


@registered(QUERIES, ORACLES, f"""WITH {BOAT}, {CORRECTED} SELECT l_orderkey, l_linenumber,
round(sign(heel) * least(8.080 * abs(heel) / pow(greatest(corrected_stw, 1.0), 2), 15) + 0 * corrected_stw, 6) AS leeway FROM corr""")
def leeway(spark: SparkSession, d: str) -> DataFrame:
    b = boat(spark, d).withColumn("c", measures.corrected_speed(F.col("adj_stw"), F.col("heel")))
    return b.select("l_orderkey", "l_linenumber", F.round(measures.leeway(F.col("heel"), F.col("c")), 6).alias("leeway"))


WIDE = """wide AS (SELECT ts, event_id, CASE WHEN event_id % 2 = 0 THEN value END AS n2k_sog, CASE WHEN event_id % 3 = 0 THEN value + 1 END AS rmc_spd_over_grnd, value + 2 AS vtg_spd_over_grnd_kts,
  CASE WHEN event_id % 5 = 0 THEN (value * 7) % 360 END AS n2k_cog, (value * 11) % 360 AS rmc_true_course, CASE WHEN event_id % 4 <> 0 THEN value / 30 END AS n2k_speedwaterreferenced,
  CASE WHEN event_id % 7 <> 0 THEN (value * 3) % 40 - 20 END AS xdr_roll, CASE WHEN event_id % 6 = 0 THEN CAST(user_id % 4 AS DOUBLE) END AS n2k_method_code FROM events)"""


def wide(spark: SparkSession, d: str) -> DataFrame:
    e, k, v = events(spark, d), F.col("event_id"), F.col("value")
    return e.select(
        "ts", "event_id", F.when(k % 2 == 0, v).alias("n2k_sog"), F.when(k % 3 == 0, v + 1).alias("rmc_spd_over_grnd"), (v + 2).alias("vtg_spd_over_grnd_kts"),
        F.when(k % 5 == 0, (v * 7) % 360).alias("n2k_cog"), ((v * 11) % 360).alias("rmc_true_course"), F.when(k % 4 != 0, v / 30).alias("n2k_speedwaterreferenced"),
        F.when(k % 7 != 0, (v * 3) % 40 - 20).alias("xdr_roll"), F.when(k % 6 == 0, (F.col("user_id") % 4).cast("double")).alias("n2k_method_code"),
    )


RESOLVED = f"""{WIDE}, r AS (SELECT ts, event_id, coalesce(n2k_sog, rmc_spd_over_grnd, vtg_spd_over_grnd_kts) AS sog, coalesce(n2k_cog, rmc_true_course) AS cog,
  n2k_speedwaterreferenced AS stw, xdr_roll AS heel, CAST(n2k_method_code AS INT) AS gnss_method_code FROM wide)"""


#: All sources of all quantities, one after another; source k is null where the event's number plus k is no multiple of k % 3 + 1.
SOURCES = [c for chain in view.CHAINS.values() for c in chain]


def source_sql(c: str) -> str:
    k = SOURCES.index(c)
    return f"CASE WHEN (event_id + {k}) % {k % 3 + 1} = 0 THEN event_id % 1000 + {k} END"


def chain_sql(quantity: str, chain: tuple[str, ...]) -> str:
    found = f"coalesce({', '.join(source_sql(c) for c in chain)}, NULL)"
    return f"CAST({found} AS {'INT' if quantity in view.CODES else 'DOUBLE'}) AS {quantity}"


@registered(QUERIES, ORACLES, "SELECT event_id, " + ", ".join(chain_sql(q, c) for q, c in view.CHAINS.items()) + " FROM events")
def resolve_chains(spark: SparkSession, d: str) -> DataFrame:
    """Every quantity of the view by its order of preference."""
    k = F.col("event_id")
    sources = {c: F.when((k + n) % (n % 3 + 1) == 0, (k % 1000 + n).cast("double")) for n, c in enumerate(SOURCES)}
    # The event's number goes through in the place of the time.
    table_ = events(spark, d).select(k.alias("ts"), *(x.alias(c) for c, x in sources.items()))
    return view.resolve(table_).withColumnRenamed("ts", "event_id")


@registered(QUERIES, ORACLES, "SELECT event_id, CAST(user_id % 4 AS INT) AS gnss_method_code FROM events")
def gnss_codes(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return e.selectExpr("event_id", f"{view.code('CAST(user_id % 4 AS DOUBLE)')} AS gnss_method_code")


CALIBRATED = f"""WITH {RESOLVED}, {SPANS}, {SESSIONS}, legs AS (SELECT session_id * 10 + n AS seg_id, session_id, CAST(n AS INT) AS no, 'leg ' || n AS leg_type, t_start + n * INTERVAL 2 HOUR AS t0, t_start + (n + 1) * INTERVAL 2 HOUR AS t1
  FROM sessions, range(4) x(n)), a AS (SELECT r.*, c.cal_id, stw * coalesce(param_value, 1.0) AS adj_stw FROM r LEFT JOIN spans c ON r.ts >= c.effective_from AND (c.effective_to IS NULL OR r.ts < c.effective_to)),
k AS (SELECT *, abs(adj_stw) + 2.2162 * (1 - exp(-least(abs(adj_stw) / 0.5, 700))) / (1 + exp(least(abs(adj_stw) / 1.2698, 700)))
  - (CASE WHEN heel < 0 THEN 0.1294 ELSE 0.1166 END) * pow(least(abs(coalesce(heel, 0)), 30) / 20.0, 2) * (1 - exp(-least(abs(adj_stw) / 1.0, 700))) AS corrected_stw FROM a)
SELECT k.ts, round(sog, 9) AS sog, cal_id, round(adj_stw, 9) AS adj_stw, s.session_id, s.name AS session_name, g.seg_id, g.leg_type, gnss_method_code,
  round(corrected_stw, 9) AS corrected_stw, round(sign(heel) * least(8.080 * abs(heel) / pow(greatest(corrected_stw, 1.0), 2), 15) + 0 * corrected_stw, 9) AS leeway
FROM k LEFT JOIN sessions s ON k.ts >= s.t_start AND k.ts < coalesce(s.t_end, TIMESTAMP '2100-01-01') LEFT JOIN legs g ON g.session_id = s.session_id AND k.ts >= g.t0 AND k.ts < g.t1"""


def full_view(spark: SparkSession, d: str) -> DataFrame:
    return view.metrics(*view_tables(spark, d))


def view_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    s = sessions(spark, d)
    n = F.explode(F.sequence(F.lit(0), F.lit(3)))
    cut = s.select("session_id", "t_start", n.alias("no"))
    legs = cut.select((F.col("session_id") * 10 + F.col("no")).alias("seg_id"), "session_id", "no", F.concat(F.lit("leg "), "no").alias("leg_type"), F.lit("full").alias("mainsail"), F.lit("jib").alias("headsail"), *(F.timestamp_micros(F.unix_micros("t_start") + (F.col("no") + k) * 7_200_000_000).alias(c) for k, c in ((0, "t_start"), (1, "t_end"))))
    factors = calibrations(spark, d).withColumn("param_name", F.lit(view.SPEED_FACTOR))
    return wide(spark, d), factors, s, legs


def shown(v: DataFrame) -> DataFrame:
    r = lambda c: F.round(c, 9).alias(c)
    return v.select(plain("ts").alias("ts"), r("sog"), "cal_id", r("adj_stw"), "session_id", "session_name", "seg_id", "leg_type", "gnss_method_code", r("corrected_stw"), r("leeway"))


@registered(QUERIES, ORACLES, CALIBRATED)
def metrics_view(spark: SparkSession, d: str) -> DataFrame:
    return shown(full_view(spark, d))


@registered(QUERIES, ORACLES, CALIBRATED + " WHERE k.ts >= TIMESTAMP '2024-01-10' AND k.ts < TIMESTAMP '2024-01-11'")
def metrics_windowed(spark: SparkSession, d: str) -> DataFrame:
    """A day of the view through a temporary view: the bounds reach the scan."""
    view.define_view("tidewake_metrics", *view_tables(spark, d))
    return shown(spark.sql("SELECT * FROM tidewake_metrics WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"))


@registered(QUERIES, ORACLES, """SELECT date_trunc('minute', ts) AS minute, round(avg(value), 6) AS value FROM events GROUP BY 1""")
def resample_minute(spark: SparkSession, d: str) -> DataFrame:
    out = resample.resample(events(spark, d), "minute", ["value"])
    return out.select(plain("minute").alias("minute"), F.round("value", 6).alias("value"))


ANGLES = "a AS (SELECT event_type, date_trunc('day', ts) AS day, radians(event_id * 37 % 360 + value / 1000) AS r FROM events)"


def angles(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_type", F.date_trunc("day", "ts").alias("day"), (F.col("event_id") * 37 % 360 + F.col("value") / 1000).alias("angle")).groupBy("event_type", plain("day").alias("day"))


@registered(QUERIES, ORACLES, f"WITH {ANGLES} SELECT event_type, day, round((round(degrees(atan2(avg(sin(r)), avg(cos(r)))), 6) + 360) % 360, 4) AS angle FROM a GROUP BY ALL")
def circular_mean(spark: SparkSession, d: str) -> DataFrame:
    return angles(spark, d).agg(F.round(measures.circular_mean(F.col("angle")), 4).alias("angle"))


@registered(QUERIES, ORACLES, f"WITH {ANGLES} SELECT event_type, day, round(degrees(atan2(avg(sin(r)), avg(cos(r)))), 4) AS angle FROM a GROUP BY ALL")
def circular_mean_signed(spark: SparkSession, d: str) -> DataFrame:
    return angles(spark, d).agg(F.round(measures.circular_mean_signed(F.col("angle")), 4).alias("angle"))


@registered(QUERIES, ORACLES, f"WITH {ANGLES} SELECT event_type, day, round(sqrt(pow(avg(sin(r)), 2) + pow(avg(cos(r)), 2)), 6) AS agreement FROM a GROUP BY ALL")
def resultant_length(spark: SparkSession, d: str) -> DataFrame:
    return angles(spark, d).agg(F.round(measures.resultant_length(F.col("angle")), 6).alias("agreement"))


@registered(QUERIES, ORACLES, "SELECT event_id FROM events WHERE abs(epoch_us(ts) / 1e6 - (epoch_us(ts) / 1e6 + event_id % 5 - 2)) < 2")
def gps_agreement(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    gps = F.unix_micros("ts") / 1e6 + F.col("event_id") % 5 - 2
    return e.where(resample.gps_agreement(F.col("ts"), gps)).select("event_id")


@registered(QUERIES, ORACLES, "SELECT event_id, (event_id % 1000) / 1e6 AS clock_offset FROM events")
def clock_offset(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return e.select("event_id", resample.clock_offset(F.col("ts"), F.unix_micros("ts") - F.col("event_id") % 1000).alias("clock_offset"))


@registered(QUERIES, ORACLES, """WITH m AS (SELECT event_id, user_id, ts, epoch_us(ts) // 1000000 + CASE WHEN event_id % 97 < 48 THEN 0 ELSE 120 END AS mono FROM events),
b AS (SELECT *, epoch_us(ts) / 1e6 - mono AS base FROM m)
SELECT user_id, count(*) FILTER (stepped) AS steps FROM (SELECT user_id, coalesce(abs(base - lag(base) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 2, false) AS stepped FROM b) GROUP BY user_id""")
def clock_step(spark: SparkSession, d: str) -> DataFrame:
    mono = F.floor(F.unix_micros("ts") / 1_000_000) + F.when(F.col("event_id") % 97 < 48, 0).otherwise(120)
    steps = resample.clock_steps(events(spark, d).withColumn("mono", mono), ["user_id"], ["ts", "event_id"], 2)
    return steps.groupBy("user_id").agg(F.count_if("stepped").alias("steps"))


@registered(QUERIES, ORACLES, "SELECT count(*) AS seen, count(*) FILTER (ts < TIMESTAMP '2024-01-08') AS bad_clock FROM events")
def bad_clock(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).agg(F.count("*").alias("seen"), F.count_if(resample.bad_clock(F.col("ts"), "2024-01-08")).alias("bad_clock"))
