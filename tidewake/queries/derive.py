"""Arbitration, guards, merging and the ledger over the events."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import bucket_floor, parse_interval
from ..operators import arbitration, guard, merge
from .tables import SAMPLES, events, plain, registered, samples

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

LAST = "row_number() OVER (PARTITION BY {by} ORDER BY prio, src_addr, ts DESC, seq) = 1"
FIELDS = ("click", "error", "purchase", "signup", "view")


@registered(QUERIES, ORACLES, f"""WITH {SAMPLES} SELECT date_trunc('hour', ts) AS bucket_ts, field, value FROM samples
QUALIFY {LAST.format(by="date_trunc('hour', ts), field")}""")
def device_last(spark: SparkSession, d: str) -> DataFrame:
    return arbitration.bucketize(samples(spark, d), "1h", by=()).select(plain("bucket_ts").alias("bucket_ts"), "field", "value")


@registered(QUERIES, ORACLES, ORACLES["device_last"])
def device_last_packed(spark: SparkSession, d: str) -> DataFrame:
    """The same by a packed long: hash aggregation. Addresses are taken modulo 256 in both orders' sense, as users are below 256."""
    s = samples(spark, d).withColumn("bucket_ts", bucket_floor(F.col("ts"), "1h"))
    micros = F.unix_micros("ts") - F.unix_micros("bucket_ts")
    wide_order = F.struct(-F.col("prio"), -F.col("src_addr"), micros, -F.col("seq"))
    narrow = arbitration.packed_order(F.col("prio"), F.col("src_addr"), micros, F.col("seq"))
    # Sequences and addresses of larger tables leave the packed ranges; the struct order holds for any.
    fits = s.agg(F.max("seq"), F.max("src_addr")).first()
    key = narrow if (fits[0] or 0) < 1 << 20 and (fits[1] or 0) < 256 else wide_order
    return s.groupBy("bucket_ts", "field").agg(F.max_by("value", key).alias("value")).select(plain("bucket_ts").alias("bucket_ts"), "field", "value")


@registered(QUERIES, ORACLES, f"""WITH {SAMPLES}, best AS (SELECT date_trunc('hour', ts) AS bucket_ts, field, value FROM samples QUALIFY {LAST.format(by="date_trunc('hour', ts), field")})
SELECT bucket_ts AS ts, {", ".join(f"max(value) FILTER (field = '{f}') AS {f}" for f in FIELDS)} FROM best GROUP BY bucket_ts""")
def bucket_wide(spark: SparkSession, d: str) -> DataFrame:
    observed = arbitration.bucketize(samples(spark, d), "1h", by=())
    return arbitration.widen(observed).withColumn("ts", plain("ts"))


@registered(QUERIES, ORACLES, """SELECT event_id, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS b_1s, make_timestamp(epoch_us(ts) // 250000 * 250000) AS b_250ms,
make_timestamp(epoch_us(ts) // 300000000 * 300000000) AS b_5m, make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS b_1h FROM events""")
def bucket_floor_units(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", *(plain(bucket_floor(F.col("ts"), x)).alias(f"b_{x}") for x in ("1s", "250ms", "5m", "1h")))


UNITS = ("ms", "s", "m", "h", "sec", "")


@registered(QUERIES, ORACLES, """WITH t AS (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS n, l_linenumber % 6 AS unit, l_linenumber % 5 = 0 AS halves FROM lineitem)
SELECT n || CASE WHEN halves THEN '.5' ELSE '' END || CASE unit WHEN 0 THEN 'ms' WHEN 1 THEN 's' WHEN 2 THEN 'm' WHEN 3 THEN 'h' WHEN 4 THEN 'sec' ELSE '' END AS text,
CAST((n * 1000 + CASE WHEN halves THEN 500 ELSE 0 END) * CASE unit WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 60000 WHEN 3 THEN 3600000 END AS BIGINT) AS micros FROM t""")
def parse_interval_texts(spark: SparkSession, d: str) -> DataFrame:
    """Quantities with units as texts of intervals; those of no unit, or of an unknown one, are none."""
    unit = F.get(F.array(*map(F.lit, UNITS)), (F.col("l_linenumber") % 6).cast("int"))
    texts = spark.read.parquet(f"{d}/lineitem.parquet").select(F.concat(F.col("l_quantity").cast("bigint"), F.when(F.col("l_linenumber") % 5 == 0, ".5").otherwise(""), unit).alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"text": batch.column("text"), "micros": pa.array([micros_of(t) for t in batch.column("text").to_pylist()], pa.int64())})

    return texts.mapInArrow(run, "text string, micros long")


def micros_of(text: str) -> int | None:
    try:
        return parse_interval(text)
    except ValueError:
        return None



@registered(QUERIES, ORACLES, "SELECT DISTINCT event_type AS field FROM events")
def distinct_fields(spark: SparkSession, d: str) -> DataFrame:
    return arbitration.distinct_fields(samples(spark, d))


BOUNDS = {"click": (0.0, 100.0), "purchase": (10.0, 50.0), "error": (0.0, 5.0)}
PASSES = "NOT ((field = 'click' AND value NOT BETWEEN 0 AND 100) OR (field = 'purchase' AND value NOT BETWEEN 10 AND 50) OR (field = 'error' AND value NOT BETWEEN 0 AND 5))"


@registered(QUERIES, ORACLES, f"WITH {SAMPLES} SELECT seq, field, value FROM samples WHERE {PASSES}")
def range_guard(spark: SparkSession, d: str) -> DataFrame:
    return guard.guard(samples(spark, d), BOUNDS).select("seq", "field", "value")


@registered(QUERIES, ORACLES, f"WITH {SAMPLES} SELECT count(*) AS seen, count(*) FILTER (NOT ({PASSES})) AS dropped FROM samples")
def range_guard_counts(spark: SparkSession, d: str) -> DataFrame:
    return guard.guard_counts(samples(spark, d), BOUNDS)


@registered(QUERIES, ORACLES, f"WITH {SAMPLES}, k AS (SELECT DISTINCT object_key AS key, object_key AS day FROM samples) SELECT key, day, CAST(row_number() OVER (ORDER BY day, key) AS INT) AS object_rank FROM k")
def object_order(spark: SparkSession, d: str) -> DataFrame:
    keys = samples(spark, d).select(F.col("object_key").alias("key"), F.col("object_key").alias("day")).distinct()
    return merge.object_order(keys)


PER_OBJECT = f"""{SAMPLES}, sliced AS (SELECT * REPLACE (epoch_us(ts) // 21600000000 AS object_rank), date_trunc('day', ts) AS bucket_ts FROM samples),
obs AS (SELECT object_rank, bucket_ts, field, value FROM sliced QUALIFY {LAST.format(by="object_rank, bucket_ts, field")})"""


def sliced(spark: SparkSession, d: str) -> DataFrame:
    """Observations of six-hour objects in day buckets, which several objects share."""
    s = samples(spark, d).withColumn("object_rank", F.floor(F.unix_micros("ts") / 21_600_000_000)).withColumn("object_key", F.col("object_rank").cast("string"))
    return arbitration.bucketize(s.withColumn("ts", F.col("ts")), "24h")


@registered(QUERIES, ORACLES, f"""WITH {PER_OBJECT}, grid AS (SELECT * FROM (SELECT DISTINCT object_rank, bucket_ts FROM obs) JOIN (SELECT DISTINCT object_rank, field FROM obs) USING (object_rank)),
filled AS (SELECT g.*, o.value FROM grid g LEFT JOIN obs o USING (object_rank, bucket_ts, field))
SELECT bucket_ts, field, value FROM filled QUALIFY row_number() OVER (PARTITION BY bucket_ts, field ORDER BY object_rank DESC) = 1""")
def merge_objects(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_objects(sliced(spark, d)).select(plain("bucket_ts").alias("bucket_ts"), "field", "value")


@registered(QUERIES, ORACLES, f"""WITH {SAMPLES}, obs AS (SELECT DISTINCT object_key, date_trunc('hour', ts) AS b FROM samples)
SELECT object_key, min(b) AS first_ts, max(b) AS last_ts, CAST(count(*) AS INT) AS rows FROM obs GROUP BY object_key""")
def ledger_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = merge.ledger_stats(arbitration.bucketize(samples(spark, d), "1h"))
    return stats.select("object_key", plain("first_ts").alias("first_ts"), plain("last_ts").alias("last_ts"), "rows")


@registered(QUERIES, ORACLES, f"""WITH {SAMPLES}, k AS (SELECT object_key, count(DISTINCT date_trunc('hour', ts)) AS rows FROM samples GROUP BY object_key)
SELECT count(*) AS objects, count(*) FILTER (rows < 24) AS failed, CAST(sum(rows) AS BIGINT) AS rows FROM k""")
def scan_totals(spark: SparkSession, d: str) -> DataFrame:
    return merge.scan_totals(merge.ledger_stats(arbitration.bucketize(samples(spark, d), "1h")), F.col("rows") < 24)


@registered(QUERIES, ORACLES, f"WITH {SAMPLES} SELECT DISTINCT object_key AS key FROM samples WHERE day(ts) % 3 <> 0")
def ledger_anti_join(spark: SparkSession, d: str) -> DataFrame:
    s = samples(spark, d)
    ledger = s.where(F.dayofmonth("ts") % 3 == 0).select(F.col("object_key").alias("key")).distinct()
    return merge.not_in_ledger(s.select(F.col("object_key").alias("key")).distinct(), ledger)


@registered(QUERIES, ORACLES, """SELECT event_id, value, CAST(NULL AS VARCHAR) AS event_type FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, NULL, event_type FROM events WHERE event_id % 2 = 1""")
def schema_evolve(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    out, added = merge.schema_evolve(e.where("event_id % 2 = 0").select("event_id", "value"), e.where("event_id % 2 = 1").select("event_id", "event_type"))
    return out.select("event_id", "value", *added)


@registered(QUERIES, ORACLES, f"""WITH {SAMPLES}, b AS (SELECT date_trunc('day', ts) AS ts, max(value) FILTER (field = 'click') AS click, max(value) FILTER (field = 'view') AS view FROM samples GROUP BY 1),
n AS (SELECT date_trunc('day', ts) AS ts, max(value) FILTER (field = 'view') + 1 AS view, min(value) AS low FROM samples WHERE day(ts) % 2 = 0 GROUP BY 1)
SELECT coalesce(b.ts, n.ts) AS ts, b.click, n.low, CASE WHEN n.ts IS NOT NULL THEN n.view ELSE b.view END AS view FROM b FULL JOIN n USING (ts)""")
def upsert_columns(spark: SparkSession, d: str) -> DataFrame:
    """A batch written over a table by key: only its own columns change, new ones appear."""
    s = samples(spark, d).withColumn("ts", F.date_trunc("day", "ts"))
    of = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    base = s.groupBy("ts").agg(of("click").alias("click"), of("view").alias("view"))
    batch = s.where(F.dayofmonth("ts") % 2 == 0).groupBy("ts").agg((of("view") + 1).alias("view"), F.min("value").alias("low"))
    return merge.merge_into(base, batch).withColumn("ts", plain("ts"))
