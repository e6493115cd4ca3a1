"""Device arbitration: within a bucket each field keeps one real reading.

The best device is the one of the lowest priority number, then the lowest
source address; it gives its own last sample. An exact tie goes to the sample
seen first. In buckets of a second or less, and within an object, that order fits a
long, so samples are aggregated by hash, partly before the shuffle. In general it is a struct,
which Spark aggregates partly too, but after sorting by group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import bucket_floor, parse_interval


def order(prio: Column, src: Column, ts: Column, seq: Column) -> Column:
    return F.struct((-prio).alias("p"), (-src).alias("s"), ts.alias("t"), (-seq).alias("q"))


def packed_order(prio: Column, src: Column, micros: Column, seq: Column) -> Column:
    """The same order in 63 bits: priorities 0-7, addresses 0-255, 2^32 microseconds in a bucket, 2^20 samples."""
    return F.shiftleft((7 - prio).cast("bigint"), 60) + F.shiftleft((255 - src).cast("bigint"), 52) + F.shiftleft(micros.cast("bigint"), 20) + (1048575 - seq)


def device_last(samples: DataFrame, keys: list[str]) -> DataFrame:
    """keys and value: the reading kept for each group. samples: prio, src_addr, ts, seq, value; object_rank, if there, comes before seq."""
    rank = order(F.col("prio"), F.col("src_addr"), F.col("ts"), F.col("seq"))
    if "object_rank" in samples.columns and "object_rank" not in keys:
        rank = F.struct((-F.col("prio")).alias("p"), (-F.col("src_addr")).alias("s"), F.col("ts").alias("t"), (-F.col("object_rank")).alias("o"), (-F.col("seq")).alias("q"))
    return samples.groupBy(*keys).agg(F.max_by("value", rank).alias("value"))


#: Microseconds of a bucket whose order within an object fits a long.
PACKED_MICROS = 1 << 20


def object_order(ts: Column, bucket: Column) -> Column:
    """The order of one object's samples in a bucket in 63 bits: priority 3, address 8, microseconds 20, place in the scan's partition 32.

    An object is one file, so one partition reads it; protocols without priorities have one rank, the last.
    """
    prio, src = F.least("prio", F.lit(7)), F.least("src_addr", F.lit(255))
    device = F.shiftleft((7 - prio).cast("bigint"), 60).bitwiseOR(F.shiftleft((255 - src).cast("bigint"), 52))
    micros = F.shiftleft(F.unix_micros(ts) - F.unix_micros(bucket), 32)
    return device.bitwiseOR(micros).bitwiseOR(F.lit((1 << 32) - 1) - F.col("seq").bitwiseAND((1 << 32) - 1))


def bucketize(samples: DataFrame, interval: str, by: tuple[str, ...] = ("object_key", "object_rank")) -> DataFrame:
    """Samples to one observation for each object, bucket and field; by (): for each bucket and field over all objects."""
    placed = samples.withColumn("bucket_ts", bucket_floor(F.col("ts"), interval))
    keys = [*by, "bucket_ts", "field"]
    if by and parse_interval(interval) <= PACKED_MICROS:
        return placed.groupBy(*keys).agg(F.max_by("value", object_order(F.col("ts"), F.col("bucket_ts"))).alias("value"))
    return device_last(placed, keys)


def distinct_fields(samples: DataFrame) -> DataFrame:
    return samples.select("field").distinct()


def widen(observations: DataFrame, fields: list[str] | None = None, bucket: str = "bucket_ts") -> DataFrame:
    """One row a bucket, one column a field, ascending by name. Without fields, those present are read first."""
    fields = sorted(r[0] for r in distinct_fields(observations).collect()) if fields is None else fields
    return observations.groupBy(F.col(bucket).alias("ts")).pivot("field", fields).agg(F.first("value"))
