"""Resampling, clock checks, and order-based operators over archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures
from ..functions.times import epoch_seconds


def resample(table: DataFrame, unit: str, scalars: list[str] = (), bearings: list[str] = (), signed: list[str] = (), ts: str = "ts") -> DataFrame:
    """Means by date_trunc unit: plain for scalars, circular and wrapped for bearings, circular and signed for angles off the bow."""
    out = [F.avg(c).alias(c) for c in scalars]
    out += [measures.circular_mean(F.col(c)).alias(c) for c in bearings]
    out += [F.round(measures.circular_mean_signed(F.col(c)), 6).alias(c) for c in signed]
    return table.groupBy(F.date_trunc(unit, F.col(ts)).alias(unit)).agg(*out)


def gps_agreement(ts: Column, gps_time: Column, seconds: float = 2.0) -> Column:
    """Whether the capture clock is within seconds of the GPS clock."""
    return F.abs(epoch_seconds(ts) - gps_time) < seconds


def clock_offset(ts: Column, gps_micros: Column) -> Column:
    """Capture clock less GPS clock, in seconds, from whole microseconds."""
    return (F.unix_micros(ts) - gps_micros) / 1e6


def clock_steps(records: DataFrame, by: list[str], order: list[str], tolerance: float = 0.5) -> DataFrame:
    """records with base (wall clock less monotonic clock) and stepped: base moved by more than tolerance."""
    base = records.withColumn("base", epoch_seconds(F.col("ts")) - F.col("mono"))
    before = F.lag("base").over(Window.partitionBy(*by).orderBy(*order))
    return base.withColumn("stepped", F.coalesce(F.abs(F.col("base") - before) > tolerance, F.lit(False)))


def clock_epochs(records: DataFrame, by: list[str], order: str, tolerance: float = 0.5) -> DataFrame:
    """records with base (wall clock less monotonic clock) and epoch: consecutive rows, by order, of one clock basis share a number from 1.

    A new epoch begins where base is known and differs by more than tolerance from the last known
    one: a boot, or a step of the wall clock. Rows without mono belong to the epoch they stand in, 0 before the first.
    order is a column of numbers; its ranges of EPOCH_ROWS are windows of their own, and what
    goes over from one range to the next is a row a range, so no device is one task.
    """
    based = records.withColumns({"base": epoch_seconds(F.col("ts")) - F.col("mono"), "_range": F.floor(F.col(order) / EPOCH_ROWS)})
    w = Window.partitionBy(*by, "_range").orderBy(order)
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    before = based.withColumn("_last", F.last("base", True).over(so_far))
    ranges = based.groupBy(*by, "_range").agg(F.max_by("base", F.when(F.col("base").isNotNull(), F.col(order))).alias("_end"))
    whole = Window.partitionBy(*by).orderBy("_range")
    carried = ranges.select(*by, "_range", F.last("_end", True).over(whole.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    same = [before[c].eqNullSafe(carried[c]) for c in (*by, "_range")]
    joined = before.join(carried, same, "left").select(*(before[c] for c in before.columns), "_carry")
    known = F.coalesce("_last", "_carry")
    stepped = F.coalesce(F.col("base").isNotNull() & (known.isNull() | (F.abs(F.col("base") - known) > tolerance)), F.lit(False))
    marked = joined.withColumn("stepped", stepped)
    here = F.sum(F.col("stepped").cast("long"))
    counts = marked.groupBy(*by, "_range").agg(here.alias("_steps"))
    ahead = counts.select(*by, "_range", F.coalesce(F.sum("_steps").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    numbered = marked.withColumn("_here", here.over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same = [numbered[c].eqNullSafe(ahead[c]) for c in (*by, "_range")]
    return numbered.join(ahead, same).select(*(numbered[c] for c in (*records.columns, "base", "stepped")), (F.col("_ahead") + F.col("_here")).alias("epoch"))


#: Rows of a device that one window has when clock epochs are found.
EPOCH_ROWS = 1_000_000


def epoch_table(epochs: DataFrame, by: list[str]) -> DataFrame:
    """Of each clock epoch: its rows, first and last ts, and offset, the base it began with."""
    first = F.min_by("base", F.when(F.col("base").isNotNull(), F.col("ts"))).alias("offset")
    return epochs.where("epoch > 0").groupBy(*by, "epoch").agg(F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), first)


def bad_clock(ts: Column, earliest: str = "2020-01-01") -> Column:
    """Flagged and counted, never dropped."""
    return ts < F.lit(earliest).cast("timestamp")


def runs_by(table: DataFrame, key: Column, order: list[str], by: list[str] = ()) -> DataFrame:
    """table with run: consecutive rows of equal key share a number from 1 (gaps and islands).

    With by the runs are counted within each group; without it the whole table
    is one sequence, as for one batch or object.
    """
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    changed = F.when(F.lag(key).over(w).eqNullSafe(key), 0).otherwise(1)
    return table.withColumn("_changed", changed).withColumn("run", F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_changed")


def keep_newest(table: DataFrame, size: str, limit: int, order: list[Column], by: list[str] = ()) -> DataFrame:
    """table with kept: the newest rows whose sizes together fit the limit; what comes before is evicted, oldest first.

    order: newest first. Nothing older than an evicted row is kept.
    """
    w = (Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)).rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn("kept", F.sum(size).over(w) <= limit)


def evictions(kept: DataFrame, by: list[str] = ()) -> DataFrame:
    """For each group, or in all: rows kept, and rows dropped because a buffer was full."""
    return kept.groupBy(*by).agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped"))


def closed_days(days: DataFrame, now: Column, lag_seconds: int = 300, day: str = "day") -> DataFrame:
    """Days that had ended lag_seconds ago."""
    return days.where(F.col(day) < F.to_date(now - F.make_dt_interval(secs=F.lit(lag_seconds))))
