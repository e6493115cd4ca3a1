"""As-of and interval joins.

Ranges are cut into equal bins of time, which turns a range join into an
equi-join on the bin with the range as residual condition: Spark broadcasts
small ranges by hash or shuffles large ones by bin, and no plan needs a nested
loop or a job of its own. The as-of join by union takes both sides in
time order instead, an hour a partition, for dimensions with many rows an hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a bin.
BIN = 3600


def bin_of(ts: Column, seconds: int = BIN) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (seconds * 1_000_000))


def spans(calibrations: DataFrame, start: str = "effective_from", tie: str = "cal_id") -> DataFrame:
    """calibrations with effective_to: the next start; null for the last. Of equal starts all but the last are empty."""
    day = F.to_date(start)
    # Days are the partitions; the last row of a day gets the first start of the next, a row a day. Null starts are a day, the first.
    firsts = calibrations.groupBy(day.alias("_first_day")).agg(F.min(start).alias("_first"))
    firsts = firsts.select("_first_day", F.lead("_first").over(Window.orderBy("_first_day")).alias("_next"))
    w = Window.partitionBy("_day").orderBy(start, tie)
    within = calibrations.withColumn("_day", day).withColumns({"_to": F.lead(start).over(w), "_last": F.lead(F.lit(True)).over(w).isNull()})
    carried = within.join(firsts, within["_day"].eqNullSafe(firsts["_first_day"]), "left")
    return carried.select(*calibrations.columns, F.when(F.col("_last"), F.col("_next")).otherwise(F.col("_to")).alias("effective_to"))


def asof(facts: DataFrame, calibrations: DataFrame, ts: str = "ts", bin_seconds: int = BIN) -> DataFrame:
    """Each fact with the calibration in force, or nulls before the first.

    The spans between two starts are binned. From the last start on there is one
    answer: a scalar subquery, so an open end needs no bins.
    """
    names = calibrations.columns
    c = spans(calibrations)
    ended = c.where("effective_to is not null and effective_from < effective_to").withColumn("_bin", F.explode(F.sequence(bin_of(F.col("effective_from"), bin_seconds), bin_of(F.col("effective_to") - F.expr("interval 1 microsecond"), bin_seconds))))
    ended = ended.select("_bin", F.struct(*names).alias("_cal"), F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"))
    last = calibrations.where("effective_from is not null").agg(F.max_by(F.struct(*names), F.struct("effective_from", "cal_id"))).scalar()
    keyed = facts.withColumn("_bin", bin_of(F.col(ts), bin_seconds))
    joined = keyed.join(ended, (keyed["_bin"] == ended["_bin"]) & (keyed[ts] >= ended["_from"]) & (keyed[ts] < ended["_to"]), "left").drop("_bin", "_from", "_to")
    found = joined.withColumn("_last", last)
    force = F.coalesce(F.col("_cal"), F.when(F.col(ts) >= F.col("_last.effective_from"), F.col("_last")))
    return found.withColumn("_force", force).select(*facts.columns, *(F.col("_force")[n].alias(n) for n in names))


def asof_union(facts: DataFrame, calibrations: DataFrame, ts: str = "ts", bin_seconds: int = BIN) -> DataFrame:
    """The same by the union of both sides in time order, and what is in force at a bin's start carried in.

    Bins are the partitions, so no task sees more than a bin at a time; the carry is a row a bin. Facts keep their columns, so those not asked for are never read.
    """
    names = calibrations.columns
    right = calibrations.select(F.col("effective_from").alias("_t"), F.lit(0).alias("_side"), F.col("cal_id").alias("_tie"), F.struct(*names).alias("_cal"))
    left = facts.select("*", F.col(ts).alias("_t"), F.lit(1).alias("_side"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_bin", bin_of(F.col("_t"), bin_seconds))
    ends = right.groupBy(bin_of(F.col("_t"), bin_seconds).alias("_bin")).agg(F.max_by("_cal", F.struct("_t", "_tie")).alias("_end"))
    days = facts.select(bin_of(F.col(ts), bin_seconds).alias("_bin")).unionByName(ends.select("_bin")).distinct()
    carry = days.join(ends, "_bin", "left").select("_bin", F.last("_end", True).over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    w = Window.partitionBy("_bin").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_now", F.last("_cal", True).over(w)).where("_side = 1").join(carry, "_bin", "left")
    force = F.coalesce("_now", "_carry")
    return found.select(*facts.columns, *(force[c].alias(c) for c in names))


def interval_join(facts: DataFrame, ranges: DataFrame, ts: str = "ts", start: str = "t_start", end: str = "t_end", open_to_now: bool = False, bin_seconds: int = BIN) -> DataFrame:
    """Each fact with every half-open range it is in, or nulls. An open end never matches unless open_to_now.

    An equi-join on time bins; each range is repeated in the bins it meets.
    """
    stop = F.coalesce(ranges[end], F.current_timestamp().cast(ranges.schema[end].dataType)) if open_to_now else ranges[end]
    cut = ranges.withColumn("_stop", stop).where(F.col(start) < F.col("_stop"))
    cut = cut.withColumn("_bin", F.explode(F.sequence(bin_of(F.col(start), bin_seconds), bin_of(F.col("_stop"), bin_seconds))))
    keyed = facts.withColumn("_bin", bin_of(F.col(ts), bin_seconds))
    return keyed.join(cut, (keyed["_bin"] == cut["_bin"]) & (keyed[ts] >= cut[start]) & (keyed[ts] < cut["_stop"]), "left").drop("_bin", "_stop")


#: Levels of the hierarchy of bins: the widest node has 2^LEVELS of them.
LEVELS = 40


def dyadic_nodes(first: str, last: str) -> str:
    """SQL of the nodes (level, node) of a binary hierarchy that bins first..last are made of: two a level at most.

    On a level those whole nodes belong to the cover that no whole node of the next level has.
    """
    whole = lambda k: (f"(-shiftright(-{first}, {k}))", f"shiftright({last} + 1, {k})")  # noqa: E731  begin, and end, of the nodes wholly inside
    (begin, end), (up, down) = whole("k"), whole("k + 1")
    ends = f"filter(array(CASE WHEN {begin} & 1 = 1 THEN {begin} END, CASE WHEN {end} & 1 = 1 THEN {end} - 1 END), n -> n IS NOT NULL)"
    top = f"CASE WHEN {begin} < {end} THEN sequence({begin}, {end} - 1) ELSE CAST(array() AS ARRAY<BIGINT>) END"
    nodes = f"CASE WHEN {up} < {down} THEN {ends} ELSE {top} END"
    return f"flatten(transform(sequence(0, {LEVELS}), k -> transform({nodes}, n -> named_struct('level', k, 'node', n))))"


def cut_dyadic(ranges: DataFrame, start: str = "t_start", end: str = "t_end", open_to_now: bool = False, bin_seconds: int = BIN) -> DataFrame:
    """ranges with _from, _stop, and a row for each _level and _node that they are made of: at most 2 log2 of the bins they span, and two more."""
    stop = F.coalesce(ranges[end], F.current_timestamp().cast(ranges.schema[end].dataType)) if open_to_now else ranges[end]
    cut = ranges.withColumns({"_from": F.col(start), "_stop": stop}).where("_from < _stop")
    cut = cut.withColumns({"_first": bin_of(F.col("_from"), bin_seconds), "_last": bin_of(F.col("_stop") - F.expr("interval 1 microsecond"), bin_seconds)})
    return cut.selectExpr("*", f"inline({dyadic_nodes('_first', '_last')}) AS (_level, _node)").drop("_first", "_last")


def interval_join_dyadic(facts: DataFrame, ranges: DataFrame, ts: str = "ts", start: str = "t_start", end: str = "t_end", open_to_now: bool = False, bin_seconds: int = BIN) -> DataFrame:
    """interval_join for ranges of any length, from less than a bin to years.

    Ranges are cut into nodes of a binary hierarchy of bins; each bin that has facts
    looks its ancestors up, one on each level that ranges have nodes of. That gives the ranges of each
    bin, no more of them than facts they are joined to, and facts meet them by bin: they are neither repeated nor
    shuffled by range. Facts are read twice, the first time only their ts.
    """
    cut = cut_dyadic(ranges, start, end, open_to_now, bin_seconds)
    levels = cut.agg(F.collect_set("_level")).scalar()
    bins = facts.select(bin_of(F.col(ts), bin_seconds).alias("_bin")).distinct()
    asked = bins.withColumn("_levels", levels).select("_bin", F.explode("_levels").alias("_level")).selectExpr("_bin", "_level", "shiftright(_bin, _level) AS _node")
    near = asked.join(cut, ["_level", "_node"]).drop("_level", "_node").withColumnRenamed("_bin", "_at")
    keyed = facts.withColumn("_bin", bin_of(F.col(ts), bin_seconds))
    return keyed.join(near, (keyed["_bin"] == near["_at"]) & (keyed[ts] >= near["_from"]) & (keyed[ts] < near["_stop"]), "left").drop("_bin", "_at", "_from", "_stop")


def interval_totals(facts: DataFrame, ranges: DataFrame, by: list[str], value: str, ts: str = "ts", start: str = "t_start", end: str = "t_end", open_to_now: bool = False, bin_seconds: int = BIN) -> DataFrame:
    """by, n and total: what interval_join_dyadic grouped by columns of the ranges gives as count and as sum of a whole number, facts in no range under nulls.

    No pair is formed: what is in a range is what there is before its end less what there is before its start, and a
    fact is in none where as many ranges have ended as have begun. Facts of one instant are one row; both sides are summed in
    time order, a bin a partition, and what all bins before have is a row a bin.
    """
    stop = F.coalesce(ranges[end], F.current_timestamp().cast(ranges.schema[end].dataType)) if open_to_now else ranges[end]
    cut = ranges.select(*by, F.col(start).alias("_from"), stop.alias("_stop")).where("_from < _stop")
    ends = cut.selectExpr(*by, "inline(array(struct(_from AS _t, 1L AS _begun), struct(_stop AS _t, -1L AS _begun)))").withColumn("_side", F.lit(0))
    # Sums of all facts may be wider than those of a range.
    wide = F.sum(F.col(value).cast("decimal(20,0)"))
    instants = facts.groupBy(F.col(ts).alias("_t")).agg(F.count("*").alias("_n"), F.count(value).alias("_known"), wide.alias("_sum")).withColumn("_side", F.lit(1))
    both = instants.unionByName(ends, allowMissingColumns=True).withColumn("_bin", bin_of(F.col("_t"), bin_seconds))
    parts = ("_n", "_known", "_sum", "_begun")
    # An end comes before the facts of its instant: they are behind a start, and no longer before a stop.
    so_far = Window.partitionBy("_bin").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = both.where("_bin is not null").groupBy("_bin").agg(*(F.sum(c).alias(c) for c in parts)).select("_bin", *(F.sum(c).over(earlier).alias(f"_carry{c}") for c in parts))
    placed = both.withColumns({f"_upto{c}": F.sum(c).over(so_far) for c in parts}).join(carry, "_bin", "left")
    before = {c: F.coalesce(F.col(f"_carry{c}"), F.lit(0)) + F.coalesce(F.col(f"_upto{c}"), F.lit(0)) for c in parts}
    told = placed.withColumn("_open", before["_begun"]).where("_side = 0 OR _open = 0")
    share = {c: F.when(F.col("_side") == 1, F.col(c)).when(F.col("_begun") == 1, -before[c]).otherwise(before[c]) for c in parts[:3]}
    summed = told.groupBy(*by).agg(*(F.sum(x).alias(c) for c, x in share.items())).where("_n > 0")
    return summed.select(*by, F.col("_n").alias("n"), F.when(F.col("_known") > 0, F.col("_sum")).cast("long").alias("total"))


def equi_range_join(facts: DataFrame, ranges: DataFrame, keys: list[str], ts: str = "ts", start: str = "t_start", end: str = "t_end") -> DataFrame:
    """Left equi-join on keys with a half-open range as residual condition; a null end never matches."""
    other = ranges.withColumnsRenamed({k: f"_{k}" for k in keys} | {start: "_start", end: "_end"})
    condition = (F.col(ts) >= F.col("_start")) & (F.col(ts) < F.col("_end"))
    for k in keys:
        condition &= F.col(k) == F.col(f"_{k}")
    return facts.join(other, condition, "left").drop("_start", "_end", *(f"_{k}" for k in keys))
