"""Whole tables: the archive holds all days, and spans need no single task."""

from datetime import date

from pyspark.sql import functions as F

from tidewake.operators import joins
from tidewake.queries.archive import stored
from tidewake.sources import archive


def test_all_days_are_archived(spark, sf_dir):
    got = archive.read_archive(spark, stored(spark, sf_dir), date(2024, 1, 1), date(2024, 1, 31), "n2k")
    assert got.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


def test_spans_by_day(spark):
    """Several starts a day, equal ones, gaps of days, null starts; no window takes the whole table."""
    starts = [None, None, "2024-01-01 05:00:00", "2024-01-01 05:00:00", "2024-01-01 09:00:00", "2024-01-04 00:00:00", "2024-01-07 23:00:00", "2024-01-07 23:30:00"]
    rows = [(k, s) for k, s in enumerate(starts)]
    cals = spark.createDataFrame(rows[::-1], "cal_id long, s string").select("cal_id", F.col("s").cast("timestamp").alias("effective_from"))
    spans = joins.spans(cals)
    got = {r.cal_id: (r.effective_from, r.effective_to) for r in spans.collect()}
    by_start = [got[k] for k in range(len(starts))]
    assert [to for _, to in by_start] == [start for start, _ in by_start[1:]] + [None]
    windows = [line for line in spans._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert windows and all("_day" in line or "_first_day" in line for line in windows)
