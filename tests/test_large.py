"""Queries over tables whose numbers, or rows, are those of larger scales."""

import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from tests.test_oracles import ORACLES, QUERIES, norm
from tidewake.operators import joins

T0 = dt.datetime(2026, 8, 24, 12, tzinfo=dt.timezone.utc)


def held_to_sql(spark, folder, name):
    """Whether a query over the tables of a folder gives what its SQL does."""
    con = duckdb.connect()
    for file in folder.glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = QUERIES[name](spark, str(folder))
    names = ", ".join(f'"{c}"' for c in got.columns)
    want = con.sql(f"SELECT {names} FROM ({ORACLES[name]})").fetchall()
    as_text = lambda rows: sorted((tuple(map(norm, r)) for r in rows), key=str)
    assert as_text(map(tuple, got.collect())) == as_text(want)
    return len(want)


def test_positions_beyond_four_bytes(spark, sf_dir, tmp_path):
    """Way points of events whose number, times a thousand or five hundred, no four bytes hold."""
    firsts = "0, 899990, 2147480, 4294960, 8589930, 36000000, 5000000000"
    duckdb.sql(f"COPY (SELECT f + event_id AS event_id, ts FROM (SELECT * FROM '{sf_dir}/events.parquet' WHERE event_id < 40), (SELECT unnest([{firsts}]) AS f)) TO '{tmp_path}/events.parquet'")
    assert held_to_sql(spark, tmp_path, "decode_n2k_sets") > 1000


def test_totals_of_ranges_form_no_pairs(spark):
    """What the join of ranges of any length gives grouped, of instants that facts and ends share, nulls, and keys of several ranges; no row is more than an instant or an end."""
    rng = random.Random(4)
    at = lambda minutes: T0 + dt.timedelta(minutes=minutes)
    ranges = [(k % 40 if k % 9 else None, at(a), at(a + rng.choice([-5, 0, 1, 30, 60, 6000, 2**21]))) for k, a in enumerate(rng.choices(range(-600, 900, 30), k=80))]
    ranges += [(50, at(0), None), (51, None, at(9)), (52, at(0), at(0)), (53, at(1e7), at(2e7))]
    facts = [(k if k % 5 else None, at(rng.choice(range(-900, 900, 15)))) for k in range(300)] + [(7, None), (None, at(5000 - 2**21))]
    f = spark.createDataFrame(facts, "v long, ts timestamp").repartition(3)
    r = spark.createDataFrame(ranges, "r int, t_start timestamp, t_end timestamp")
    for few in (ranges[-3:], ranges[-4:], ranges):
        part = r.where("false").union(spark.createDataFrame(few, r.schema))
        for open_ in (False, True):
            want = joins.interval_join_dyadic(f, part, open_to_now=open_).groupBy("r").agg(F.count("*"), F.sum("v"))
            got = joins.interval_totals(f, part, ["r"], "v", open_to_now=open_)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # The sum of all facts fits no long, those of the ranges do.
    one = spark.createDataFrame([(1, at(-2000), at(-1000)), (2, at(2000), at(3000))], r.schema)
    huge = spark.createDataFrame([(2**62, at(m)) for m in (-1500, -10000, -10001, 2500, 10000)], "v long, ts timestamp")
    got = joins.interval_totals(huge, one.union(spark.createDataFrame([(3, at(-10000), at(-9999)), (4, at(-10001), at(-10000)), (5, at(10000), at(10001))], r.schema)), ["r"], "v")
    assert sorted(map(tuple, got.collect())) == [(k, 1, 2**62) for k in range(1, 6)]


def test_interval_long_grows_with_its_input(spark, sf_dir, tmp_path):
    """Twelve times the events and the suppliers: twelve times the rows of the largest step, not 144 times."""
    duckdb.sql(f"COPY (SELECT event_id + 1000000 * i AS event_id, ts FROM '{sf_dir}/events.parquet', range(12) t(i)) TO '{tmp_path}/events.parquet'")
    duckdb.sql(f"COPY (SELECT s_suppkey + 1000 * i AS s_suppkey FROM '{sf_dir}/supplier.parquet', range(12) t(i)) TO '{tmp_path}/supplier.parquet'")
    assert held_to_sql(spark, tmp_path, "interval_long") > 50
    plan = QUERIES["interval_long"](spark, str(tmp_path))
    plan.collect()
    # The nodes of the plan that ran, with the rows that each gave.
    rows, left = [], [plan._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            left.append(node.plan())
        if node.metrics().contains("numOutputRows"):
            rows.append(node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(k) for k in range(node.children().size())]
    events, suppliers = (duckdb.sql(f"SELECT count(*) FROM '{tmp_path}/{t}.parquet'").fetchall()[0][0] for t in ("events", "supplier"))
    assert events <= max(rows) <= events + 2 * suppliers
