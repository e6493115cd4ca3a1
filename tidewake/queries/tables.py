"""The test tables in the shapes that the operators take."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Registry = dict[str, Callable[[SparkSession, str], DataFrame]]


def registered(queries: Registry, oracles: dict[str, str], sql: str | None = None) -> Callable:
    """Enter a query under its function's name, with its SQL."""

    def enter(query: Callable[[SparkSession, str], DataFrame]) -> Callable:
        queries[query.__name__] = query
        if sql is not None:
            oracles[query.__name__] = sql
        return query

    return enter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df over all cores, where its files are fewer: a task a file decodes a small table on one core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def plain(ts: Column | str) -> Column:
    """A timestamp without zone, as the tables have it."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples: the type is the field, the user the device, the day the object."""
    return events(spark, sf_dir).select(
        F.date_format("ts", "yyyy-MM-dd").alias("object_key"), F.datediff(F.to_date("ts"), F.lit("2023-12-31")).cast("long").alias("object_rank"), F.col("event_id").alias("seq"), "ts",
        F.lit("n2k").alias("proto"), F.col("event_type").alias("field"), "value", (F.col("user_id") % 8).cast("int").alias("prio"), F.col("user_id").cast("int").alias("src_addr"),
    )


#: SQL of the same samples.
SAMPLES = """samples AS (SELECT strftime(ts, '%Y-%m-%d') AS object_key, date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS object_rank,
  event_id AS seq, ts, event_type AS field, value, CAST(user_id % 8 AS INT) AS prio, CAST(user_id AS INT) AS src_addr FROM events)"""
