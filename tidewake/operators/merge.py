"""Merging the observations of several objects, the ledger, and schema growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def object_order(keys: DataFrame, day: str = "day", name: str = "key") -> DataFrame:
    """keys with object_rank from 1, by day and then name. The table has a row an object."""
    return keys.withColumn("object_rank", F.row_number().over(Window.orderBy(day, name)))


def merge_objects(observations: DataFrame) -> DataFrame:
    """Latest object wins for each (bucket, field) that occurs anywhere in it, even with a null for that bucket.

    That is what writing one object after another does where each batch sets only
    its own columns. observations: object_rank, bucket_ts, field, value.
    """
    # A bucket of an object as a map of its values, next to all fields of the object: one shuffle by object, one by bucket.
    rows = observations.groupBy("object_rank", "bucket_ts").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_row"))
    fields = observations.groupBy("object_rank").agg(F.collect_set("field").alias("_fields"))
    full = rows.join(fields, "object_rank").select("object_rank", "bucket_ts", F.explode("_fields").alias("field"), "_row")
    value = F.try_element_at("_row", F.col("field"))
    return full.groupBy("bucket_ts", "field").agg(F.max_by(value, "object_rank").alias("value"))


def merge_into(table: DataFrame, batch: DataFrame, key: str = "ts") -> DataFrame:
    """table with the rows of batch written over it by key: columns of batch replace, others stay, new ones appear."""
    old = {c: f"_old_{c}" for c in table.columns if c != key}
    joined = table.withColumnsRenamed(old).withColumn("_in_table", F.lit(True)).join(batch.withColumn("_in_batch", F.lit(True)), key, "full")
    out = [F.col(key)]
    for c in sorted({*table.columns, *batch.columns} - {key}):
        if c not in batch.columns:
            out.append(F.col(old[c]).alias(c))
        elif c not in table.columns:
            out.append(F.col(c))
        else:
            out.append(F.when(F.col("_in_batch"), F.col(c)).otherwise(F.col(old[c])).alias(c))
    return joined.select(*out)


def schema_evolve(table: DataFrame, batch: DataFrame) -> tuple[DataFrame, list[str]]:
    """Both as one table with the columns of either, nulls where absent; and the columns added, sorted."""
    added = sorted(set(batch.columns) - set(table.columns))
    return table.unionByName(batch, allowMissingColumns=True), added


def ledger_stats(observations: DataFrame, key: str = "object_key") -> DataFrame:
    """For each object: first and last bucket, and the number of buckets."""
    return observations.groupBy(key).agg(F.min("bucket_ts").alias("first_ts"), F.max("bucket_ts").alias("last_ts"), F.countDistinct("bucket_ts").cast("int").alias("rows"))


def ledger_rows(keys: DataFrame, observations: DataFrame) -> DataFrame:
    """Ledger rows of all keys read; an object without observations has its row too."""
    stats = ledger_stats(observations).withColumnRenamed("object_key", "key")
    return keys.select("key").join(stats, "key", "left").select("key", F.current_timestamp().alias("ingested"), "first_ts", "last_ts", F.coalesce("rows", F.lit(0)).alias("rows"))


def not_in_ledger(keys: DataFrame, ledger: DataFrame, key: str = "key") -> DataFrame:
    return keys.join(ledger.select(key), key, "left_anti")


def scan_totals(ledger: DataFrame, failed: Column | None = None) -> DataFrame:
    """One row: objects, failed objects, rows."""
    bad = F.lit(False) if failed is None else failed
    return ledger.agg(F.count("*").alias("objects"), F.count_if(bad).alias("failed"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
