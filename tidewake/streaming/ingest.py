"""Incremental ingest of an archive with Structured Streaming.

Late data is never dropped: an object that lands late is a new file, and its
buckets are merged over what is there. No watermark is set for that reason. The
checkpoint remembers the files read; table and ledger change as one, so a
batch that is repeated finds its objects done or does its work again with the same result.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import derive
from ..schema import RAW
from ..sources import archive


def record_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Records of the objects under root as they land; old files first."""
    rows = spark.readStream.schema(RAW).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson.gz").json(f"{root}/raw")
    key = F.concat(F.lit("raw/"), F.regexp_extract(F.col("_metadata.file_path"), r"/raw/([0-9]{4}/.*)$", 1))
    return rows.select("*", key.alias("object_key"))


def object_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Paths of the objects under root as they land, those without rows too; no object is opened."""
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson.gz")
    return names.load(f"{root}/raw").select("path")


def catch_up(spark: SparkSession, root: str, table: str, checkpoint: str, interval: str = "1s", every: str | None = None, files_per_batch: int = 1000) -> StreamingQuery:
    """Bring the table up to date with what has landed since the last run, and stop; with every, go on at that pace.

    The stream is of objects, not of rows, so an object without rows gets its ledger
    row, and messages that an object leaves open are gone on with in the next batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # files_per_batch at most
        if paths:
            keys = batch.sparkSession.createDataFrame([(p,) for p in paths], "path string").select(archive.key_of(F.col("path")).alias("key"))
            derive.update(batch.sparkSession, archive.read_objects(batch.sparkSession, paths), keys, table, interval)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return object_stream(spark, root, files_per_batch).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def supervised(start: Callable[[], StreamingQuery], attempts: int = 4, first_wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> StreamingQuery:
    """Run a query to its end; where it fails, start it again from its checkpoint, after waits that double, each a random part of it."""
    for n in range(attempts):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if n + 1 == attempts:
                raise
            sleep(random.uniform(0, first_wait * 2**n))
    return query


def event_buckets(stream: DataFrame, interval: str, ts: str = "ts") -> DataFrame:
    """Tumbling windows of event time, counted from the epoch, by field: count, first and last time; complete mode or foreachBatch."""
    return stream.groupBy(F.window(ts, interval).alias("w"), "field").agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
