"""Live capture: candump lines in segments, from where a stream stores them as objects of the archive.

A relay such as `candump -L can0 | python -m tidewake.commands relay --segments FOLDER` numbers the
lines, stamps each with the monotonic clock, and writes segments. The stream
remembers how far it has come, so it may stop, fail or come late: what was
written meanwhile is taken up where it left off, and what had to be dropped is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import archive
from ..sources.segments import SegmentSource

#: (seconds.micros) interface IDENTIFIER#DATA, and the monotonic clock's seconds if there are.
CANDUMP = r"^\(([0-9]{1,11})\.([0-9]{6})\) ([0-9A-Za-z]+) ([0-9A-Fa-f]{8})#((?:[0-9A-Fa-f]{2}){0,8})(?: ([0-9]{1,15}(?:\.[0-9]{1,9})?))?$"
#: Pace of objects.
EVERY = "300 seconds"


def candump_fields(line: Column) -> Column:
    """struct(ts, src, raw, mono) of a candump line; null for what is no extended data frame. mono is null where the line has none."""
    part = lambda k: F.regexp_extract(line, CANDUMP, k)
    micros = part(1).cast("bigint") * 1_000_000 + part(2).cast("bigint")
    whole = F.struct(F.timestamp_micros(micros).alias("ts"), part(3).alias("src"), F.lower(F.concat(part(4), F.lit("#"), part(5))).alias("raw"), part(6).try_cast("double").alias("mono"))
    return F.when(line.rlike(CANDUMP), whole)


def records(lines: DataFrame, device_id: str) -> DataFrame:
    """Records of lines (segment, byte, value), numbered by both; others are left out."""
    parsed = lines.select("segment", "byte", candump_fields(F.col("value")).alias("_f")).where("_f is not null")
    return parsed.select("segment", "byte", "_f.ts", "_f.mono", F.lit(device_id).alias("device_id"), "_f.src", F.lit("n2k").alias("proto"), "_f.raw")


def store_batch(lines: DataFrame, root: str, device_id: str) -> DataFrame:
    """Write a batch's records as objects, one a day and protocol."""
    stamped = records(lines, device_id).withColumn("day", F.to_date("ts"))
    return archive.write_objects(stamped, root, ["day", "proto"], ["segment", "byte"])


def segment_stream(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """Lines (segment, byte, value) of a folder of segments as they come; see sources.segments for the options."""
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format(SegmentSource.name()).options(**{k: str(v) for k, v in options.items() if v is not None}).load(folder)


def capture(spark: SparkSession, folder: str, root: str, device_id: str, checkpoint: str, every: str | None = EVERY, **options: object) -> StreamingQuery:
    """Store what a folder of segments has, and go on at that pace; with no pace, only the next batch."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    from .supervise import counted_lines

    lines = counted_lines(segment_stream(spark, folder, progress=f"{checkpoint}/_progress.json", **options))
    write = lines.writeStream.foreachBatch(lambda batch, _: store_batch(batch, root, device_id).write.format("noop").mode("overwrite").save())
    return write.option("checkpointLocation", checkpoint).trigger(**trigger).queryName(f"capture {device_id}").start()


def drain(spark: SparkSession, folder: str, root: str, device_id: str, checkpoint: str, **options: object) -> int:
    """Store batch after batch until nothing waits; how many there were."""
    batches = 0
    while True:
        query = capture(spark, folder, root, device_id, checkpoint, None, **options)
        query.awaitTermination()
        if not any(p["numInputRows"] for p in query.recentProgress):
            return batches
        batches += 1
