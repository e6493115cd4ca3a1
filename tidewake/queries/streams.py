"""Streaming catch-up and stateful reassembly, run to the end of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_seconds
from ..operators import n2k, resample
from ..plans import store
from ..sources import archive, export, segments
from ..streaming import capture, ingest, reassembly, supervise
from .archive import records, scratch
from .decoding import LOOKUP_SQL, course_raw, long_messages
from .tables import events, plain, registered

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


COURSE = ("n2k_cog", "n2k_cogreference_code", "n2k_sog")


@registered(QUERIES, ORACLES, f"""WITH e AS (SELECT event_id, ts, user_id % 256 AS src_addr, event_id % 3 = 0 AS late, date_trunc('hour', ts) AS bucket_ts FROM events),
s AS (SELECT *, 'n2k_cog' AS field, round(round(degrees(event_id % 62831 * 1e-4), 2), 2) AS value FROM e UNION ALL SELECT *, 'n2k_sog', round(event_id % 1000 * 0.01 * 1.94384, 3) FROM e WHERE event_id % 6 <> 0
  UNION ALL SELECT *, 'n2k_cogreference_code', CAST(event_id % 2 AS DOUBLE) FROM e),
o AS (SELECT late, bucket_ts, field, value FROM s QUALIFY row_number() OVER (PARTITION BY late, bucket_ts, field ORDER BY src_addr, ts DESC, event_id) = 1),
w AS (SELECT late, bucket_ts, {", ".join(f"max(value) FILTER (field = '{c}') AS {c}" for c in COURSE)} FROM o GROUP BY late, bucket_ts)
SELECT bucket_ts AS ts, {", ".join(COURSE)} FROM w QUALIFY row_number() OVER (PARTITION BY bucket_ts ORDER BY late DESC) = 1""")
def stream_catch_up(spark: SparkSession, d: str) -> DataFrame:
    """All days through the archive's writer and the stream, to the hours of the table. Every third record lands late, in objects of their own: the second run merges them over the first's rows, nulls too."""
    root, out = scratch(spark, "archive"), scratch(spark, "stream")
    frames = events(spark, d).select("event_id", "ts", F.to_date("ts").alias("day"), F.lit(None).cast("double").alias("mono"), F.lit("boat").alias("device_id"), F.lit("can0").alias("src"), F.lit("n2k").alias("proto"), course_raw().alias("raw"))
    late = F.col("event_id") % 3 == 0
    for landed in (~late, late):
        archive.write_objects(frames.where(landed), root, ["day"], ["event_id"]).count()
        ingest.catch_up(spark, root, f"{out}/table", f"{out}/checkpoint", "1h").awaitTermination()
    return store.read_table(spark, f"{out}/table").select(plain("ts").alias("ts"), *COURSE)


@registered(QUERIES, ORACLES, LOOKUP_SQL)
def stream_fast_packet(spark: SparkSession, d: str) -> DataFrame:
    """Reassembly with keyed state gives what the batch form gives."""
    out = scratch(spark, "stream")
    k = F.col("event_id")
    third = 1 + (spark.read.parquet(f"{d}/events.parquet").agg(F.max("event_id")).scalar() * 10 + 6) / 3
    # A batch each, whose bounds fall inside messages: the state has what is open, and the stream is begun again with it.
    for n in range(3):
        near = long_messages(spark, d).where((F.floor(k * 10 / third) <= n) & (F.floor((k * 10 + 6) / third) >= n))
        frames = n2k.frames(near, n2k.FAST).select("device_id", "src", "can_id", "seq", "ts", "payload")
        frames.where(F.floor(F.col("seq") / third) == n).write.mode("append").parquet(f"{out}/frames")
        stream = spark.readStream.schema(frames.schema).parquet(f"{out}/frames")
        query = reassembly.reassemble_stream(stream).writeStream.format("parquet").option("path", f"{out}/messages").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    messages = spark.read.schema(reassembly.MESSAGE).parquet(f"{out}/messages")
    values = n2k.decode_messages(messages.select("seq", F.lit(129029).alias("pgn"), "payload"))
    return values.where(F.col("field").endswith("_code")).select("seq", "field", "value")


@registered(QUERIES, ORACLES, "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type AS field, count(*) AS n FROM events GROUP BY ALL")
def stream_event_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows of event time, without a watermark: late events count."""
    out = scratch(spark, "stream")
    e = spark.read.parquet(f"{d}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("field"))
    e.write.parquet(f"{out}/events")
    stream = spark.readStream.schema(e.schema).parquet(f"{out}/events")
    # The last batch's result, whole, in a folder; nothing comes to the driver.
    write = lambda batch, _: batch.write.mode("overwrite").parquet(f"{out}/buckets")
    ingest.event_buckets(stream, "6 hours").writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/buckets").select(plain("w.start").alias("start"), "field", "n")


def numbered(rows: DataFrame) -> DataFrame:
    """Lines of a capture by the number of their event, from 0."""
    return rows.select(F.col("event_id").alias("line"), "value")


@registered(QUERIES, ORACLES, """SELECT epoch_us(ts) AS micros, CASE WHEN event_id % 3 <> 0 THEN event_id / 2 END AS mono, CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE 'can0' END AS src, lpad(lower(printf('%x', event_id)), 8, '0') || '#00ff' AS raw FROM events""")
def stream_capture(spark: SparkSession, d: str) -> DataFrame:
    """All events as segments of a live capture, through the stream into the archive; the stream is stopped after its first batch and goes on with the rest."""
    out = scratch(spark, "capture")
    r = records(spark, d)
    line = export.candump_line(F.col("ts"), F.col("src"), F.col("proto"), F.col("raw"))
    stamped = r.select("event_id", F.concat_ws(" ", line, F.col("mono").cast("decimal(15,3)").cast("string")).alias("value"))
    segments.write_segments(numbered(stamped), f"{out}/segments", 1000).count()
    third = 1 + sum(s.size for s in segments.segments(*segments.open_folder(f"{out}/segments"))) // 3
    where = (spark, f"{out}/segments", f"{out}/archive", "boat", f"{out}/checkpoint")
    capture.capture(*where, None, max_batch_bytes=third).awaitTermination()
    capture.drain(*where, max_batch_bytes=third)
    back = archive.read_archive(spark, f"{out}/archive", archive.FIRST_DAY, archive.LAST_DAY)
    return back.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "mono", "src", "raw")


#: Bytes of a line of stream_shed with its end, lines of a segment, and bytes that may wait.
LINE_BYTES, SEGMENT_LINES, BACKLOG = 39, 1000, 175_500


@registered(QUERIES, ORACLES, f"""WITH s AS (SELECT event_id // {SEGMENT_LINES} AS segment, count(*) AS n FROM events GROUP BY 1),
w AS (SELECT n, sum(n * {LINE_BYTES}) OVER (ORDER BY segment DESC) <= {BACKLOG} AS kept FROM s)
SELECT CAST(sum(n) FILTER (kept) AS BIGINT) AS stored, CAST(coalesce(sum(n) FILTER (NOT kept), 0) AS BIGINT) AS lost FROM w""")
def stream_shed(spark: SparkSession, d: str) -> DataFrame:
    """After an outage more waits than may: the oldest segments are shed, and the offsets have how many lines that were."""
    out = scratch(spark, "capture")
    lines = records(spark, d).select("event_id", export.candump_line(F.col("ts"), F.lit("can0"), F.col("proto"), F.col("raw")).alias("value"))
    segments.write_segments(numbered(lines), f"{out}/segments", SEGMENT_LINES).count()
    capture.capture(spark, f"{out}/segments", f"{out}/archive", "boat", f"{out}/checkpoint", None, max_backlog_bytes=BACKLOG).awaitTermination()
    lost = spark.read.text(f"{out}/checkpoint/offsets").select(F.get_json_object("value", "$.lost").cast("bigint").alias("lost")).agg(F.max("lost")).scalar()
    back = archive.read_archive(spark, f"{out}/archive", archive.FIRST_DAY, archive.LAST_DAY)
    return back.agg(F.count("*").alias("stored")).withColumn("lost", lost)


@registered(QUERIES, ORACLES, "SELECT count(*) AS received, count(*) FILTER (event_id % 7 = 3) AS refused, count(*) FILTER (event_id % 7 <> 3 AND event_id % 9 = 4) AS bad_clock FROM events")
def stream_statistics(spark: SparkSession, d: str) -> DataFrame:
    """What the stream's listener counts over all batches of a capture: lines, those that are no frames, and those stamped before any capture was."""
    out = scratch(spark, "capture")
    k = F.col("event_id")
    line = export.candump_line(F.when(k % 9 == 4, F.lit("2001-02-03").cast("timestamp")).otherwise(F.col("ts")), F.lit("can0"), F.col("proto"), F.col("raw"))
    lines = records(spark, d).select("event_id", F.when(k % 7 == 3, F.concat(line, F.lit("0"))).otherwise(line).alias("value"))
    segments.write_segments(numbered(lines), f"{out}/segments", 1000).count()
    half = 1 + sum(s.size for s in segments.segments(*segments.open_folder(f"{out}/segments"))) // 2
    name = f"boat {out[-8:]}"
    stats = supervise.listening(spark)
    try:
        capture.drain(spark, f"{out}/segments", f"{out}/archive", name, f"{out}/checkpoint", max_batch_bytes=half)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        total = stats.settled(f"capture {name}")
    finally:
        spark.streams.removeListener(stats)
    return spark.createDataFrame([(total["received"], total["refused"], total["bad_clock"])], "received long, refused long, bad_clock long")


@registered(QUERIES, ORACLES, """WITH r AS (SELECT event_id, ts, event_id % 3 AS device, CASE WHEN event_id % 5 <> 0 THEN event_id // 700 END AS level FROM events),
k AS (SELECT *, last_value(level IGNORE NULLS) OVER (PARTITION BY device ORDER BY event_id) AS held FROM r),
e AS (SELECT device, held, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM k WHERE held IS NOT NULL GROUP BY device, held)
SELECT device, CAST(dense_rank() OVER (PARTITION BY device ORDER BY held) AS BIGINT) AS epoch, rows, first_ts, last_ts, CAST(1600000000 + 100 * held AS DOUBLE) AS "offset" FROM e""")
def clock_epochs(spark: SparkSession, d: str) -> DataFrame:
    """Which records were stamped by one clock: the wall clock is stepped by a hundred seconds every 700 events, and every fifth record has no monotonic time."""
    k = F.col("event_id")
    level = 1_600_000_000 + 100 * F.floor(k / 700)
    r = events(spark, d).select("event_id", "ts", (k % 3).alias("device"), F.when(k % 5 != 0, F.round(epoch_seconds(F.col("ts")) - level, 6)).alias("mono"))
    table = resample.epoch_table(resample.clock_epochs(r, ["device"], "event_id"), ["device"])
    return table.select("device", "epoch", "rows", plain("first_ts").alias("first_ts"), plain("last_ts").alias("last_ts"), F.round("offset", 3).alias("offset"))
