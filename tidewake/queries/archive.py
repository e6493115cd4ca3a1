"""Archive keys, records, exports and imports over the events."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import iso_utc, utc_timestamp
from ..operators import merge, resample
from ..schema import APPLICATION, COLUMN, PROTO, RAW_FIELDS
from ..sources import archive, audit, export, legacy
from ..streaming import capture
from .tables import events, plain, registered

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 > 0 THEN '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00'"
#: One record's JSON text; mono is the event's number in half seconds.
LINE = f"""'{{"ts":"' || {ISO} || '","mono":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE event_id // 2 || CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '.5' END END
 || ',"device_id":"u' || user_id || '","src":' || CASE WHEN event_id % 4 = 0 THEN 'null' ELSE '"can0"' END || ',"proto":"n2k","raw":"' || lpad(lower(printf('%x', event_id)), 8, '0') || '#00ff"}}'"""


def records(spark: SparkSession, d: str) -> DataFrame:
    """Events as archive records, ts a timestamp."""
    k = F.col("event_id")
    return events(spark, d).select(
        "event_id", "ts", F.when(k % 3 != 0, (F.floor(k / 2) + (k % 2) * 0.5).cast("double")).alias("mono"), F.concat(F.lit("u"), F.col("user_id")).alias("device_id"),
        F.when(k % 4 != 0, "can0").alias("src"), F.lit("n2k").alias("proto"), F.concat(F.lpad(F.lower(F.hex(k)), 8, "0"), F.lit("#00ff")).alias("raw"),
    )


def line() -> Column:
    return archive.record_line(*(F.col(c) for c in RAW_FIELDS))


@registered(QUERIES, ORACLES, f"SELECT event_id, {LINE} AS line FROM events")
def serialize_record(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("event_id", line().alias("line"))


HASHED = "substr(sha256(CAST(event_id AS VARCHAR)), 1, 16)"


def keyed(spark: SparkSession, d: str) -> DataFrame:
    """A key for each event: its day and time, a protocol, and a hash of its number."""
    cid = F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 16)
    proto = F.when(F.col("event_id") % 5 == 0, "n0183").otherwise("n2k")
    parts = {"day": F.to_date("ts"), "time_of_day": F.date_format("ts", "HHmmss"), "proto": proto, "cid": cid}
    return events(spark, d).withColumns(parts)


KEYED = f"k AS (SELECT event_id, ts, strftime(ts, '%H%M%S') AS tod, CASE WHEN event_id % 5 = 0 THEN 'n0183' ELSE 'n2k' END AS proto, {HASHED} AS cid FROM events)"
KEY = "'raw/' || strftime(ts, '%Y/%m/%d') || '/' || tod || '-' || proto || '-' || cid || '.ndjson.gz'"


def built_key() -> Column:
    return archive.build_key(F.col("proto"), F.col("day"), F.col("time_of_day"), F.col("cid"))


@registered(QUERIES, ORACLES, f"WITH {KEYED} SELECT event_id, {KEY} AS key FROM k")
def build_key(spark: SparkSession, d: str) -> DataFrame:
    return keyed(spark, d).select("event_id", built_key().alias("key"))


@registered(QUERIES, ORACLES, f"WITH {KEYED} SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day, CASE WHEN event_id % 7 <> 0 THEN tod END AS time_of_day, CASE WHEN event_id % 7 <> 0 THEN proto END AS proto FROM k")
def key_parse(spark: SparkSession, d: str) -> DataFrame:
    """Malformed keys have no parts."""
    key = F.when(F.col("event_id") % 7 == 0, F.regexp_replace(built_key(), "raw/2024", "raw/20x4")).otherwise(built_key())
    return keyed(spark, d).select("event_id", archive.key_parts(key).alias("p")).select("event_id", "p.day", "p.time_of_day", "p.proto")


@registered(QUERIES, ORACLES, f"WITH {KEYED} SELECT event_id, 'disk.' || strftime(ts, '%Y%m%d') || '_' || tod || '-' || proto || '-' || cid || '.ndjson.gz' AS spool, {KEY} AS key FROM k")
def spool_key(spark: SparkSession, d: str) -> DataFrame:
    name = archive.spool_name(F.col("day"), F.col("time_of_day"), F.col("proto"), F.col("cid"))
    return keyed(spark, d).select("event_id", name.alias("spool"), archive.spool_to_key(name).alias("key"))


@registered(QUERIES, ORACLES, f"WITH {KEYED} SELECT {KEY} AS key FROM k WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' AND proto = 'n0183'")
def list_keys_pruned(spark: SparkSession, d: str) -> DataFrame:
    return archive.prune_keys(keyed(spark, d).select(built_key().alias("key")), date(2024, 1, 5), date(2024, 1, 9), "n0183").select("key")


@registered(QUERIES, ORACLES, """SELECT event_id, 'all' AS asked, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'export' ELSE 'update' END AS application, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' AND event_id % 4 <> 3
UNION ALL SELECT event_id, 'export', 'export', CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' AND event_id % 4 = 1""")
def list_log_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys with and without an application, all and one application's; malformed ones are skipped."""
    k, end = F.col("event_id") % 4, F.concat(F.date_format("ts", "yyyy/MM/dd"), F.lit("/120000-00000000.json"))
    key = F.when(k == 0, F.concat(F.lit("_log/"), end)).when(k == 1, F.concat(F.lit("_log/export/"), end)).when(k == 2, F.concat(F.lit("_log/update/"), end)).otherwise(F.lit("_log/malformed.json"))
    keys = events(spark, d).select("event_id", key.alias("key"))
    asked = {"all": None, "export": "export"}
    found = [archive.prune_log_keys(keys, date(2024, 1, 5), date(2024, 1, 9), a).select("event_id", F.lit(name).alias("asked"), "application", "day") for name, a in asked.items()]
    return found[0].unionByName(found[1])


@registered(QUERIES, ORACLES, f"""WITH l AS (SELECT CAST(ts AS DATE) AS day, {LINE} AS line, event_id FROM events)
SELECT day, substr(sha256(string_agg(line || chr(10), '' ORDER BY event_id)), 1, 16) AS cid, count(*) AS rows FROM l GROUP BY day""")
def content_id(spark: SparkSession, d: str) -> DataFrame:
    """A day's lines are hashed in order as they stream through a task."""
    return archive.write_objects(records(spark, d).withColumn("day", F.to_date("ts")), None, ["day"], ["event_id"]).select("day", "cid", "rows")


@registered(QUERIES, ORACLES, """WITH c AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day, CASE WHEN lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY event_id) IS NOT DISTINCT FROM CAST(ts AS DATE) THEN 0 ELSE 1 END AS c FROM events),
r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS object FROM c) SELECT user_id, CAST(object AS BIGINT) AS object, min(day) AS day, count(*) AS rows FROM r GROUP BY user_id, object""")
def split_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Runs of one day in each user's records, by event number: a day that comes again is another object."""
    cut = archive.split_objects(events(spark, d), ["event_id"], ["user_id"])
    return cut.groupBy("user_id", F.col("object").cast("long").alias("object")).agg(F.min(F.to_date("ts")).alias("day"), F.count("*").alias("rows"))


@registered(QUERIES, ORACLES, """SELECT user_id, event_id, sum(length(props)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) <= 500 AS kept FROM events""")
def buffer_evict(spark: SparkSession, d: str) -> DataFrame:
    """A buffer of 500 characters for each user: the newest stay."""
    sized = events(spark, d).withColumn("size", F.length("props"))
    return resample.keep_newest(sized, "size", 500, [F.desc("ts"), F.desc("event_id")], ["user_id"]).select("user_id", "event_id", "kept")


@registered(QUERIES, ORACLES, """WITH k AS (SELECT user_id, sum(length(props)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) <= 500 AS kept FROM events)
SELECT user_id, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS dropped FROM k GROUP BY user_id""")
def buffer_dropped(spark: SparkSession, d: str) -> DataFrame:
    """What a full buffer drops is counted."""
    sized = events(spark, d).withColumn("size", F.length("props"))
    return resample.evictions(resample.keep_newest(sized, "size", 500, [F.desc("ts"), F.desc("event_id")], ["user_id"]), ["user_id"])


@registered(QUERIES, ORACLES, f"""SELECT event_id, epoch_us(ts) AS micros, CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE 'can0' END AS src, lpad(lower(printf('%x', event_id)), 8, '0') || '#00ff' AS raw FROM events WHERE event_id % 7 <> 3""")
def capture_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a live bus to records and back to what they were; lines out of form give none."""
    r = records(spark, d)
    line = export.candump_line(F.col("ts"), F.col("src"), F.col("proto"), F.col("raw"))
    got = r.select("event_id", capture.candump_fields(F.when(F.col("event_id") % 7 == 3, F.concat(line, F.lit("0"))).otherwise(line)).alias("f"))
    return got.where("f is not null").select("event_id", F.unix_micros("f.ts").alias("micros"), "f.src", "f.raw")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder; a temporary one in local mode only, where none is set, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}" if base else f"file://{tempfile.mkdtemp(prefix=f'tidewake-{name}-')}"


def stored(spark: SparkSession, d: str, rows: DataFrame | None = None) -> str:
    """Write records of all days, those of the events unless given, into an archive, one object a day and protocol; returns its root."""
    root = scratch(spark, "archive")
    r = (records(spark, d) if rows is None else rows).withColumn("day", F.to_date("ts"))
    archive.write_objects(r, root, ["day", "proto"], ["event_id"]).count()
    return root


@registered(QUERIES, ORACLES, f"SELECT CAST(ts AS DATE) AS day, {ISO} AS ts, 'u' || user_id AS device_id, lpad(lower(printf('%x', event_id)), 8, '0') || '#00ff' AS raw FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06'")
def scan_raw_records(spark: SparkSession, d: str) -> DataFrame:
    """Three days read back from compressed objects; others are not opened."""
    got = archive.read_archive(spark, stored(spark, d), date(2024, 1, 3), date(2024, 1, 5), "n2k")
    return got.select(archive.key_parts(F.col("object_key"))["day"].alias("day"), "ts", "device_id", "raw")


@registered(QUERIES, ORACLES, "SELECT CASE WHEN day(ts) % 2 = 0 THEN 'export' ELSE 'import' END AS application, CAST(day(ts) % 3 AS INT) AS exit_code, CAST(count(*) AS VARCHAR) AS rx FROM events GROUP BY day(ts), CAST(ts AS DATE)")
def scan_audit(spark: SparkSession, d: str) -> DataFrame:
    """An entry a day with the number of its events, written and read back."""
    root = scratch(spark, "audit")
    for r in events(spark, d).groupBy(F.to_date("ts").alias("day")).count().toLocalIterator():
        audit.publish(root, audit.Account("export" if r["day"].day % 2 == 0 else "import", "a day", {"rx": r["count"]}, r["day"].day % 3))
    return archive.read_audit(spark, f"{root}/_log/*/*/*/*/*.json").select("application", "exit_code", F.try_element_at("details", F.lit("rx")).alias("rx"))


@registered(QUERIES, ORACLES, "SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts END AS ts FROM events")
def valid_ts(spark: SparkSession, d: str) -> DataFrame:
    """UTC text passes; naive and other offsets do not."""
    k, text = F.col("event_id") % 4, iso_utc(F.col("ts"))
    text = F.when(k == 0, text).when(k == 1, F.regexp_replace(text, r"\+00:00$", "Z")).when(k == 2, F.regexp_replace(text, r"\+00:00$", "")).otherwise(F.regexp_replace(text, r"\+00:00$", "+02:00"))
    return events(spark, d).select("event_id", plain(utc_timestamp(text)).alias("ts"))


NAMES = ("n2k", "n0183", "seatalk", "sk.delta", "signalk-delta", "sea_talk", "N2K", "n2k#1", "", "wind_speed", "1st", "x" * 63, "x" * 64)


NAME_LIST = ", ".join(f"('{n}')" for n in NAMES)


@registered(QUERIES, ORACLES, f"""WITH n AS (SELECT name FROM (VALUES {NAME_LIST}) t(name) UNION SELECT p_name FROM part UNION SELECT lower(replace(p_name, ' ', '_')) FROM part)
SELECT name, regexp_matches(name, '^[a-z0-9][a-z0-9.]*$') AS proto, regexp_matches(name, '^[a-z][a-z0-9_]{{0,62}}$') AS col, regexp_matches(name, '^[a-z0-9][a-z0-9._-]*$') AS application FROM n""")
def name_validity(spark: SparkSession, d: str) -> DataFrame:
    """Names that were met, and those of all parts, as they are and with underscores."""
    part = spark.read.parquet(f"{d}/part.parquet").select("p_name")
    names = spark.createDataFrame([(n,) for n in NAMES], "name string").union(part).union(part.select(F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))))).distinct()
    return names.select("name", *(F.col("name").rlike(p).alias(c) for c, p in (("proto", PROTO), ("col", COLUMN), ("application", APPLICATION))))


@registered(QUERIES, ORACLES, "SELECT CASE WHEN event_id % 2 = 0 THEN 'n2k' ELSE 'n0183' END AS proto, count(*) AS rows, min(event_id) AS first FROM events GROUP BY 1")
def union_protocols(spark: SparkSession, d: str) -> DataFrame:
    """All protocols have one schema, so a bag union is one stream."""
    r = records(spark, d)
    both = r.where("event_id % 2 = 0").unionByName(r.where("event_id % 2 = 1").withColumn("proto", F.lit("n0183")))
    return both.groupBy("proto").agg(F.count("*").alias("rows"), F.min("event_id").alias("first"))


@registered(QUERIES, ORACLES, "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20'")
def closed_days(spark: SparkSession, d: str) -> DataFrame:
    """At two minutes past midnight of the 21st, the 20th is not closed yet: the lag is five minutes."""
    days = events(spark, d).select(F.to_date("ts").alias("day")).distinct()
    return resample.closed_days(days, F.lit("2024-01-21 00:02:00").cast("timestamp"))


def exported(spark: SparkSession, root: str, request: export.Request) -> tuple[DataFrame, export.Outcome]:
    """The lines of the file that an export wrote, and its outcome."""
    file = f"{scratch(spark, 'export')}/{request.file_name()}"
    got = export.export(spark, root, file, request)
    return spark.read.option("lineSep", "\n").text(file).select(F.rtrim(F.col("value"), F.lit("\r")).alias("line")), got


CANDUMP = "'(' || epoch_us(ts) // 1000000 || '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') || ') ' || CASE WHEN event_id % 4 = 0 THEN 'unknown' ELSE 'can0' END || ' ' || lpad(upper(printf('%x', event_id)), 8, '0') || '#00FF'"


@registered(QUERIES, ORACLES, f"SELECT {CANDUMP} AS line FROM events WHERE event_id % 9 <> 8 AND event_id % 9 <> 4 UNION ALL SELECT 'refused ' || count(*) FROM events WHERE event_id % 9 = 4")
def export_candump(spark: SparkSession, d: str) -> DataFrame:
    """The file of all frames. Other protocols are never read; frames out of form are counted and left out."""
    k = F.col("event_id") % 9
    r = records(spark, d).withColumns({"proto": F.when(k == 8, "n0183").otherwise("n2k"), "raw": F.when(k == 4, F.concat("raw", F.lit("0"))).otherwise(F.col("raw"))})
    request = export.Request(fmt="candump")
    lines, got = exported(spark, stored(spark, d, r), request)
    return lines.unionByName(spark.createDataFrame([(f"refused {got.rows_refused}",)], "line string"))


@registered(QUERIES, ORACLES, f"SELECT {LINE} AS line FROM events")
def export_ndjson(spark: SparkSession, d: str) -> DataFrame:
    """The file of all records is theirs as they were written."""
    return exported(spark, stored(spark, d), export.Request())[0]


MONO = "CASE WHEN event_id % 3 = 0 THEN '' ELSE event_id // 2 || CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '.5' END END"


@registered(QUERIES, ORACLES, f'''SELECT 'ts,mono,device_id,src,proto,raw' AS line UNION ALL
SELECT {ISO} || ',' || {MONO} || ',u' || user_id || ',' || CASE WHEN event_id % 4 = 0 THEN '' ELSE 'can0' END || ',n2k,"' || event_id || ', ""quoted"""' FROM events''')
def export_csv(spark: SparkSession, d: str) -> DataFrame:
    """The file of all records: a header, nulls empty, quotes doubled."""
    r = records(spark, d).withColumn("raw", F.concat(F.col("event_id"), F.lit(', "quoted"')))
    return exported(spark, stored(spark, d, r), export.Request(fmt="csv"))[0]


@registered(QUERIES, ORACLES, """SELECT CASE WHEN day(ts) % 2 = 0 THEN 'export' ELSE 'import' END || ',h,' || day(ts) % 3 || ',"a, day","{""a"":""' || count(*) || '"",""z"":""' || max(event_id) || '""}"' AS line FROM events GROUP BY day(ts), CAST(ts AS DATE)""")
def export_log_csv(spark: SparkSession, d: str) -> DataFrame:
    """Audit entries as CSV: nested values are JSON with sorted keys. Time and host are left out here."""
    root = scratch(spark, "audit")
    for r in events(spark, d).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.max("event_id").alias("z")).toLocalIterator():
        audit.publish(root, audit.Account("export" if r["day"].day % 2 == 0 else "import", "a, day", {"z": r["z"], "a": r["n"]}, r["day"].day % 3))
    lines, _ = exported(spark, root, export.Request(source="_log", fmt="csv"))
    return lines.where(~F.col("line").startswith("timestamp,")).select(F.regexp_replace("line", r"^[^,]*,([a-z]+),[^,]*,", "$1,h,").alias("line"))


def legacy_rows(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select(F.col("ts").alias("received_at"), F.concat(F.lit("u"), F.col("user_id") % 5).alias("device_id"), F.when(F.col("event_id") % 4 != 0, "10.0.0.7").alias("source_ip"), F.concat(F.lit("$X"), F.col("event_id")).alias("raw_data"), F.lit("XXX").alias("sentence_type"))


@registered(QUERIES, ORACLES, "SELECT ts, 'u' || user_id % 5 AS device_id, CASE WHEN event_id % 4 <> 0 THEN '10.0.0.7' END AS src, 'n0183' AS proto, '$X' || event_id AS raw FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08' AND user_id % 5 IN (1, 3)")
def import_day_scan(spark: SparkSession, d: str) -> DataFrame:
    got = legacy.day_scan(legacy_rows(spark, d), date(2024, 1, 5), date(2024, 1, 7), ["u1", "u3"])
    return got.select(plain("ts").alias("ts"), "device_id", "src", "proto", "raw")


@registered(QUERIES, ORACLES, "SELECT CAST(min(ts) AS DATE) AS day FROM events")
def earliest_day(spark: SparkSession, d: str) -> DataFrame:
    return archive.first_day(legacy_rows(spark, d))


IMPORT_LINE = f"""'{{"ts":"' || {ISO} || '","mono":null,"device_id":"u' || user_id % 5 || '","src":' || CASE WHEN event_id % 4 = 0 THEN 'null' ELSE '"10.0.0.7"' END || ',"proto":"n0183","raw":"$X' || event_id || '"}}'"""


@registered(QUERIES, ORACLES, f"""WITH l AS (SELECT CAST(ts AS DATE) AS day, ts, 'u' || user_id % 5 AS dev, '$X' || event_id AS raw, {IMPORT_LINE} AS line FROM events),
o AS (SELECT day, 'raw/' || strftime(day, '%Y/%m/%d') || '/' || strftime(min(ts), '%H%M%S') || '-n0183-' || substr(sha256(string_agg(line || chr(10), '' ORDER BY ts, dev, raw)), 1, 16) || '.ndjson.gz' AS key FROM l GROUP BY day),
d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day, key, CASE WHEN key IS NULL THEN 'empty' WHEN day(day) % 2 = 0 THEN 'up-to-date' ELSE 'upload' END AS state FROM d LEFT JOIN o USING (day)""")
def import_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Even days are imported; then days whose object is there are up to date, others would be uploaded, days without rows are empty."""
    root, rows = scratch(spark, "import"), legacy_rows(spark, d)
    now = datetime(2024, 2, 3, 1, tzinfo=timezone.utc)
    legacy.import_days(spark, rows.where(F.dayofmonth("received_at") % 2 == 0), root, date(2024, 1, 1), live=True, now=now)
    days = legacy.import_days(spark, rows, root, date(2024, 1, 1), now=now)
    return spark.createDataFrame([(r["day"], r["key"], r["state"]) for r in days], "day date, key string, state string")


@registered(QUERIES, ORACLES, """WITH k AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS key, min(ts) OVER (PARTITION BY CAST(ts AS DATE)) AS f FROM events)
SELECT key, CASE WHEN right(key, 1) <> '3' THEN date_trunc('hour', f) END AS first_ts FROM k""")
def ledger_rows(spark: SparkSession, d: str) -> DataFrame:
    """An object without observations has its ledger row too."""
    e = events(spark, d).select(F.date_format("ts", "yyyy-MM-dd").alias("object_key"), F.date_trunc("hour", "ts").alias("bucket_ts"))
    rows = merge.ledger_rows(e.select(F.col("object_key").alias("key")).distinct(), e.where(~F.col("object_key").endswith("3")))
    return rows.select("key", plain("first_ts").alias("first_ts"))
