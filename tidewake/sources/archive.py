"""The immutable archive: keys, pruned listing, reading, and writing of content-addressed objects."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.times import iso_utc, utc_timestamp
from ..operators.resample import runs_by
from ..schema import AUDIT, PROTO, RAW, RAW_FIELDS, check_name
from .segments import durable_move

#: Days up to which a listing goes day by day; beyond, month by month.
MANY_DAYS = 31

#: All days that a key can have.
FIRST_DAY, LAST_DAY = date(1000, 1, 1), date(9999, 12, 31)

KEY = r"^raw/([0-9]{4})/([0-9]{2})/([0-9]{2})/([0-9]{6})-([a-z0-9][a-z0-9.]*)-([0-9a-f]{16})\.ndjson\.gz$"
SPOOL = r"^disk\.([0-9]{8})_([0-9]{6})-([a-z0-9][a-z0-9.]*)-([0-9a-f]{16})\.ndjson\.gz$"


def build_key(proto: Column, day: Column, time_of_day: Column, cid: Column) -> Column:
    """raw/yyyy/mm/dd/HHMMSS-proto-cid.ndjson.gz"""
    return F.concat(F.lit("raw/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/"), time_of_day, F.lit("-"), proto, F.lit("-"), cid, F.lit(".ndjson.gz"))


def key_parts(key: Column) -> Column:
    """struct(day, time_of_day, proto, cid); all null for a malformed key."""
    def part(k: int) -> Column:
        text = F.regexp_extract(key, KEY, k)
        return F.when(text != "", text)

    day = F.try_to_date(F.concat_ws("-", *(F.regexp_extract(key, KEY, k) for k in (1, 2, 3))))
    return F.struct(day.alias("day"), *(F.when(day.isNotNull(), part(k)).alias(n) for k, n in ((4, "time_of_day"), (5, "proto"), (6, "cid"))))


def spool_name(day: Column, time_of_day: Column, proto: Column, cid: Column) -> Column:
    return F.concat(F.lit("disk."), F.date_format(day, "yyyyMMdd"), F.lit("_"), time_of_day, F.lit("-"), proto, F.lit("-"), cid, F.lit(".ndjson.gz"))


def spool_to_key(name: Column) -> Column:
    """The archive key of a spool file; null for another name."""
    key = F.regexp_replace(name, r"^disk\.([0-9]{4})([0-9]{2})([0-9]{2})_(.*)$", r"raw/$1/$2/$3/$4")
    return F.when(name.rlike(SPOOL), key)


def log_key_parts(key: Column) -> Column:
    """struct(application, day) of an audit key: _log/app/yyyy/mm/dd/name or, older, _log/yyyy/mm/dd/name; null otherwise."""
    parts = F.split(key, "/")
    size = F.size(parts)

    def day(k: int) -> Column:
        text = F.concat_ws("-", F.get(parts, k), F.get(parts, k + 1), F.get(parts, k + 2))
        return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text))

    at = F.when(size == 6, day(2)).when(size == 5, day(1))
    return F.struct(F.when(at.isNotNull() & (size == 6), F.get(parts, 1)).alias("application"), F.when(F.get(parts, 0) == "_log", at).alias("day"))


def prune_keys(keys: DataFrame, since: date, until: date, proto: str | None = None) -> DataFrame:
    """Keys (column key) of capture objects filed from since to until, both included, of one protocol if named; with their parts."""
    parsed = keys.withColumn("_k", key_parts(F.col("key"))).where(F.col("_k.day").between(F.lit(since), F.lit(until)))
    parsed = parsed.where(F.col("_k.proto") == proto) if proto else parsed
    return parsed.select(*keys.columns, "_k.day", "_k.time_of_day", "_k.proto", "_k.cid")


def prune_log_keys(keys: DataFrame, since: date, until: date, application: str | None = None) -> DataFrame:
    parsed = keys.withColumn("_k", log_key_parts(F.col("key"))).where(F.col("_k.day").between(F.lit(since), F.lit(until)))
    parsed = parsed.where(F.col("_k.application") == application) if application else parsed
    return parsed.select(*keys.columns, "_k.application", "_k.day")


def object_glob(proto: str | None = None) -> str:
    """Names of one protocol's objects: it is part of the name, so others are never opened."""
    return f"*-{check_name(proto, PROTO)}-*.ndjson.gz" if proto else "*.ndjson.gz"


def folders(spark: SparkSession, root: str, since: date, until: date) -> list[str]:
    """Folders that hold the objects filed from since to until: days of a short span, else months. Objects themselves are listed by Spark."""
    base = f"{root.rstrip('/')}/raw"
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.Path(base).getFileSystem(conf)
    if (until - since).days < MANY_DAYS:
        wanted = [f"{base}/{since + timedelta(days=k):%Y/%m/%d}" for k in range((until - since).days + 1)]
        return [p for p in wanted if files.exists(jvm.org.apache.hadoop.fs.Path(p))]
    found = files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base}/[0-9][0-9][0-9][0-9]/[0-9][0-9]")) or []
    paths = (f.getPath().toString() for f in found)
    return sorted(p for p in paths if f"{since:%Y/%m}" <= p[-7:] <= f"{until:%Y/%m}")


def listed(spark: SparkSession, root: str, since: date = FIRST_DAY, until: date = LAST_DAY, proto: str | None = None) -> DataFrame:
    """key and path of the capture objects filed from since to until; names only, no object is opened."""
    paths = folders(spark, root, since, until)
    if not paths:
        return spark.createDataFrame([], "key string, path string")
    names = spark.read.format("binaryFile").option("pathGlobFilter", object_glob(proto)).option("recursiveFileLookup", True).load(paths).select("path")
    keyed = names.select(key_of(F.col("path")).alias("key"), "path")
    return prune_keys(keyed, since, until, proto).select("key", "path")


def key_of(path: Column) -> Column:
    return F.concat(F.lit("raw/"), F.regexp_extract(path, r"/raw/([0-9]{4}/.*)$", 1))


def rank_of(key: Column) -> Column:
    """A number that orders objects by day, time and content: seconds since 1970, then 29 bits of the content's hash.

    Two objects of one second rank alike with a chance of 2^-29; their order is then that of their rows' seq.
    """
    parts = key_parts(key)
    seconds = F.unix_date(parts.day).cast("bigint") * 86400 + F.substring(parts.time_of_day, 1, 2).cast("bigint") * 3600 + F.substring(parts.time_of_day, 3, 2).cast("bigint") * 60 + F.substring(parts.time_of_day, 5, 2).cast("bigint")
    return F.shiftleft(seconds, 29) + F.shiftright(F.conv(F.substring(parts.cid, 1, 8), 16, 10).cast("bigint"), 3)


CORRUPT = "_corrupt"


def read_objects(spark: SparkSession, paths: list[str], glob: str = "*.ndjson.gz", corrupt: str = "raise") -> DataFrame:
    """Records of the objects in these folders or files: RAW, with object_key, object_rank and seq.

    Blank lines are skipped, and rows in file order get an increasing seq right at the
    scan. A line that is no JSON object is an error that names its object; with
    corrupt="keep" it comes as a row of nulls, its text in column _corrupt, and an
    object whose compression breaks off ends there (check_objects tells which do).
    """
    if corrupt not in ("raise", "keep"):
        raise ValueError(f"corrupt must be raise or keep, not {corrupt!r}")
    kept = [CORRUPT] if corrupt == "keep" else []
    if not paths:
        return spark.createDataFrame([], f"{RAW}, object_key STRING, object_rank LONG, seq LONG" + f", {CORRUPT} STRING" * len(kept))
    rows = spark.read.schema(f"{RAW}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("ignoreCorruptFiles", bool(kept)).json(paths)
    # Spark reads no column of corrupt records alone, so another is asked for with it.
    corrupt_text = F.when(F.length(F.coalesce("ts", F.lit(""))) >= 0, F.col(CORRUPT)).alias(CORRUPT)
    rows = rows.select(*RAW_FIELDS, corrupt_text, key_of(F.col("_metadata.file_path")).alias("object_key"), F.monotonically_increasing_id().alias("seq"))
    if not kept:
        whole = F.col(CORRUPT).isNull() | F.raise_error(F.concat(F.lit("corrupt record in "), "object_key")).cast("boolean")
        rows = rows.where(whole)
    return rows.select(*RAW_FIELDS, "object_key", rank_of(F.col("object_key")).alias("object_rank"), "seq", *kept)


def read_archive(spark: SparkSession, root: str, since: date, until: date, proto: str | None = None, corrupt: str = "raise") -> DataFrame:
    """Records of the capture objects in a range of days, both included; see read_objects."""
    rows = read_objects(spark, folders(spark, root, since, until), object_glob(proto), corrupt)
    return rows.where((F.col("object_key") >= f"raw/{since:%Y/%m/%d}") & (F.col("object_key") < f"raw/{until:%Y/%m/%d}0"))


def check_objects(spark: SparkSession, objects: DataFrame) -> DataFrame:
    """objects (key, path) with what is wrong with each as a file, if anything: its compression breaks off, or a line cannot be an object of JSON. No JSON is parsed here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [object_state(p) for p in batch.column("path").to_pylist()]
            yield pa.record_batch([batch.column("key"), batch.column("path"), pa.array(found, pa.string())], ["key", "path", "error"])

    return objects.select("key", "path").mapInArrow(run, "key string, path string, error string")


def object_state(path: str) -> str | None:
    try:
        with open_object(path) as f, gzip.open(f) as lines:
            for line in lines:
                if line.lstrip()[:1] not in (b"{", b""):
                    raise ValueError("not an object")
    except (OSError, EOFError, ValueError, zlib.error) as e:
        return f"{type(e).__name__}: {e}"[:200]
    return None


def open_object(path: str):
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(re.sub("^file:/(?=[^/])", "file:///", path) if "://" in path or path.startswith("file:") else f"file://{path}")
    return store.open_input_stream(place, compression=None)


def valid_records(records: DataFrame) -> DataFrame:
    """records with ts as a timestamp; rows whose ts is missing, malformed or without a UTC offset are dropped."""
    return records.withColumn("ts", utc_timestamp(F.col("ts"))).where(F.col("ts").isNotNull())


def read_audit(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Audit entries: each object is one JSON document."""
    return spark.read.schema(AUDIT).option("multiLine", True).json(paths)


def record_line(ts: Column, mono: Column, device_id: Column, src: Column, proto: Column, raw: Column) -> Column:
    """One compact JSON line of the six fields in order, nulls kept; null where ts is null or the protocol's name is not valid."""
    row = F.struct(iso_utc(ts).alias("ts"), F.round(mono, 6).alias("mono"), device_id.alias("device_id"), src.alias("src"), proto.alias("proto"), raw.alias("raw"))
    return F.when(ts.isNotNull() & proto.rlike(PROTO), F.to_json(row, {"ignoreNullFields": "false"}))


def content_id(lines: Column) -> Column:
    """First 16 hex digits of the SHA-256 of an array of lines, each ended by a line break."""
    return F.substring(F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256), 1, 16)


def split_objects(records: DataFrame, order: list[str], batch: list[str] = ()) -> DataFrame:
    """records with object: consecutive records of one UTC day in a batch make one object (a midnight in between makes two)."""
    return runs_by(records, F.to_date("ts"), order, list(batch)).withColumnRenamed("run", "object")


WRITTEN = "key string, rows long, cid string, state string"


def write_objects(records: DataFrame, root: str | None, object_by: list[str], order: list[str | Column]) -> DataFrame:
    """Write each object's records as a gzip file under its key; returns the columns of object_by with key, rows, cid and state.

    state: uploaded; up-to-date where an object of that name is there already; with no
    root, upload: nothing is written. An object is streamed, hashed and compressed
    line by line in one task. The name follows from the content, so a repeated task
    finds its file, and no reader sees a part of one.
    """
    columns = [c for c in order if isinstance(c, str)]
    extra = [c for c in records.columns if c not in (*object_by, *columns, "ts", "proto")] if len(columns) < len(order) else []
    lined = records.select(*dict.fromkeys([*object_by, *columns, "ts", "proto", *extra]), record_line(*(F.col(c) for c in RAW_FIELDS)).alias("_line")).where("_line is not null")
    stood = lined.repartition(*object_by).sortWithinPartitions(*object_by, *order)
    read = stood.select(*object_by, F.date_format("ts", "yyyy/MM/dd/HHmmss").alias("_time"), F.col("proto").alias("_proto"), "_line")
    names = [*object_by, "key", "rows", "cid", "state"]
    schema = T.StructType([*(records.schema[c] for c in object_by), *T.StructType.fromDDL(WRITTEN).fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            groups = list(zip(*(batch.column(c).to_pylist() for c in object_by), strict=True))
            lines = batch.column("_line")
            begin = 0
            for k in range(1, len(groups) + 1):
                if k < len(groups) and groups[k] == groups[begin]:
                    continue
                if held is None or groups[begin] != now:
                    if held is not None:
                        yield row(now, held.close())
                    now, held = groups[begin], ObjectFile(root, batch.column("_time")[begin].as_py(), batch.column("_proto")[begin].as_py())
                held.write(lines.slice(begin, k - begin).to_pylist())
                begin = k
        if held is not None:
            yield row(now, held.close())

    def row(group: tuple, written: tuple) -> pa.RecordBatch:
        return pa.record_batch([pa.array([v], kinds.field(n).type) for n, v in zip(names, (*group, *written), strict=True)], names)

    return read.mapInArrow(run, schema)


class ObjectFile:
    """One object, written under a name of its own until its content's hash is known."""

    def __init__(self, root: str | None, time: str, proto: str):
        self.prefix, self.rows, self.hash = f"raw/{time}-{proto}", 0, hashlib.sha256()
        self.out = None
        if root is not None:
            from pyarrow import fs

            self.store, self.root = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
            self.part = f"{self.root}/raw/{time[:10]}/_part-{uuid.uuid4().hex}"
            self.store.create_dir(self.part.rsplit("/", 1)[0], recursive=True)
            self.stream = self.store.open_output_stream(self.part, compression=None)
            self.out = gzip.GzipFile("", "wb", 9, self.stream, mtime=0)

    def write(self, lines: list[str]) -> None:
        text = "".join(x + "\n" for x in lines).encode()
        self.hash.update(text)
        self.rows += len(lines)
        if self.out is not None:
            self.out.write(text)

    def close(self) -> tuple[str, int, str, str]:
        cid = self.hash.hexdigest()[:16]
        key, state = f"{self.prefix}-{cid}.ndjson.gz", "upload"
        if self.out is not None:
            self.out.close()
            self.stream.close()
            state = "uploaded" if self.store.get_file_info(f"{self.root}/{key}").type.name == "NotFound" else "up-to-date"
            if state == "uploaded":
                durable_move(self.store, self.part, f"{self.root}/{key}")
            else:
                self.store.delete_file(self.part)
        return key, self.rows, cid, state


def lines_of(path: str) -> Iterator[str]:
    """The lines of one object, for checks."""
    with gzip.open(path, "rt") as f:
        yield from (x.rstrip("\n") for x in f if x.strip())


def earliest_day(table: DataFrame, ts: str = "received_at") -> date | None:
    """The first UTC day of a legacy table; None if it is empty. Times without a zone are refused: their day is a guess."""
    return first_day(table, ts).first()["day"]


def first_day(table: DataFrame, ts: str = "received_at") -> DataFrame:
    """The same as a row of day."""
    refuse_naive(table, ts)
    return table.agg(F.to_date(F.min(ts)).alias("day"))


def refuse_naive(table: DataFrame, ts: str) -> None:
    if table.schema[ts].dataType != T.TimestampType():
        raise ValueError(f"{ts} is no timestamp with a time zone: cast it where it is read")
