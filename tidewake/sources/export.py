"""Exports of records and audit entries: ndjson, CSV and candump text."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.bits import can_identifier, can_payload
from ..functions.times import utc_timestamp
from ..plans import store
from ..schema import AUDIT, AUDIT_FIELDS, RAW_FIELDS
from .archive import FIRST_DAY, LAST_DAY, check_objects, folders, listed, object_glob, prune_log_keys, read_objects

UNKNOWN_INTERFACE = "unknown"


def ndjson_line(columns: list[str]) -> Column:
    """A compact JSON object of the columns in order, nulls and nested values kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def sorted_json(m: Column) -> Column:
    """A map as a JSON object with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def csv_text(table: DataFrame, columns: list[str]) -> Column:
    """A row of CSV: maps as JSON with sorted keys, nulls empty, quoted where needed."""
    kinds = dict(table.dtypes)

    def quoted(c: str) -> Column:
        x = F.coalesce((sorted_json(F.col(c)) if kinds[c].startswith("map") else F.col(c)).cast("string"), F.lit(""))
        return F.when(x.rlike('[",\r\n]'), F.concat(F.lit('"'), F.regexp_replace(x, '"', '""'), F.lit('"'))).otherwise(x)

    return F.concat_ws(",", *(quoted(c) for c in columns))


def csv_line(table: DataFrame, columns: list[str]) -> DataFrame:
    """One column line: CSV rows."""
    return table.select(csv_text(table, columns).alias("line"))


def candump_line(ts: Column, src: Column, proto: Column, raw: Column) -> Column:
    """(seconds.micros) interface IDENTIFIER#DATA; null for what has no such form: other protocols, malformed or over 8 bytes."""
    identifier = can_identifier(raw)["can_id"]
    payload = can_payload(raw)
    good = (proto == "n2k") & ts.isNotNull() & identifier.isNotNull() & payload.isNotNull() & (F.length(payload) <= 16)
    micros = F.lpad(F.pmod(F.unix_micros(ts), F.lit(1_000_000)).cast("string"), 6, "0")
    interface = F.when(src != "", src).otherwise(UNKNOWN_INTERFACE)
    line = F.concat(F.lit("("), F.unix_seconds(ts).cast("string"), F.lit("."), micros, F.lit(") "), interface, F.lit(" "), F.lpad(F.hex(identifier), 8, "0"), F.lit("#"), payload)
    return F.when(good, line)


def csv_header(columns: list[str]) -> str:
    return ",".join(columns)


#: Source -> its fields in order. A new field has to be named here to be exported.
FIELDS = {"raw": RAW_FIELDS, "_log": AUDIT_FIELDS}
FORMATS = ("candump", "csv", "ndjson")
#: Status of an export that left something out.
INCOMPLETE = 2


@dataclass
class Request:
    """What to export; a combination that has no meaning is refused before anything is read."""

    source: str = "raw"
    fmt: str = "ndjson"
    proto: str | None = None
    application: str | None = None
    since: date = FIRST_DAY
    until: date = LAST_DAY

    def __post_init__(self) -> None:
        if self.source not in FIELDS or self.fmt not in FORMATS:
            raise ValueError(f"no such source or format: {self.source!r}, {self.fmt!r}")
        if self.proto and self.source != "raw":
            raise ValueError("proto applies to captured records only; audit entries have none")
        if self.application and self.source != "_log":
            raise ValueError("application applies to audit entries only; captured records have none")
        if self.fmt == "candump":
            # A line is one CAN frame, so only that protocol is read at all.
            if self.source != "raw" or self.proto not in (None, "n2k"):
                raise ValueError("candump lines are CAN frames: captured records of protocol n2k")
            self.proto = "n2k"

    def file_name(self, now: datetime | None = None) -> str:
        now = now or datetime.now(timezone.utc)
        return f"{now:%Y%m%dT%H%M%SZ}-{self.proto or self.application or self.source}.{self.fmt}"


@dataclass
class Outcome:
    """objects_failed: (key, reason) of objects that could not be read and are left out whole; rows_refused: rows that have no such line."""

    objects_read: int
    objects_failed: list[tuple[str, str]]
    rows_written: int
    rows_refused: int

    @property
    def status(self) -> int:
        return INCOMPLETE if self.objects_failed or self.rows_refused else 0


def read_source(spark: SparkSession, root: str, request: Request, stage: str) -> tuple[DataFrame, DataFrame]:
    """Rows with object_key and seq, and the objects (key, path, error) that were to be read; stage: a folder for the rows of captures."""
    if request.source == "raw":
        # JSON is parsed once; all that follows reads the rows that come of it. An object with a bad line, or whose compression breaks off, is left out whole.
        read_objects(spark, folders(spark, root, request.since, request.until), object_glob(request.proto), "keep").write.parquet(stage)
        rows = spark.read.parquet(stage)
        bad = rows.where("_corrupt is not null").groupBy(F.col("object_key").alias("bad_key")).agg(F.first(F.substring("_corrupt", 1, 100)).alias("text"))
        objects = check_objects(spark, listed(spark, root, request.since, request.until, request.proto))
        error = F.coalesce("error", F.concat(F.lit("no JSON: "), "text"))
        states = objects.join(bad, F.col("key") == F.col("bad_key"), "left").select("key", "path", error.alias("error")).persist()
        good = states.where("error is null").select(F.col("key").alias("object_key"))
        return rows.drop("_corrupt").join(good, "object_key", "left_semi"), states
    base = f"{root.rstrip('/')}/_log"
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(base)
    keyed = paths.select(F.concat(F.lit("_log/"), F.regexp_extract("path", r"/_log/(.*)$", 1)).alias("key"), "path", F.col("content").cast("string").alias("text"))
    kept = prune_log_keys(keyed, request.since, request.until, request.application).select("key", "path", "text")
    entry = F.from_json("text", AUDIT, {"columnNameOfCorruptRecord": "_bad"})
    parsed = kept.select("key", "path", entry.alias("e"))
    whole = F.col("e").isNotNull() & F.col("e.timestamp").isNotNull()
    states = parsed.select("key", "path", F.when(~whole, "no audit entry").alias("error")).persist()
    return parsed.where(whole).select("e.*", F.col("key").alias("object_key"), F.lit(0).cast("long").alias("seq")), states


def lines(rows: DataFrame, request: Request) -> DataFrame:
    """rows with their line in the format; null where a row has none."""
    columns = list(FIELDS[request.source])
    if request.fmt == "candump":
        return rows.withColumn("line", candump_line(utc_timestamp(F.col("ts")), F.col("src"), F.col("proto"), F.col("raw")))
    if request.fmt == "csv":
        return rows.withColumn("line", csv_text(rows, columns))
    return rows.withColumn("line", ndjson_line(columns))


def export(spark: SparkSession, root: str, output: str, request: Request) -> Outcome:
    """Write what is asked for as one file, in order of objects and rows; it appears whole or not at all.

    Parts are written in parallel beside it and put together as streams of bytes.
    """
    stage, parts = (f"{output}.{name}-{uuid.uuid4().hex}" for name in ("rows", "parts"))
    try:
        return write_export(spark, read_source(spark, root, request, stage), output, request, parts)
    finally:
        for folder in (stage, parts):
            store.Files(spark, folder).remove("")


def write_export(spark: SparkSession, source: tuple[DataFrame, DataFrame], output: str, request: Request, parts: str) -> Outcome:
    rows, states = source
    seen = Observation()
    # Counted after the sort, whose sampling reads rows twice.
    made = lines(rows, request).select("object_key", "seq", "line").orderBy("object_key", "seq")
    made = made.observe(seen, F.count_if(F.col("line").isNull()).alias("refused"), F.count("line").alias("written"))
    ending = "\r\n" if request.fmt == "csv" else "\n"
    made.where("line is not null").select("line").write.option("lineSep", ending).text(parts)
    header = csv_header(list(FIELDS[request.source])) + ending if request.fmt == "csv" else ""
    put_together(spark, parts, output, header.encode())
    failed = [(r["key"], r["error"]) for r in states.where("error is not null").orderBy("key").toLocalIterator()]
    read = states.where("error is null").count()
    states.unpersist()
    counts = store.counts_of(seen)
    return Outcome(read, failed, counts.get("written", 0), counts.get("refused", 0))


def put_together(spark: SparkSession, parts: str, output: str, header: bytes) -> None:
    files, stream = store.Files(spark, parts), None
    folder, name = output.rsplit("/", 1)
    target = store.Files(spark, folder)
    part = f"{name}.part"
    stream = target.fs.create(target.path(part), True)
    try:
        stream.write(header)
        for n in files.names():
            if n.startswith("part-"):
                source = files.fs.open(files.path(n))
                try:
                    files.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, 1 << 20, False)
                finally:
                    source.close()
        stream.hsync()
    except BaseException:
        stream.close()
        target.remove(part)
        raise
    stream.close()
    target.remove(name)
    if not target.fs.rename(target.path(part), target.path(name)):
        raise OSError(f"{output} could not be put in place")
