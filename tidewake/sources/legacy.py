"""Import of a legacy table of sentences into the archive: one object a day, named by its content."""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit
from .archive import earliest_day, refuse_naive, write_objects

APPLICATION = "tidewake-import"
#: Rows that a database sends at a time.
FETCH_ROWS = 20_000


def read_table(spark: SparkSession, url: str, table: str, days: list[date], properties: dict[str, str] | None = None) -> DataFrame:
    """A legacy table over JDBC, one partition a day."""
    predicates = [f"received_at >= '{d}' AND received_at < '{d + timedelta(days=1)}'" for d in days]
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(FETCH_ROWS), **(properties or {})})


def day_scan(table: DataFrame, since: date, until: date, devices: list[str] | None = None) -> DataFrame:
    """Rows received from since to until, both days included, of the named devices, as records. Times without a zone are refused."""
    refuse_naive(table, "received_at")
    rows = table.where((F.col("received_at") >= F.lit(since)) & (F.col("received_at") < F.lit(until + timedelta(days=1))))
    rows = rows.where(F.col("device_id").isin(devices)) if devices else rows
    return rows.select(
        F.col("received_at").alias("ts"), F.lit(None).cast("double").alias("mono"), "device_id", F.col("source_ip").alias("src"),
        F.lit("n0183").alias("proto"), F.col("raw_data").alias("raw"), "sentence_type",
    )


#: A total order of all that reaches a line, nulls last: the same rows always make the same object.
ORDER = ("ts", "device_id", "raw", "sentence_type", "src")


def day_objects(records: DataFrame, root: str | None = None) -> DataFrame:
    """One row a day: day, key, rows, cid, state; with a root, each day's object is written there unless it is there. A day is streamed through one task."""
    order = [F.col(c).asc_nulls_last() for c in ORDER]
    return write_objects(records.withColumn("day", F.to_date("ts")), root, ["day"], order)


def span_of(first: date | None, since: date | None, until: date | None, lag_seconds: int, now: datetime | None) -> tuple[date, date] | None:
    """First and last day to import: of those that ended lag_seconds ago, from since, or the table's first day, to until; None if there is none."""
    last = ((now or datetime.now(timezone.utc)) - timedelta(seconds=lag_seconds)).date() - timedelta(days=1)
    last = min(until, last) if until else last
    begin = since or first
    return None if begin is None or begin > last else (begin, last)


def import_days(
    spark: SparkSession, table: DataFrame, root: str, since: date | None = None, until: date | None = None, devices: list[str] | None = None,
    live: bool = False, lag_seconds: int = 300, now: datetime | None = None, name: str = "legacy",
) -> list[dict]:
    """Bring the archive up to date with a legacy table: day, state, rows of each day that has ended lag_seconds ago.

    Without live nothing is written, and days that would be are marked upload. A live run that
    touches the archive writes an audit entry before and after, paired by a run_id; the
    second one whatever happens.
    """
    span = span_of(None if since else earliest_day(table), since, until, lag_seconds, now)
    if span is None:
        return []
    first, last = span
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    if not live:
        done = states(reconcile_files(day_objects(day_scan(table, first, last, devices)), root))
    else:
        run = {"run_id": secrets.token_hex(4), "since": str(first), "until": str(last), "table": name, "proto": "n0183"}
        opening = audit.Account(APPLICATION, f"import started: {first} to {last}", {"event": "start", **run})
        closing = audit.Account(APPLICATION, details={"event": "end", "days_uploaded": 0, "row_count": 0, **run}, failed="import failed: {}")
        with audit.recorded(root, closing, opening) as account:
            done = states(day_objects(day_scan(table, first, last, devices), root))
            uploaded = sum(d["state"] == "uploaded" for d in done.values())
            account.comment = f"import finished: {uploaded} of {len(days)} days uploaded"
            account.details |= {"days_uploaded": uploaded, "row_count": sum(d["rows"] for d in done.values())}
    return [done.get(d, {"day": d, "state": "empty", "rows": 0, "key": None}) for d in days]


def states(objects: DataFrame) -> dict[date, dict]:
    """A row a day comes to the driver."""
    return {r["day"]: {"day": r["day"], "state": r["state"], "rows": r["rows"], "key": r["key"]} for r in objects.collect()}


def import_jdbc(spark: SparkSession, url: str, table: str, root: str, since: date | None = None, until: date | None = None, devices: list[str] | None = None, live: bool = False, lag_seconds: int = 300, properties: dict[str, str] | None = None) -> list[dict]:
    """import_days of a table behind JDBC: each day is a partition with a bounded fetch of its own. Its first day is asked for where since is not given."""
    own = {"fetchsize": str(FETCH_ROWS), **(properties or {})}
    first = None if since else earliest_day(spark.read.jdbc(url, table, properties=own))
    span = span_of(first, since, until, lag_seconds, None)
    if span is None:
        return []
    days = [span[0] + timedelta(days=k) for k in range((span[1] - span[0]).days + 1)]
    return import_days(spark, read_table(spark, url, table, days, properties), root, span[0], span[1], devices, live, lag_seconds, name=table)


def reconcile_files(objects: DataFrame, root: str) -> DataFrame:
    """objects with state up-to-date where the archive has an object of that key; each is asked for by its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for batch in batches:
            found = [store.get_file_info(f"{place}/{k}").type.name != "NotFound" for k in batch.column("key").to_pylist()]
            state = pa.array(["up-to-date" if f else s for f, s in zip(found, batch.column("state").to_pylist(), strict=True)], pa.string())
            yield batch.set_column(batch.schema.get_field_index("state"), "state", state)

    return objects.mapInArrow(run, objects.schema)


def reconcile(objects: DataFrame, existing: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """day, key, state: up-to-date where the key exists, else upload; with days, those without rows are empty."""
    known = existing.select("key", F.lit(True).alias("_known")).distinct()
    out = objects.join(known, "key", "left").select("day", "key", F.when(F.col("_known"), "up-to-date").otherwise("upload").alias("state"))
    if days is not None:
        out = days.select("day").join(out, "day", "left").select("day", "key", F.coalesce("state", F.lit("empty")).alias("state"))
    return out
