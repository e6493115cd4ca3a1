"""Command lines: export, update, import, follow, relay, capture.

    python -m tidewake.commands export --root URI [--source raw|_log] [--format ndjson|csv|candump] [-o PATH]
    python -m tidewake.commands update --root URI --table URI [--since DAY] [--until DAY] [--proto NAME] [--rebuild] [--dry-run]
    python -m tidewake.commands import --root URI --jdbc URL --table NAME [--live]
    python -m tidewake.commands follow --root URI --table URI --checkpoint URI [--every "30 seconds"]
    python -m tidewake.commands relay --segments FOLDER [--seconds N] [--limit BYTES] [--spare FOLDER] < LINES
    python -m tidewake.commands capture --root URI --segments FOLDER --checkpoint URI --device-id NAME [--every "300 seconds"] [--once]

Status: 0 done; 2 an export that left something out; 75 stopped for now, run again to go on.
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Iterable
from datetime import date, datetime, timezone
from itertools import islice

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from .plans import derive, store
from .sources import archive, audit, export, legacy, segments

INCOMPLETE, TRY_LATER = export.INCOMPLETE, 75
UPDATE = "tidewake-update"
#: Objects that one update takes: names that the driver holds, and work that a stop repeats at most.
BATCH_OBJECTS = 10_000


def day(text: str) -> date:
    return datetime.fromisoformat(text).date()


def say(text: str) -> None:
    print(text, file=sys.stderr)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidewake", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    tools = out.add_subparsers(dest="tool", required=True)
    every = {name: tools.add_parser(name) for name in ("export", "update", "import", "follow", "relay", "capture")}
    for name, tool in every.items():
        if name == "relay":
            continue
        tool.add_argument("--root", required=True, help="where the archive is")
    for name in ("export", "update", "import"):
        every[name].add_argument("--since", type=day)
        every[name].add_argument("--until", type=day)
    for name in ("export", "update"):
        every[name].add_argument("--proto")
    e = every["export"]
    e.add_argument("--source", choices=sorted(export.FIELDS), default="raw")
    e.add_argument("--format", choices=export.FORMATS, default="ndjson")
    e.add_argument("--application")
    e.add_argument("-o", "--output", help="a file; by default one named by time, source and format, here")
    for name in ("update", "follow"):
        every[name].add_argument("--table", required=True, help="where the table is")
        every[name].add_argument("--bucket", default="1s")
    u = every["update"]
    u.add_argument("--rebuild", action="store_true")
    u.add_argument("--dry-run", action="store_true")
    i = every["import"]
    i.add_argument("--jdbc", required=True)
    i.add_argument("--table", required=True)
    i.add_argument("--device-id", action="append")
    i.add_argument("--lag-seconds", type=int, default=300)
    i.add_argument("--live", action="store_true", help="write; without it, only say what would be")
    f = every["follow"]
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--every")
    c = every["capture"]
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--device-id", required=True)
    c.add_argument("--every", default="300 seconds")
    c.add_argument("--once", action="store_true", help="store what waits, and stop")
    c.add_argument("--batch-bytes", type=int, help="of segments that one batch takes")
    c.add_argument("--backlog-bytes", type=int, help="of segments that may wait; the oldest beyond are shed, and counted")
    r = every["relay"]
    r.add_argument("--seconds", type=float, default=5.0, help="between segments")
    r.add_argument("--limit", type=int, help="bytes of segments that may wait; the oldest beyond go first")
    r.add_argument("--spare", help="a folder for lines that cannot be written to the first")
    for tool in (c, r):
        tool.add_argument("--segments", required=True, help="the folder of segments")
    return out


def run_export(spark: SparkSession, args: argparse.Namespace) -> int:
    request = export.Request(args.source, args.format, args.proto, args.application, args.since or archive.FIRST_DAY, args.until or archive.LAST_DAY)
    output = args.output or request.file_name()
    output = output if "/" in output else f"./{output}"
    got = export.export(spark, args.root, output, request)
    for key, reason in got.objects_failed:
        say(f"  left out {key}: {reason}")
    say(f"{got.objects_read} objects, {got.rows_written} rows to {output}; {len(got.objects_failed)} objects and {got.rows_refused} rows left out")
    return got.status


def run_update(spark: SparkSession, args: argparse.Namespace) -> int:
    """Status 0 where another run holds the table: that one goes on."""
    since, until = args.since or archive.FIRST_DAY, args.until or datetime.now(timezone.utc).date()
    try:
        keys = archive.listed(spark, args.root, since, until, args.proto)
        manifest = store.current(spark, args.table)
        # Only objects that the ledger does not have are opened, oldest first; each batch is done when it is written.
        todo = keys if args.rebuild or manifest is None else keys.join(derive.fresh_keys(spark, keys, args.table, manifest), "key", "left_semi")
        fresh = todo.orderBy("key").toLocalIterator()
        got = {"objects": 0, "rows": 0, "dropped": 0, "columns_added": []}
        while batch := list(islice(fresh, BATCH_OBJECTS)):
            own = spark.createDataFrame([(r["key"],) for r in batch], "key string")
            first = not got["objects"]
            one = derive.update(spark, archive.read_objects(spark, [r["path"] for r in batch]), own, args.table, args.bucket, args.rebuild and first, args.dry_run)
            got = {k: sorted({*got[k], *v}) if k == "columns_added" else got[k] + v for k, v in one.items()}
    except store.Busy as e:
        say(f"not running: {e}")
        return 0
    except (PySparkException, OSError) as e:
        say(f"stopped: {e}. Run again to go on: what is done is in the ledger, and nothing is half written.")
        return TRY_LATER
    text = f"{got['objects']} objects, {got['rows']} rows into {args.table} at {args.bucket}, {got['dropped']} samples out of range, new columns: {got['columns_added']}"
    say(text + " (dry run)" * args.dry_run)
    if not args.dry_run and (got["columns_added"] or args.rebuild):
        # New columns and rebuilds leave no trace in the ledger.
        details = {"objects": got["objects"], "rows": got["rows"], "table": args.table, "bucket": args.bucket, "proto": args.proto, "rebuild": args.rebuild, "new_columns": got["columns_added"], "dropped_out_of_range": got["dropped"]}
        audit.tell(args.root, [audit.Account(UPDATE, f"updated: {text}", details)])
    return 0


def run_import(spark: SparkSession, args: argparse.Namespace) -> int:
    for d in legacy.import_jdbc(spark, args.jdbc, args.table, args.root, args.since, args.until, args.device_id, args.live, args.lag_seconds):
        say(f"{d['day']}: {d['state']}, {d['rows']} rows")
    return 0


def run_follow(spark: SparkSession, args: argparse.Namespace) -> int:
    from .streaming import ingest, supervise

    supervise.listening(spark, say=say)
    ingest.supervised(lambda: ingest.catch_up(spark, args.root, args.table, args.checkpoint, args.bucket, args.every))
    return 0


def run_capture(spark: SparkSession, args: argparse.Namespace) -> int:
    """Until it is stopped; a failed batch is tried again."""
    from .streaming import capture, ingest, supervise

    limits = {"max_batch_bytes": args.batch_bytes, "max_backlog_bytes": args.backlog_bytes}
    if args.once:
        capture.drain(spark, args.segments, args.root, args.device_id, args.checkpoint, **limits)
    else:
        supervise.listening(spark, say=say)
        ingest.supervised(lambda: capture.capture(spark, args.segments, args.root, args.device_id, args.checkpoint, args.every, **limits))
    return 0


def run_relay(args: argparse.Namespace, lines: Iterable[str] | None = None) -> int:
    """Lines to segments, until they end; status 75 where some could not be written."""
    relay = segments.Relay(args.segments, folder_limit=args.limit, spare=args.spare)
    written = time.monotonic()
    for line in sys.stdin if lines is None else lines:
        relay.add(line.rstrip("\n"))
        if time.monotonic() - written >= args.seconds:
            relay.flush()
            written = time.monotonic()
    done = relay.flush()
    say(f"{relay.received} lines, {relay.dropped} dropped")
    return 0 if done else TRY_LATER


#: Public settings of object-store clients: attempts, and waits that grow.
STORE_SETTINGS = {
    "spark.hadoop.fs.s3a.attempts.maximum": "4",
    "spark.hadoop.fs.s3a.retry.limit": "4",
    "spark.hadoop.fs.s3a.retry.interval": "2s",
    "spark.hadoop.fs.s3a.connection.establish.timeout": "30s",
}


def session(name: str) -> SparkSession:
    builder = SparkSession.builder.appName(f"tidewake-{name}").config("spark.sql.session.timeZone", "UTC")
    for key, value in STORE_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.tool == "relay":
        return run_relay(args)
    tools = {"export": run_export, "update": run_update, "import": run_import, "follow": run_follow, "capture": run_capture}
    return tools[args.tool](spark or session(args.tool), args)


if __name__ == "__main__":
    sys.exit(main())
