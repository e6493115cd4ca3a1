"""A table of days whose versions are swapped by one small file.

A manifest names the folder of each day, the columns, and what goes with them.
Manifests are numbered; the greatest number holds. A commit writes its days into
new folders, then the manifest under a name that must not exist yet: a run that
stops anywhere leaves the old version whole, and two writers cannot both win.
Folders that the new manifest does not name are removed last, or by the next run.
"""

from __future__ import annotations

import json
import os
import socket
import threading
import time
import uuid
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest-"


def counts_of(seen: Observation) -> dict:
    """What was observed; nothing where Spark found that no row comes and left the observation out."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


@dataclass
class Manifest:
    """Folders are relative to the table. columns: besides ts, all double. extra: folders of other tables that go with it."""

    version: int = 0
    columns: list[str] = field(default_factory=list)
    days: dict[str, str] = field(default_factory=dict)
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> str:
        return ", ".join(["ts timestamp", *(f"`{c}` double" for c in self.columns)])


class Busy(RuntimeError):
    """Another writer holds the table."""


class Files:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self) -> list[str]:
        there = self.fs.exists(self.path(""))
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(""))) if there else []

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> None:
        """A new file; an error if there is one of that name."""
        self.written(self.fs.create(self.path(name), False), data)

    def replace(self, name: str, data: bytes) -> None:
        self.written(self.fs.create(self.path(name), True), data)

    @staticmethod
    def written(stream, data: bytes) -> None:
        """Data to the stream and on to the disk, as far as the file system can."""
        try:
            stream.write(data)
            stream.hsync()
        finally:
            stream.close()

    def publish(self, name: str, data: bytes) -> bool:
        """The file whole or not at all; False if there is one of that name."""
        part = f"_part-{uuid.uuid4().hex}"
        self.create(part, data)
        if not self.fs.exists(self.path(name)) and self.fs.rename(self.path(part), self.path(name)):
            return True
        self.remove(part)
        return False

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def current(spark: SparkSession, root: str) -> Manifest | None:
    files = Files(spark, root)
    found = [n for n in files.names() if n.startswith(MANIFEST)]
    return Manifest(**json.loads(files.read(max(found)))) if found else None


def read_table(spark: SparkSession, root: str, since: date | None = None, until: date | None = None) -> DataFrame | None:
    """The table, or its days from since to until; None if there is none. No file is opened for its schema."""
    manifest = current(spark, root)
    if manifest is None:
        return None
    low, high = str(since or date.min), str(until or date.max)
    return read_days(spark, root, manifest, [d for d in manifest.days if low <= d <= high])


def read_days(spark: SparkSession, root: str, manifest: Manifest, days: list[str]) -> DataFrame:
    paths = [f"{root.rstrip('/')}/{manifest.days[d]}" for d in sorted(days)]
    return spark.read.schema(manifest.schema).parquet(*paths) if paths else spark.createDataFrame([], manifest.schema)


def write_days(spark: SparkSession, root: str, table: DataFrame, version: int) -> dict[str, str]:
    """Write table's rows by day into new folders; the folder of each day."""
    folder = f"version-{version:010d}-{uuid.uuid4().hex[:8]}"
    day = F.date_format("ts", "yyyy-MM-dd")
    table.withColumn("_day", day).repartition("_day").sortWithinPartitions("_day", "ts").write.partitionBy("_day").parquet(f"{root.rstrip('/')}/{folder}")
    return {n.removeprefix("_day="): f"{folder}/{n}" for n in Files(spark, f"{root.rstrip('/')}/{folder}").names() if n.startswith("_day=")}


def commit(spark: SparkSession, root: str, manifest: Manifest) -> None:
    files = Files(spark, root)
    if not files.publish(f"{MANIFEST}{manifest.version:010d}.json", json.dumps(asdict(manifest), sort_keys=True).encode()):
        raise Busy(f"version {manifest.version} of {root} was written by another run")


def tidy(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Remove what this version does not use."""
    files = Files(spark, root)
    used = {f.split("/")[0] for f in [*manifest.days.values(), *manifest.extra.values()]}
    newest = f"{MANIFEST}{manifest.version:010d}.json"
    for name in files.names():
        if name.startswith(("version-", "extra-", "_part-")) and name not in used or name.startswith(MANIFEST) and name < newest:
            files.remove(name)


LOCK = "_lock"
#: Seconds that a lock holds unless it is renewed; far more than clocks of hosts differ by.
LEASE_S = 600.0


class Lease:
    """A lock file with an end, put off again and again while its holder lives."""

    def __init__(self, files: Files, seconds: float):
        self.files, self.seconds, self.ended = files, seconds, threading.Event()
        self.own = {"pid": os.getpid(), "host": socket.gethostname(), "since": datetime.now(timezone.utc).isoformat(timespec="seconds"), "run": uuid.uuid4().hex}
        self.thread = threading.Thread(target=self.renew, daemon=True)

    def content(self) -> bytes:
        return json.dumps(self.own | {"until": time.time() + self.seconds}).encode()

    def take(self) -> None:
        """An error if there is a lock."""
        self.files.create(LOCK, self.content())
        self.thread.start()

    def renew(self) -> None:
        while not self.ended.wait(self.seconds / 3):
            if (holder_of(self.files) or {}).get("run") != self.own["run"]:
                return  # it is another's by now
            self.files.replace(LOCK, self.content())

    def end(self) -> None:
        self.ended.set()
        self.thread.join(timeout=10)
        if (holder_of(self.files) or {}).get("run") == self.own["run"]:
            self.files.remove(LOCK)


@contextmanager
def locked(spark: SparkSession, root: str, lease_s: float = LEASE_S):
    """One writer at a time, by a file that only one can create, for as long as it is renewed.

    A lock is taken over where it has ended, or its process is gone from this host. Who takes it over
    publishes the table as it is under the next number: a holder that was only paused
    has read an older one, so what it publishes later is refused, whenever that is.
    """
    files = Files(spark, root)
    lease = Lease(files, lease_s)
    for last in (False, True):
        try:
            lease.take()
            break
        except Py4JJavaError as e:
            holder = holder_of(files)
            if holder is None and not last:
                continue
            if last or not is_over(holder):
                raise Busy(f"{root} is held by {describe(holder)}") from e
            files.remove(LOCK)
            fence(spark, root)
    try:
        yield
    finally:
        lease.end()


def fence(spark: SparkSession, root: str) -> None:
    """The current version once more, under the next number; where another run does so just now, that holds as well."""
    now = current(spark, root) or Manifest()
    now.version += 1
    Files(spark, root).publish(f"{MANIFEST}{now.version:010d}.json", json.dumps(asdict(now), sort_keys=True).encode())


def lock_holder(spark: SparkSession, root: str) -> dict | None:
    return holder_of(Files(spark, root))


def holder_of(files: Files) -> dict | None:
    """What the lock file says; nothing where it was just released, or is being written."""
    try:
        return json.loads(files.read(LOCK)) if files.fs.exists(files.path(LOCK)) else None
    except (Py4JJavaError, ValueError):
        return {}


def describe(holder: dict | None) -> str:
    return f"process {holder['pid']} on {holder['host']} since {holder['since']}" if holder else "another run"


def is_over(holder: dict | None) -> bool:
    """The lock has ended, or its process is gone from this host."""
    if not holder:
        return False
    if holder.get("until", float("inf")) < time.time():
        return True
    if holder.get("host") != socket.gethostname():
        return False
    try:
        os.kill(int(holder["pid"]), 0)
    except ProcessLookupError:
        return True
    except PermissionError:
        pass
    return False
