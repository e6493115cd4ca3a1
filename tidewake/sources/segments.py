"""A folder of segments, the lines of a live capture in files that are written whole, and a streaming source of them.

Lines have numbers. A segment's name has the number of its first line and how many it
has, so rows, gaps and order are known from names alone, and writing a segment again
changes nothing. Lines that a full buffer dropped, before or after they were
written, leave a gap in the numbers: what is lost is counted exactly, whoever lost it.

The source's offsets are line numbers, with the number below which lines were shed and
the count of lines lost so far. A batch takes whole segments, as many as fit max_batch_bytes (one at
least). Where more than max_backlog_bytes wait, the oldest segments are shed. Segments are
cut into byte ranges, read by as many tasks. What a batch has stored is removed
when Spark commits it, unless keep is set; a batch that fails is repeated with the same
lines, so nothing is lost and order is kept. The offset that Spark last planned is kept
in a file, progress, one for each query, so that limits hold across restarts.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = re.compile(r"segment-([0-9]{15})-([0-9]{9})\.log")
SCHEMA = "segment long, byte long, value string"
#: Bytes of a segment that one task reads, and of one batch of its rows.
PART_BYTES, ROW_BYTES = 16 << 20, 1 << 20


def open_folder(uri: str):
    """(file system, path) of a folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@dataclass(frozen=True)
class Segment:
    first: int
    rows: int
    size: int
    path: str

    @property
    def end(self) -> int:
        return self.first + self.rows


def name_of(first: int, rows: int) -> str:
    return f"segment-{first:015d}-{rows:09d}.log"


def segments(store, place: str) -> list[Segment]:
    """The segments of a folder, by number; none where there is no folder."""
    from pyarrow import fs

    found = ((NAME.fullmatch(f.base_name), f) for f in store.get_file_info(fs.FileSelector(place, allow_not_found=True)))
    return sorted((Segment(int(m[1]), int(m[2]), f.size, f.path) for m, f in found if m), key=lambda s: s.first)


def put(store, place: str, first: int, lines: list[str]) -> str:
    """Write a segment whole: under another name, forced to disk, then renamed. One of its name is that segment already."""
    from pyarrow import fs

    store.create_dir(place, recursive=True)
    path = f"{place}/{name_of(first, len(lines))}"
    if store.get_file_info(path).type != fs.FileType.NotFound:
        return path
    part = f"{place}/part-{uuid.uuid4().hex}"
    with store.open_output_stream(part, compression=None) as out:
        out.write("".join(x + "\n" for x in lines).encode())
    durable_move(store, part, path)
    return path


def durable_move(store, part: str, path: str) -> None:
    """Rename a written file; on a local disk what it holds is forced there first, and the name after."""
    from pyarrow import fs

    local = isinstance(store, fs.LocalFileSystem)
    if local:
        force(part)
    store.move(part, path)
    if local:
        force(path.rsplit("/", 1)[0])


def force(path: str) -> None:
    """What is written under the path, a file or a folder, is on disk when this ends."""
    handle = os.open(path, os.O_RDONLY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)


def write_segments(lines: DataFrame, folder: str, rows: int) -> DataFrame:
    """Store lines (line, a number without gaps from 0; value) as segments of so many rows, by as many tasks; (path) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_folder(folder)
        held: list[tuple[int, str]] = []

        def close() -> pa.RecordBatch:
            path = put(store, place, held[0][0], [v for _, v in held])
            held.clear()
            return pa.record_batch({"path": pa.array([path])})

        for batch in batches:
            for line, value in zip(batch.column("line").to_pylist(), batch.column("value").to_pylist(), strict=True):
                if held and held[0][0] // rows != line // rows:
                    yield close()
                held.append((line, value))
        if held:
            yield close()

    dealt = lines.selectExpr("line", "value", f"line div {rows} AS _segment").repartition("_segment").sortWithinPartitions("line")
    return dealt.select("line", "value").mapInArrow(run, "path string")


class Relay:
    """Numbers the lines of a live capture and writes them as segments; holds at most limit bytes of lines that are not written yet, and drops the oldest.

    A folder that cannot be written is tried again with the next segment; where there is a spare folder, the segment goes there at once.
    """

    def __init__(self, folder: str, limit: int = 48 << 20, folder_limit: int | None = None, spare: str | None = None, clock: Callable[[], float] = time.monotonic):
        self.store, self.place = open_folder(folder)
        self.limit, self.folder_limit, self.spare, self.clock = limit, folder_limit, spare, clock
        there = segments(self.store, self.place)
        self.next = there[-1].end if there else 0
        self.held: deque[tuple[int, str]] = deque()
        self.bytes = self.received = self.dropped = 0

    def add(self, line: str) -> None:
        """One more line, with the monotonic clock's seconds behind it."""
        line = f"{line} {self.clock():.6f}"
        self.held.append((self.next, line))
        self.next, self.bytes, self.received = self.next + 1, self.bytes + len(line) + 1, self.received + 1
        while self.bytes > self.limit:
            self.bytes -= len(self.held.popleft()[1]) + 1
            self.dropped += 1

    def flush(self) -> bool:
        """Write what is held as one segment; what cannot be written stays, in order."""
        if not self.held:
            return True
        lines = [x for _, x in self.held]
        try:
            put(self.store, self.place, self.held[0][0], lines)
        except OSError:
            if self.spare is None:
                return False
            put(*open_folder(self.spare), self.held[0][0], lines)
        self.held.clear()
        self.bytes = 0
        if self.folder_limit is not None:
            self.evict(self.folder_limit)
        return True

    def evict(self, limit: int) -> None:
        """Remove the oldest segments until the others fit limit bytes."""
        there = segments(self.store, self.place)
        size = sum(s.size for s in there)
        for s in there:
            if size <= limit:
                break
            self.store.delete_file(s.path)
            self.dropped, size = self.dropped + s.rows, size - s.size


@dataclass
class Range(InputPartition):
    """The lines of a segment that begin in start..end."""

    path: str
    first: int
    start: int
    end: int

    def __init__(self, path: str, first: int, start: int, end: int):
        super().__init__((path, first, start, end))
        self.path, self.first, self.start, self.end = path, first, start, end


class SegmentReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.max_batch = int(options.get("max_batch_bytes", 1 << 62))
        self.max_backlog = int(options.get("max_backlog_bytes", 1 << 62))
        self.keep = str(options.get("keep", "false")).lower() == "true"
        self.progress = options.get("progress", f"{self.uri.rstrip('/')}/_progress.json")

    def folder(self):
        return open_folder(self.uri)

    def planned(self) -> dict | None:
        store, path = open_folder(self.progress)
        try:
            with store.open_input_stream(path) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def note(self, offset: dict) -> None:
        store, path = open_folder(self.progress)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        part = f"{path}.part-{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(json.dumps(offset).encode())
        store.move(part, path)

    def initialOffset(self) -> dict:  # noqa: N802
        there = segments(*self.folder())
        begin = there[0].first if there else 0
        offset = {"line": begin, "shed": begin, "lost": 0}
        self.note(offset)
        return offset

    def latestOffset(self) -> dict:  # noqa: N802
        now = self.planned() or self.initialOffset()
        waiting = [s for s in segments(*self.folder()) if s.end > now["line"]]
        if not waiting:
            return now
        backlog, first = sum(s.size for s in waiting), 0
        while backlog > self.max_backlog and first + 1 < len(waiting):
            backlog -= waiting[first].size
            first += 1
        shed = waiting[first].first if first else now["shed"]
        taken, size = [], 0
        for s in waiting[first:]:
            if taken and size + s.size > self.max_batch:
                break
            taken.append(s)
            size += s.size
        end = taken[-1].end
        # Lines that no segment taken has were shed, or never came here.
        return {"line": end, "shed": shed, "lost": now["lost"] + end - now["line"] - sum(s.rows for s in taken)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.note(end)
        begin = max(start["line"], end["shed"])
        own = [s for s in segments(*self.folder()) if begin <= s.first < end["line"]]
        return [Range(s.path, s.first, a, min(a + PART_BYTES, s.size)) for s in own for a in range(0, s.size, PART_BYTES)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = self.folder()
        with store.open_input_file(partition.path) as f:
            at = partition.start
            if at:  # a line that is under way belongs to the range before
                at += len(rest_of_line(f, at - 1)) - 1
            while at < partition.end:
                f.seek(at)
                data = f.read(min(ROW_BYTES, partition.end - at))
                if not data.endswith(b"\n"):
                    data += rest_of_line(f, at + len(data))
                lines = data.split(b"\n")[:-1] if data.endswith(b"\n") else data.split(b"\n")
                begins, place = [], at
                for line in lines:
                    begins.append(place)
                    place += len(line) + 1
                yield pa.record_batch({"segment": pa.array([partition.first] * len(lines), pa.int64()), "byte": pa.array(begins, pa.int64()), "value": pa.array([x.decode(errors="replace") for x in lines], pa.string())})
                at += len(data)

    def commit(self, end: dict) -> None:
        if not self.keep:
            store, place = self.folder()
            for s in segments(store, place):
                if s.end <= end["line"]:
                    store.delete_file(s.path)


def rest_of_line(f, at: int, step: int = 4096) -> bytes:
    """From a place of a file to the end of its line, the line break included."""
    out = b""
    while True:
        f.seek(at + len(out))
        more = f.read(step)
        cut = more.find(b"\n")
        out += more if cut < 0 else more[: cut + 1]
        if cut >= 0 or not more:
            return out


class SegmentSource(DataSource):
    """Options: path; max_batch_bytes, max_backlog_bytes, keep, progress."""

    @classmethod
    def name(cls) -> str:
        return "tidewake_segments"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SegmentReader:  # noqa: N802
        return SegmentReader(dict(self.options))
