"""Segments of a live capture: the relay that writes them, the source's offsets, the stream into the archive, clock epochs."""

import os
import random

import pytest
from pyspark.errors import StreamingQueryException

from tidewake import commands
from tidewake.operators import resample
from tidewake.sources import archive, segments
from tidewake.streaming import capture


def line(k):
    return f"({1_700_000_000 + k}.000000) can0 09F80102#{k:016X}"


def rows_of(reader, start, end):
    return [v for p in reader.partitions(start, end) for b in reader.read(p) for v in b.column("value").to_pylist()]


def stored(spark, root):
    return [r.raw for r in archive.read_archive(spark, root, archive.FIRST_DAY, archive.LAST_DAY).orderBy("ts").collect()]


def raws(numbers):
    return [f"09f80102#{k:016x}" for k in numbers]


def test_relay(tmp_path, monkeypatch):
    clock = iter(range(1000))
    relay = segments.Relay(str(tmp_path / "s"), limit=100, clock=lambda: next(clock))
    synced = []
    monkeypatch.setattr(segments, "force", synced.append)
    for k in range(3):
        relay.add(f"line {k}")
    assert relay.flush() and relay.flush() and [os.path.basename(p)[:4] for p in synced] == ["part", "s"]
    (one,) = segments.segments(relay.store, relay.place)
    assert (one.first, one.rows) == (0, 3) and (tmp_path / "s" / segments.name_of(0, 3)).read_text() == "line 0 0.000000\nline 1 1.000000\nline 2 2.000000\n"
    # A segment of that name is that segment already.
    before = os.stat(one.path).st_mtime_ns
    segments.put(relay.store, relay.place, 0, ["other"] * 3)
    assert os.stat(one.path).st_mtime_ns == before
    # What cannot be written stays in order; beyond the limit the oldest go, and leave their numbers out.
    with monkeypatch.context() as m:
        m.setattr(segments, "put", lambda *a: (_ for _ in ()).throw(OSError("full")))
        for k in range(3, 10):
            relay.add(f"line {k}")
            assert not relay.flush()
    assert relay.dropped == 1 and relay.flush()
    assert [(s.first, s.rows) for s in segments.segments(relay.store, relay.place)] == [(0, 3), (4, 6)]
    # Another run goes on with the next number.
    again = segments.Relay(str(tmp_path / "s"), spare=str(tmp_path / "spare"))
    again.add("line 10")
    real = segments.put
    monkeypatch.setattr(segments, "put", lambda store, place, *a: real(store, place, *a) if place.endswith("spare") else (_ for _ in ()).throw(OSError("full")))
    assert again.flush() and [(s.first, s.rows) for s in segments.segments(*segments.open_folder(str(tmp_path / "spare")))] == [(10, 1)]
    again.evict(100)
    assert again.dropped == 3 and [s.first for s in segments.segments(again.store, again.place)] == [4]


def test_relay_command(tmp_path, capsys):
    args = commands.parser().parse_args(["relay", "--segments", str(tmp_path)])
    assert commands.run_relay(args, [line(k) + "\n" for k in range(5)]) == 0 and "5 lines, 0 dropped" in capsys.readouterr().err
    assert [s.rows for s in segments.segments(*segments.open_folder(str(tmp_path)))] == [5]


def folder_of(path, parts):
    store, place = segments.open_folder(str(path))
    for first, lines in parts:
        segments.put(store, place, first, lines)
    return store, place


def test_every_line_is_read_once(tmp_path, monkeypatch):
    rng = random.Random(4)
    parts, n = [], 0
    for _ in range(4):
        lines = [f"{n + k} " + "é" * rng.choice([0, 1, 3, 50, 400]) for k in range(rng.randint(1, 40))]
        parts.append((n, lines))
        n += len(lines)
    folder_of(tmp_path, parts)
    for size, rows in ((7, 5), (64, 1000), (1000, 10), (1 << 20, 1 << 20)):
        monkeypatch.setattr(segments, "PART_BYTES", size)
        monkeypatch.setattr(segments, "ROW_BYTES", rows)
        reader = segments.SegmentReader({"path": str(tmp_path)})
        start, end = reader.initialOffset(), reader.latestOffset()
        assert rows_of(reader, start, end) == [x for _, lines in parts for x in lines]
        begun = [(p.first, b) for p in reader.partitions(start, end) for batch in reader.read(p) for b in batch.column("byte").to_pylist()]
        assert len(set(begun)) == n and begun == sorted(begun)


def test_offsets_limits_and_losses(tmp_path):
    lines = lambda a, b: [f"{k:09d}" for k in range(a, b)]  # noqa: E731  ten bytes each
    store, place = folder_of(tmp_path, [(0, lines(0, 10)), (10, lines(10, 20)), (20, lines(20, 30))])
    options = {"path": str(tmp_path), "max_batch_bytes": "200", "max_backlog_bytes": "300"}
    reader = segments.SegmentReader(options)
    start = reader.initialOffset()
    first = reader.latestOffset()
    assert first == {"line": 20, "shed": 0, "lost": 0} and rows_of(reader, start, first) == lines(0, 20)
    # Another process goes on from the offset that was planned last, whether or not its batch was done.
    reader = segments.SegmentReader(options)
    folder_of(tmp_path, [(33, lines(33, 40)), (40, lines(40, 60)), (60, lines(60, 70))])
    second = reader.latestOffset()
    # 470 bytes wait, 300 may: 20..30 and 33..40 are shed, and 30..33 never came.
    assert second == {"line": 60, "shed": 40, "lost": 20} and rows_of(reader, first, second) == lines(40, 60)
    third = reader.latestOffset()
    assert third == {"line": 70, "shed": 40, "lost": 20} and reader.latestOffset() == third
    # An offset that Spark never stored changes nothing: the lines of both come.
    assert rows_of(reader, first, third) == lines(40, 70)
    reader.commit(second)
    assert [s.first for s in segments.segments(store, place)] == [60]
    assert segments.SegmentReader({"path": str(tmp_path / "none")}).latestOffset() == {"line": 0, "shed": 0, "lost": 0}


def test_stream_stops_at_a_failure_and_goes_on(spark, tmp_path, monkeypatch):
    folder, root, checkpoint = (f"file://{tmp_path}/{x}" for x in ("segments", "archive", "checkpoint"))
    folder_of(tmp_path / "segments", [(10 * k, [line(i) for i in range(10 * k, 10 * k + 10)]) for k in range(3)])
    where = (spark, folder, root, "boat", checkpoint)
    own, done = capture.store_batch, []

    def fails(*a):
        if len(done) == 1:
            raise OSError("no network")
        done.append(1)
        return own(*a)

    limit = len(line(0)) * 10 + 11
    with monkeypatch.context() as m:
        m.setattr(capture, "store_batch", fails)
        with pytest.raises(StreamingQueryException):
            capture.drain(*where, max_batch_bytes=limit)
    assert stored(spark, root) == raws(range(10))
    assert len(segments.segments(*segments.open_folder(folder))) >= 2
    assert capture.drain(*where, max_batch_bytes=limit) >= 2
    assert stored(spark, root) == raws(range(30))
    # Nothing new: nothing is stored, and a line that comes later is.
    assert capture.drain(*where) == 0
    folder_of(tmp_path / "segments", [(30, [line(30), "no frame"])])
    assert commands.main(["capture", "--root", root, "--segments", folder, "--checkpoint", checkpoint, "--device-id", "boat", "--once"], spark) == 0
    assert stored(spark, root) == raws(range(31))


@pytest.mark.parametrize("rows", [1_000_000, 7])
def test_clock_epochs(spark, monkeypatch, rows):
    monkeypatch.setattr(resample, "EPOCH_ROWS", rows)
    rng = random.Random(5)
    data, want = [], {}
    for device in ("a", "b", None):
        epoch, last, level = 0, None, 1_700_000_000.0
        for k in range(60):
            level += rng.choice([0] * 8 + [0.2, 40.0])
            mono = None if rng.random() < 0.3 else k * 1.5
            if mono is not None and (last is None or abs(level - last) > 0.5):
                epoch += 1
            last = level if mono is not None else last
            data.append((device, k, level + k * 1.5, mono))
            want[device, k] = epoch
    records = spark.createDataFrame(data, "device string, seq long, t double, mono double").selectExpr("device", "seq", "timestamp_micros(cast(round(t * 1e6) as bigint)) as ts", "mono").repartition(3)
    got = resample.clock_epochs(records, ["device"], "seq")
    assert {(r.device, r.seq): r.epoch for r in got.collect()} == want
    table = resample.epoch_table(got, ["device"])
    assert table.count() == len({(d, e) for (d, _), e in want.items() if e})
