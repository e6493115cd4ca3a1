"""Reassembly of fast packets with state: cuts anywhere make no difference, open messages expire."""

import datetime as dt
import random
import time

import pandas as pd

from tidewake.streaming import reassembly

COLUMNS = ["counter", "seq", "ts", "frame", "length", "body"]
T0 = dt.datetime(2026, 8, 24, 12)


def columns(frames, first=0):
    """Frames (bytes) as the columns that the state function takes."""
    rows = []
    for k, f in enumerate(frames, first):
        zero = f[0] & 31 == 0
        rows.append((f[0] >> 5, k, T0, f[0] & 31, float(f[1]) if zero else None, (f[2:] if zero else f[1:]).hex().upper()))
    return pd.DataFrame(rows, columns=COLUMNS)


def cut(data, counter):
    parts, rest, n = [bytes([counter << 5, len(data)]) + data[:6]], data[6:], 0
    while rest:
        n += 1
        parts.append(bytes([counter << 5 | n]) + rest[:7].ljust(7, b"\xff"))
        rest = rest[7:]
    return parts


def one_by_one(frames):
    """The same by a row at a time."""
    open_, done = {}, []
    for k, f in enumerate(frames):
        counter, number = f[0] >> 5, f[0] & 31
        if number == 0:
            held = (1, f[2:], f[1])
        elif counter in open_ and open_[counter][0] == number:
            held = (number + 1, open_[counter][1] + f[1:], open_[counter][2])
        else:
            open_.pop(counter, None)
            continue
        if len(held[1]) >= held[2]:
            done.append((k, held[1][: held[2]].hex().upper()))
            open_.pop(counter, None)
        else:
            open_[counter] = held
    return done


def stream(rng):
    """Messages of several counters, interleaved, with lost, doubled and foreign frames."""
    queues = [[f for _ in range(6) for f in cut(bytes(rng.randrange(256) for _ in range(rng.choice([5, 9, 20, 43]))), c)] for c in (0, 3, 7)]
    out = []
    while any(queues):
        q = rng.choice([q for q in queues if q])
        f = q.pop(0)
        out += [] if rng.random() < 0.06 else [f, f] if rng.random() < 0.04 else [f]
    return out


def test_cuts_make_no_difference():
    rng = random.Random(3)
    for _ in range(30):
        frames = stream(rng)
        want = one_by_one(frames)
        for at in [*range(len(frames) + 1)][:: rng.choice([1, 3, 7])]:
            got, open_ = [], {}
            for part, first in ((frames[:at], 0), (frames[at:], at)):
                if part:
                    done, open_ = reassembly.put_together(columns(part, first).sample(frac=1, random_state=at), open_)
                    got += [(m[0], m[2]) for m in done]
            assert sorted(got) == want


def rows(frames, device="d"):
    return [(device, "can0", 7, k, T0, f.hex().upper()) for k, f in enumerate(frames)]


SCHEMA = "device_id string, src string, can_id long, seq long, ts timestamp, payload string"


def test_state_goes_on_over_batches_and_restarts(spark, tmp_path):
    frames = stream(random.Random(8))
    third = len(frames) // 3
    for n, part in enumerate((rows(frames)[:third], rows(frames)[third : 2 * third], rows(frames)[2 * third :])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = reassembly.reassemble_stream(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
        out.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.seq, r.payload) for r in got) == one_by_one(frames)


def test_open_messages_expire(spark, tmp_path):
    data = bytes(range(20))
    parts = cut(data, 2)

    def land(part, first):
        spark.createDataFrame([(*r[:3], r[3] + first, *r[4:]) for r in rows(part)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    land(parts[:2], 0)
    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    out = reassembly.reassemble_stream(source, timeout_ms=1500).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
    query = out.trigger(processingTime="500 milliseconds").start()
    seen = lambda: [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]

    def wait_for(what):  # a query with timers never has all done
        deadline = time.time() + 60
        while not what() and query.isActive and time.time() < deadline:
            time.sleep(0.3)
        assert what()

    taken = lambda: sum(p["numInputRows"] for p in query.recentProgress)
    try:
        wait_for(lambda: taken() == 2 and max(seen()) > 0 and seen()[-1] == 0)
        land(parts[2:], 2)  # the rest of a message that is gone
        land(cut(data, 2), 10)
        wait_for(lambda: taken() == 6)
        assert [(r.seq, r.payload) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(12, data.hex().upper())]
    finally:
        query.stop()
