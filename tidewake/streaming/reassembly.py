"""Fast packets of a stream, put together with keyed state that outlives a batch.

A batch's frames are put together slice by slice of the sequence first, as the batch form does object by
object: no task holds more of an identifier than a slice, and one busy identifier is the work of all tasks. Only a slice's edges, the
frames before its first message and its last message, meet the state; whole messages pass it by under keys of their own.

Per (device, source, identifier) the state is a map from message counter to the open
message: its next frame, its bytes so far, its length, and when it was last added
to. It lies in RocksDB, so open messages need no heap. Frames are handled
as columns: sorted by counter and sequence, a message begins at each frame 0, and all its
frames are held against their places at once; only complete messages and the one that
stays open in each counter are looked at singly. With a timeout, a timer removes messages
that nothing was added to for so long; a query that runs to the end of its input needs none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MESSAGE = "device_id string, src string, can_id long, seq long, ts timestamp, payload string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["device_id", "src", "can_id"]
MESSAGE_NAMES = [*KEYS, "seq", "ts", "payload"]
#: Sequence numbers of a slice.
SLICE = 1 << 17
#: What is cut from a slice: whole messages, by slice, and edges, all of a key under slice 0.
FRAME = "counter int, frame int, length int, body string"
CUT = f"{MESSAGE}, whole boolean, slice long, {FRAME}"
CUT_NAMES = [c.split()[0] for c in CUT.split(", ")]
#: Frames that can follow one another in a message, frame 0 among them: their number has five bits.
RUN = 32


def frame_columns(frames: DataFrame) -> DataFrame:
    """KEYS, seq, ts, counter, frame, length (of a frame 0) and body (hex) of frames with a hex payload of two bytes at least."""
    first = "CAST(conv(substring(payload, 1, 2), 16, 10) AS INT)"
    length = "CASE WHEN {f} & 31 = 0 THEN CAST(conv(substring(payload, 3, 2), 16, 10) AS INT) END".format(f=first)
    body = f"CASE WHEN {first} & 31 = 0 THEN substring(payload, 5) ELSE substring(payload, 3) END"
    return frames.where("length(payload) >= 4").selectExpr(*KEYS, "seq", "ts", f"shiftright({first}, 5) AS counter", f"{first} & 31 AS frame", f"{length} AS length", f"{body} AS body")


def put_together(frames: pd.DataFrame, open_: dict[int, tuple[int, str, int]]) -> tuple[list[tuple[int, Any, str]], dict[int, tuple[int, str, int]]]:
    """(seq, ts, payload) of the messages that frames (counter, seq, ts, frame, length, body) complete, and the open messages after them.

    open_: of each counter the next frame, the hex so far and the length. A message ends where a frame is not the
    next one; what follows, up to the next frame 0, belongs to none.
    """
    frames = frames.sort_values(["counter", "seq"], kind="stable")
    counter, number = frames["counter"].to_numpy(), frames["frame"].to_numpy()
    n = len(frames)
    fresh = np.append(True, counter[1:] != counter[:-1])  # a counter's first frame goes on with what is open, unless it begins a message
    begin = np.flatnonzero(fresh | (number == 0))
    end = np.append(begin[1:], n)
    begins = number[begin] == 0
    held = [(0, "", int(x)) if zero else open_.get(int(c), (-1, "", 0)) for zero, c, x in zip(begins, counter[begin], pd.to_numeric(frames["length"]).fillna(0).to_numpy()[begin], strict=True)]
    have, need = np.array([h[0] for h in held]), np.array([(max(h[2] - 6, 0) + 6) // 7 + 1 for h in held])
    # Frames that stand in their place: as many as run from what is there on without a gap.
    size = end - begin
    place = np.arange(n) - np.repeat(begin, size) + np.repeat(have, size)
    wrong = np.flatnonzero((number != place) | (np.repeat(have, size) < 0))
    stop = np.minimum(end, np.append(wrong, n)[np.searchsorted(wrong, begin)])
    whole = (have >= 0) & (have + stop - begin >= need)
    last = np.append(fresh[begin[1:]], True)  # of its counter
    bodies, seq, ts = frames["body"].to_numpy(), frames["seq"].to_numpy(), frames["ts"].to_numpy()
    done, left = [], dict(open_)
    for k in np.flatnonzero(whole):
        a, b = begin[k], begin[k] + need[k] - have[k]
        text = held[k][1] + "".join(bodies[a:b])
        if len(text) >= 2 * held[k][2]:
            done.append((int(seq[b - 1]), ts[b - 1], text[: 2 * held[k][2]]))
    for k in np.flatnonzero(last):
        c = int(counter[begin[k]])
        left.pop(c, None)
        if not whole[k] and have[k] >= 0 and stop[k] == end[k]:
            left[c] = (int(have[k] + size[k]), held[k][1] + "".join(bodies[begin[k] : end[k]]), held[k][2])
    return done, left


def parted(frames: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """A slice's frames, and which of them are followed by another frame 0 of their counter, and follow one: (these, the edges).

    Of an edge there are RUN frames and one more, which is out of its place in any message, so that an open message is known to end.
    """
    frames = frames.sort_values(["counter", "seq"], kind="stable")
    counter, zero = frames["counter"].to_numpy(), frames["frame"].to_numpy() == 0
    n = len(frames)
    place = np.arange(n)
    fresh = np.append(True, counter[1:] != counter[:-1])
    first = np.flatnonzero(fresh)
    of = np.cumsum(fresh) - 1
    begun = np.cumsum(zero) - (np.cumsum(zero) - zero)[first][of]  # messages of the counter, up to each frame
    all_ = np.append(begun[first[1:] - 1], begun[-1])[of]
    inner = (begun > 0) & (begun < all_)
    start = np.maximum.accumulate(np.where(fresh | zero, place, 0))
    return frames[inner], frames[~inner & (place - start <= RUN)]


def within(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
    """CUT rows of a slice: its whole messages but the last of each counter, and its edges."""
    inner, edges = parted(frames)
    edges = edges.assign(payload=None, whole=False, slice=0)
    done = put_together(inner, {})[0] if len(inner) else []
    if not done:
        return edges[CUT_NAMES]
    whole = pd.DataFrame(done, columns=["seq", "ts", "payload"])
    whole = whole.assign(**dict(zip(KEYS, key[:3], strict=True)), whole=True, slice=key[3], counter=0, frame=0, length=0, body="")
    return pd.concat([whole[CUT_NAMES], edges[CUT_NAMES]], ignore_index=True)


class Reassembler(StatefulProcessor):
    def __init__(self, timeout_ms: int | None = None):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "counter int", "next int, body string, length int, since long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        *key, whole, _ = key
        if whole:
            for messages in rows:
                yield messages[MESSAGE_NAMES]
            return
        frames = pd.concat(list(rows))
        before = {int(c[0]): v for c, v in self.open.iterator()} if self.open.exists() else {}
        done, after = put_together(frames, {c: (int(v[0]), v[1], int(v[2])) for c, v in before.items()})
        now = timerValues.getCurrentProcessingTimeInMs() if self.timeout_ms is not None else 0
        for c in before.keys() - after.keys():
            self.open.removeKey((c,))
        for c, held in after.items():
            if c not in before or tuple(before[c][:3]) != held:
                self.open.updateValue((c,), (*held, now))
        if self.timeout_ms is not None and after:
            self.handle.registerTimer(now + self.timeout_ms)
        if done:
            yield pd.DataFrame([(*key, *m) for m in sorted(done, key=lambda m: m[0])], columns=MESSAGE_NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Messages that nothing was added to since the timer was set go; a younger one has a timer of its own."""
        old = [c for c, v in self.open.iterator() if int(v[3]) + self.timeout_ms <= expiredTimerInfo.getExpiryTimeInMs()]
        for c in old:
            self.open.removeKey(tuple(c))
        return iter(())

    def close(self) -> None:
        pass


def reassemble_stream(frames: DataFrame, timeout_ms: int | None = None, slice_: int = SLICE) -> DataFrame:
    """MESSAGE: the complete fast packets of a stream of frames (device_id, src, can_id, seq, ts, hex payload).

    slice_: sequence numbers of a slice, of which a task holds the frames of one identifier.

    The session keeps its state in RocksDB from here on, as this kind of state asks for.
    """
    frames.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    mode = "None" if timeout_ms is None else "ProcessingTime"
    sliced = frame_columns(frames).withColumn("slice", F.expr(f"CAST(floor(seq / {slice_}) AS BIGINT)"))
    cut = sliced.groupBy(*KEYS, "slice").applyInPandas(within, CUT)
    return cut.groupBy(*KEYS, "whole", "slice").transformWithStateInPandas(Reassembler(timeout_ms), MESSAGE, "Append", mode)
