"""Vectorised text primitives over Arrow string columns.

A column's UTF-8 bytes are handled as one array with document bounds, in slices
of bounded size, so no Python code runs per character. Spans of up to LONG bytes
are hashed eight bytes at a time, with a mixing step after each, all spans at
once; longer ones by XXH3, one by one. Neither is linear in the bytes, so no
two texts collide by their structure; equal spans always get equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
#: Bytes up to which a span is hashed with all others at once.
LONG = 48
#: Odd constant, and the bits that the first k bytes of eight have.
ODD = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def byte_set(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: [^\x20\x09-\x0D]
NON_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Texts:
    """Some documents' UTF-8 bytes end to end. Null texts are empty."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]] if len(bounds) else raw
        self.bounds = bounds - bounds[0]
        if lower:
            self.data = LOWER[self.data]
        self.n = len(column)

    @property
    def starts(self) -> np.ndarray:
        return self.bounds[:-1]

    @property
    def ends(self) -> np.ndarray:
        return self.bounds[1:]

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each document have the flag."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.ends] - total[self.starts]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and documents of the maximal runs of flagged bytes within a document."""
        size = len(inside)
        if not size:
            none = np.zeros(0, np.int64)
            return none, none, none
        first = np.zeros(size + 1, bool)
        first[self.bounds[self.bounds < size]] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:size]
        starts = np.flatnonzero(begin)
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:size]
        ends = np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(self.bounds, starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span."""
        size = ends - starts
        out = size.astype(np.uint64) * ODD
        if not len(out):
            return out
        data = np.ascontiguousarray(self.data)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        # The eight bytes from each place on, as one number.
        eight = np.ndarray(len(padded) - 7, "<u8", padded, 0, (1,))
        at = np.flatnonzero(size <= LONG) if int(size.max()) > LONG else slice(None)
        here, left, h = starts[at], size[at], out[at]
        h = mix((h ^ (eight[here] & FIRST[np.minimum(left, 8)])) * ODD)
        for k in range(8, LONG, 8):
            more = np.flatnonzero(left > k)
            if not len(more):
                break
            chunk = eight[here[more] + k] & FIRST[np.minimum(left[more] - k, 8)]
            h[more] = mix((h[more] ^ chunk) * ODD)
        out[at] = h
        if not isinstance(at, slice):
            raw, digest = memoryview(data), xxhash.xxh3_64_intdigest
            far = np.flatnonzero(size > LONG)
            out[far] = np.fromiter((digest(raw[a:b], 42) for a, b in zip(starts[far].tolist(), ends[far].tolist(), strict=True)), np.uint64, len(far))
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values (as many as fit)."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mix((out ^ hashes[k : k + count]) * ODD)
    return out


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most limit text bytes each, or of one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and held + size > limit:
            yield batch.slice(begin, k - begin)
            begin, held = k, 0
        held += size
    yield batch.slice(begin)


def grouped(batches: Iterator[pa.RecordBatch], limit: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in batches of about limit text bytes: small ones are put together, large ones cut."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, text, limit):
            held.append(part)
            size += part.column(text).nbytes
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if any(part.num_rows for part in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
