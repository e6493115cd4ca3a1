"""Token-id shards as wavelet matrices.

A shard holds the ids of consecutive documents as bit-planes, most significant
bit first; below each plane the ids stand stably parted, zeros first. With a count
of ones for every BLOCK bits this gives access(i), rank(token, i), count(token)
and select(token, k) in one step per plane from the packed file alone, in
ceil(log2(max id + 1)) bits an id plus 1/16.

File, little-endian: MAGIC, then int64 n, planes, documents; int64 zeros of each
plane; int64 first id of each document and n; int64 doc_id, uint8 null flag of
each document; for each plane the packed bits (8-byte padded) and its block counts as uint32.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"TWWM0001"
BLOCK = 512


def build(ids: np.ndarray, bounds: np.ndarray, doc_ids: list[int | None]) -> bytes:
    """The bytes of a shard. bounds: first id of each document, and the number of ids."""
    n = len(ids)
    planes = max(1, int(ids.max()).bit_length()) if n else 1
    ids = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, body = [], []
    for p in range(planes - 1, -1, -1):
        one = (ids & ids.dtype.type(1 << p)) != 0
        packed = np.zeros(-(-n // 64) * 8, np.uint8)
        bits = np.packbits(one, bitorder="little")
        packed[: len(bits)] = bits
        body.append(packed.tobytes())
        body.append(block_counts(packed).tobytes())
        zeros.append(n - int(one.sum()))
        if p:
            ids = np.concatenate([ids.compress(~one), ids.compress(one)])
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        MAGIC,
        struct.pack("<3q", n, planes, len(doc_ids)),
        np.array(zeros, "<i8").tobytes(),
        np.asarray(bounds, "<i8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        null.tobytes(),
        *body,
    ])


def block_counts(packed: np.ndarray) -> np.ndarray:
    """Ones before each block of BLOCK bits, and in all."""
    words = packed.view("<u8")
    ones = np.bitwise_count(words).astype(np.uint32)
    per_block = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 64), dtype=np.uint32) if len(ones) else np.zeros(0, np.uint32)
    return np.concatenate([np.zeros(1, np.uint32), np.cumsum(per_block, dtype=np.uint32)])


class WaveletShard:
    """A shard, read from its bytes without unpacking."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet shard")
        at = len(MAGIC)
        self.n, self.planes, documents = struct.unpack_from("<3q", data, at)
        at += 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.zeros = take("<i8", self.planes)
        self.bounds = take("<i8", documents + 1)
        ids, null = take("<i8", documents), take("u1", documents)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, null, strict=True)]
        self.bits, self.counts = [], []
        for _ in range(self.planes):
            self.bits.append(take("u1", -(-self.n // 64) * 8))
            self.counts.append(take("<u4", -(-(-(-self.n // 64)) // (BLOCK // 64)) + 1))

    def ones(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        first = block * BLOCK // 8
        whole = int(np.bitwise_count(self.bits[plane][first : i // 8]).sum())
        rest = int(self.bits[plane][i // 8]) & ((1 << (i % 8)) - 1) if i % 8 else 0
        return int(self.counts[plane][block]) + whole + rest.bit_count()

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for p in range(self.planes):
            bit = self.bits[p][i // 8] >> (i % 8) & 1
            out = out << 1 | int(bit)
            one = self.ones(p, i)
            i = int(self.zeros[p]) + one if bit else i - one
        return out

    def span(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences among the first end ids stand below the last plane."""
        low = 0
        if token < 0 or token >> self.planes:
            return 0, 0
        for p in range(self.planes):
            a, b = self.ones(p, low), self.ones(p, end)
            if token >> (self.planes - 1 - p) & 1:
                low, end = int(self.zeros[p]) + a, int(self.zeros[p]) + b
            else:
                low, end = low - a, end - b
        return low, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of token among the first i ids."""
        low, end = self.span(token, min(max(i, 0), self.n))
        return end - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the token's occurrence k, from 0."""
        low, end = self.span(token, self.n)
        if not 0 <= k < end - low:
            raise IndexError(k)
        i = low + k
        for p in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - p) & 1
            i = self.nth(p, i - int(self.zeros[p]) if bit else i, bit)
        return i

    def nth(self, plane: int, k: int, bit: int) -> int:
        """The place of the plane's k-th bit of that value, from 0, by binary search in the block counts."""
        counts = self.counts[plane].astype(np.int64)
        have = counts if bit else np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(have, k, "right")) - 1
        part = np.unpackbits(self.bits[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(have[block])])

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for p in range(self.planes - 1, -1, -1):
            one = np.unpackbits(self.bits[p], bitorder="little", count=self.n).view(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~one)] = ids[: self.zeros[p]]
            out[np.flatnonzero(one)] = ids[self.zeros[p] :] | kind(1 << (self.planes - 1 - p))
            ids = out
        return ids.astype(np.uint32)
