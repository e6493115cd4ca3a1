"""A Bloom filter of 64-bit hashes, built by the executors, of bounded size.

It lets every value of the set through and few others, so what it stops needs
no join. Whatever passes is still joined: the filter never decides alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most 2^28 bits, 32 MB; bits that one task puts together.
MAX_BITS, CHUNK_BITS = 28, 17


def sieve_of(values: DataFrame, column: str, n: int) -> np.ndarray:
    """For about n values of a column of 64-bit hashes. Its bits come to the driver in chunks of 16 KB, 2^(MAX_BITS - CHUNK_BITS) of them at most."""
    bits = min(MAX_BITS, max(CHUNK_BITS, (16 * n).bit_length()))
    h = F.col(column)
    place = F.explode(F.array(h.bitwiseAND((1 << bits) - 1), F.shiftrightunsigned(h, 64 - bits)))
    places = values.select(place.alias("p")).select(F.shiftright("p", CHUNK_BITS).cast("int").alias("chunk"), F.col("p").bitwiseAND((1 << CHUNK_BITS) - 1).cast("int").alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, p = batch.column("chunk").to_numpy(), batch.column("p").to_numpy()
            for k in np.unique(chunk).tolist():
                held.setdefault(k, np.zeros(1 << CHUNK_BITS, bool))[p[chunk == k]] = True
        yield pa.record_batch({"chunk": pa.array(list(held), pa.int32()), "bits": pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())})

    out = np.zeros(1 << (bits - 5), np.uint32)
    size = 1 << (CHUNK_BITS - 5)
    for r in places.repartition("chunk").mapInArrow(run, "chunk int, bits binary").toLocalIterator():
        out[r["chunk"] * size : (r["chunk"] + 1) * size] = np.frombuffer(r["bits"], "<u4")
    return out


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set."""
    bits = (len(sieve) * 32).bit_length() - 1
    h = hashes.view(np.uint64)
    out = np.ones(len(h), bool)
    for p in ((h & np.uint64((1 << bits) - 1)).astype(np.int64), (h >> np.uint64(64 - bits)).astype(np.int64)):
        out &= (sieve[p >> 5] >> (p & 31).astype(np.uint32)) & 1 > 0
    return out
