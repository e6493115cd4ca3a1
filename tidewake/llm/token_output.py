"""Token ids of a corpus in wavelet-matrix files, and their digest read back.

The documents are dealt by ranges of doc_id and sorted within, so the shard
files, numbered by partition and place, hold them in ascending doc_id order.
Each file goes to the shared folder under a name of its own attempt and
is then renamed: a task that is run again replaces its files by equal ones. A manifest
row per file carries the counts; the sums over it give each file's first
place in the corpus. Files hold SHARD_IDS ids or one document.

Defined results: a null or empty text has the end id alone; a null doc_id
comes first; rows that repeat a doc_id follow one another in order of
their texts; an empty table gives an empty table. Other columns never matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .codec import GROUP_BYTES, codec
from .shared import materialize, new_folder, read_file, small_batches, write_file
from .text import Texts, grouped
from .token_counts import vocabulary_path
from .wavelet import WaveletShard, build

END_ID = 2
SHARD_IDS = 1 << 21
MANIFEST = "part long, shard long, path string, n_docs long, n_ids long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_shards(spark: SparkSession, docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode docs into wavelet files under folder; returns the manifest, stored beside them."""
    small_batches(spark, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), f"try-{context.taskAttemptId()}"
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        names: list[int | None] = []
        shard = 0

        def close() -> pa.RecordBatch:
            nonlocal shard
            path = f"{folder}/part-{part:06d}-{shard:06d}.wm"
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            write_file(path, build(np.concatenate(ids), bounds, names), attempt)
            row = pa.record_batch({"part": [part], "shard": [shard], "path": [path], "n_docs": [len(names)], "n_ids": [int(bounds[-1])]})
            shard += 1
            ids.clear(), sizes.clear(), names.clear()
            return row

        held = 0
        for piece in grouped(batches, GROUP_BYTES):
            got, n = codec(vocabulary).encode(Texts(piece.column("text")))
            ids.append(np.insert(got, np.cumsum(n), end_id))
            sizes.append(n + 1)
            names.extend(piece.column("doc_id").to_pylist())
            held += len(got) + len(n)
            if held >= SHARD_IDS:
                yield close()
                held = 0
        if names:
            yield close()

    # Ranges of ids, and of the beginnings of texts where an id repeats, or is null in many rows.
    dealt = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id"), F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    return materialize(spark, dealt.mapInArrow(run, MANIFEST), "manifest")


#: Characters of a text that its range goes by.
RANGE_CHARS = 64


def read_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """RESULT for each document of the shards. Places are summed within parts, and over the parts' sums, a row a task that wrote."""
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", earlier(Window.orderBy("part")).alias("_before"))
    within = manifest.withColumn("_within", earlier(Window.partitionBy("part").orderBy("shard")))
    placed = within.join(parts, "part").select("path", (F.col("_before") + F.col("_within")).alias("first"))
    files = spark.sparkContext.defaultParallelism * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                shard = WaveletShard(read_file(path))
                data, bounds = memoryview(shard.decode().astype("<u4").tobytes()), shard.bounds.tolist()
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.record_batch([pa.array(shard.doc_ids, pa.int64()), pa.array(shard.bounds[:-1] + first), pa.array(np.diff(shard.bounds)), pa.array(crc, pa.int64())], [x.split()[0] for x in RESULT.split(", ")])

    return placed.repartition(files, "path").select("path", "first").mapInArrow(run, RESULT)


def token_output(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    return read_shards(spark, write_shards(spark, docs, vocabulary, new_folder(spark, "token-shards")))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path("byte_bpe_50k.json"))
