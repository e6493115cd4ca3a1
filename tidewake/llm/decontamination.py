"""Benchmark decontamination by suffix arrays over the training texts.

The training words of a shard (the documents of some Arrow batches, SHARD_BYTES of
text or one document) get a suffix array over all their suffixes. Every test suffix
that begins a window (WINDOW words, or a whole shorter item) is binary-searched in it: the
range of training suffixes that begin with the window are its verbatim
occurrences, and words inside any of them are hit. From each place where an
occurrence begins, the training text is searched in a suffix array of the test
words for the longest verbatim match; a document's longest, with its places in
document and item, stands in its row.

The test set is stored in blocks of about BLOCK_WORDS words in the shared
folder, built by as many tasks. Each task goes through the blocks one after another for each shard, so the
documents are read and shuffled no more than once, and a task holds HELD_BLOCKS blocks, however many there are.

Words are compared by 64-bit hashes of their bytes. Defined results: a null or
wordless text has no words and is clean; texts of any length are searched
whole; null or wordless items occur nowhere; repeated item rows count once by item_id;
a null item_id is never reported but its words are hit; repeated documents are judged
each on its own, whatever their ids, null or not; an empty table of either kind
gives clean documents or none. Other columns never matter and pass through `remove_contaminated`.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, read_file, small_batches, write_file
from .suffixes import SuffixArray
from .text import ALNUM, Texts, grouped

WINDOW = 10
#: Words of items in one block, about 40 bytes each in a task; text bytes of a shard.
BLOCK_WORDS, SHARD_BYTES = 500_000, 4 << 20
#: Blocks that a task holds at most, some 25 MB each.
HELD_BLOCKS = 8
#: Occurrences that are looked at together.
CHUNK = 1 << 20

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, match_word long, match_item string, match_item_word long"


@dataclass
class TestSet:
    """A block of items: the suffix array of their words, and their distinct windows with the items that have each."""

    words: np.ndarray  # hashes, items end to end
    array: SuffixArray
    start: np.ndarray  # of each distinct window
    length: np.ndarray
    owner: np.ndarray  # (window, item) pairs, sorted
    names: list[str | None]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    texts = Texts(column, lower=True)
    starts, ends, doc = texts.runs(ALNUM[texts.data])
    return texts.hashes(starts, ends), doc, texts.n


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... so many from each."""
    return np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def test_set(items: list[tuple[str | None, str | None]]) -> TestSet:
    words, item, _ = words_of(pa.array([t for _, t in items], pa.string()))
    array = SuffixArray(words, item)
    size = np.bincount(item, minlength=len(items))
    first = np.cumsum(size) - size
    windows = np.where(size > 0, np.maximum(size - WINDOW + 1, 1), 0)
    start = spread(first, windows)
    owner = np.repeat(np.arange(len(items)), windows)
    length = np.minimum(size[owner], WINDOW)
    # Equal windows begin the same range of the array and have one length.
    low, _ = array.find(array.ids, start, length)
    _, keep, back = np.unique(low * (WINDOW + 1) + length, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack([back, owner], axis=1), axis=0) if len(start) else np.zeros((0, 2), np.int64)
    return TestSet(words, array, start[keep], length[keep], pairs, [i for i, _ in items])


def item_blocks(spark: SparkSession, items: DataFrame) -> list[str]:
    """Paths of the stored blocks. Tasks build and write them, each from its share of the items; the driver has the paths alone."""
    folder = new_folder(spark, "test-suffixes")
    # About as many words as a text can have: one for two characters.
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct().withColumn("size", F.length("text") / 2 + 1)
    tasks = 1 + int((rows.agg(F.sum("size")).first()[0] or 0) / BLOCK_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, made = TaskContext.get(), 0
        held: list[tuple[str | None, str | None]] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal made, size
            path = f"{folder}/block-{context.partitionId():06d}-{made:06d}"
            write_file(path, pickle.dumps(test_set(held)), str(context.taskAttemptId()))
            made, size = made + 1, 0
            held.clear()
            return pa.record_batch({"path": pa.array([path])})

        for batch in batches:
            for item, text, own in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text", "size")), strict=True):
                held.append((item, text))
                size += own
                if size >= BLOCK_WORDS:
                    yield close()
        if held:
            yield close()

    dealt = rows.repartition(tasks, "item_id", "text").sortWithinPartitions("item_id", "text")
    return sorted(r["path"] for r in dealt.mapInArrow(run, "path string").collect())


@lru_cache(maxsize=HELD_BLOCKS)
def block_at(path: str) -> TestSet:
    """The block; a task holds the last few."""
    return pickle.loads(read_file(path))


@dataclass
class Found:
    """What the blocks' windows hit in a shard: words, (document, item) names, and each document's longest match."""

    hit: np.ndarray
    items: list[set[str]]
    match: list[tuple]  # (-words, document's word, no item name, item name, item's word)


def search(shard: SuffixArray, hashes: np.ndarray, doc: np.ndarray, tests: TestSet, found: Found | None, hits: np.ndarray) -> None:
    """Mark in hits the change of coverage at each word; add items and matches to found."""
    words = shard.numbers(tests.words)
    low, high = shard.find(words, tests.start, tests.length)
    some = np.flatnonzero(high > low)
    count = (high - low)[some]
    begins = np.zeros(len(hashes), bool)
    ends = np.cumsum(count)
    cuts = np.searchsorted(ends, np.arange(CHUNK, int(ends[-1]) if len(ends) else 0, CHUNK)).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(some)], strict=True):
        if a == b:
            continue
        window = np.repeat(some[a:b], count[a:b])
        at = shard.order[spread(low[some[a:b]], count[a:b])]
        np.add.at(hits, at, 1)
        np.add.at(hits, at + tests.length[window], -1)
        begins[at] = True
        if found is None:
            continue
        pair = np.unique(doc[at] * len(tests.start) + window)
        owner = np.searchsorted(tests.owner[:, 0], [pair % len(tests.start), pair % len(tests.start) + 1])
        each = owner[1] - owner[0]
        item = tests.owner[spread(owner[0], each), 1]
        for d, i in np.unique(np.stack([np.repeat(pair // len(tests.start), each), item], axis=1), axis=0).tolist():
            if tests.names[i] is not None:
                found.items[d].add(tests.names[i])
    at = np.flatnonzero(begins)
    if found is None or not len(at):
        return
    length, first, last = tests.array.longest(tests.array.numbers(hashes), at, shard.end[at])
    own = doc[at]
    order = np.lexsort((at, -length, own))
    best = order[np.flatnonzero(np.diff(own[order], prepend=-1))]
    begin = np.searchsorted(doc, own[best])
    for d, k, b in zip(own[best].tolist(), best.tolist(), begin.tolist(), strict=True):
        places = tests.array.order[first[k] : last[k]]
        item = tests.array.text[places]
        word = places - np.searchsorted(tests.array.text, item)
        name = min((tests.names[i] is None, tests.names[i] or "", w) for i, w in zip(item.tolist(), word.tolist(), strict=True))
        found.match[d] = min(found.match[d], (-int(length[k]), int(at[k]) - b, *name))


NO_MATCH = (0, 0, True, "", 0)


def examine(column: pa.Array, blocks: list[str], details: bool) -> tuple[np.ndarray, np.ndarray, Found]:
    """Words and hit words of each document of a shard, and with details what was found."""
    hashes, doc, n = words_of(column)
    hits = np.zeros(len(hashes) + 1, np.int64)
    found = Found(hits, [set() for _ in range(n)], [NO_MATCH] * n) if details else None
    if len(hashes):
        shard = SuffixArray(hashes, doc)
        for path in blocks:
            search(shard, hashes, doc, block_at(path), found, hits)
    covered = np.cumsum(hits[:-1]) > 0
    return np.bincount(doc, minlength=n), np.bincount(doc, covered, n).astype(np.int64), found


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """RESULT for each row of docs, in one pass without a shuffle. Words of documents and items are counted from 0; match_*: the longest match, the first of equals."""
    small_batches(spark)
    blocks = item_blocks(spark, items)
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, SHARD_BYTES):
            words, hit, found = examine(part.column("text"), blocks, True)
            rows = []
            for n, h, own, (length, word, none, name, item_word) in zip(words.tolist(), hit.tolist(), found.items, found.match, strict=True):
                match = (-length, word, None if none else name, item_word) if length else (0, None, None, None)
                rows.append((n, h, len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), h > 0, *match))
            yield pa.record_batch([part.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def remove_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The clean rows of docs, all columns as they are; no shuffle."""
    small_batches(spark)
    blocks = item_blocks(spark, items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, SHARD_BYTES):
            yield part.filter(pa.array(examine(part.column("text"), blocks, False)[1] == 0))

    return docs.mapInArrow(run, docs.schema)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
