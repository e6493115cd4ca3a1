"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets. A source's size is the words of its documents. Sources by code point,
null last, weigh WEIGHTS in turn and share SHARE times all words; a target stops
at LIMIT times its source's size, and what is over is shared anew by weight.

Blocks. A source's documents stand in a permuted order, by a keyed hash of id and
text, their words end to end, cut into blocks of equal words (the last is what is
left). The words to take make the source's exact quota of draws: whole passes over
its blocks, then blocks once more, the last one in part, so the words taken are
the rounded target. Each pass has a keyed permutation of the blocks of its own.

Tree. A binary tree over the output shards parts the quotas: at each node the left
half's quotas are drawn from the multivariate hypergeometric law, keyed by the
node, so quotas add up exactly at every level. A shard takes its quota of a source
as the next draws in the source's permuted order: blocks are disjoint. A
document is taken with the words of it that lie in drawn blocks, in one or more
pieces a pass; `mixed_rows` brings each piece to its shard and shuffles it there.

Sizes. A block has BLOCK_WORDS words, more only where a corpus would have over
2^MAX_BLOCKS blocks; a shard has about SHARD_BLOCKS blocks, more only where
shards and sources would make over MAX_QUOTAS quotas, which are broadcast. The driver
holds a row a source and its quotas, never documents. Prefix sums run within hash
ranges of a source, from the sums of the ranges before, so that a source with a
third of all rows is dealt out over many tasks.

Defined results: null or wordless texts have size 0 and nothing of them is
taken; null is a source of its own, an empty one another; repeated rows are each
a document of their own; a null doc_id is hashed as null; long texts are taken in as
many pieces as blocks cut them; an empty table gives an empty table. Other columns
never matter and pass through `mixed_rows`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize, small_batches, unused
from .text import NON_SPACE, Texts, mix as mixed_bits, slices

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
SEED = 2024
BLOCK_WORDS, MAX_BLOCKS = 1 << 14, 29
SHARD_BLOCKS, MAX_QUOTAS = 256, 1 << 22
#: Documents of a hash range of all sources, about, and the least number of ranges.
RANGE_DOCS, MIN_RANGES = 50_000, 1024

PIECES = "array<struct<shard:long,place:long,first:long,words:long>>"


def targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> list[float]:
    """The share of each source, in order of weight, none above limit times its size."""
    out = [0.0] * len(sizes)
    open_ = [k for k, n in enumerate(sizes) if n > 0]
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    left = share * sum(sizes)
    while open_:
        all_weight = sum(weight[k] for k in open_)
        full = {k for k in open_ if left * weight[k] / all_weight > limit * sizes[k]}
        if not full:
            for k in open_:
                out[k] = left * weight[k] / all_weight
            break
        for k in full:
            out[k] = limit * sizes[k]
        left -= sum(out[k] for k in full)
        open_ = [k for k in open_ if k not in full]
    return out


@dataclass
class Draws:
    """Of one source: its words, those to take, its blocks, the number of draws, and words of the last draw (0: all of its block)."""

    size: int
    target: float
    block: int
    key: int
    blocks: int = field(init=False)
    quota: int = field(init=False)
    part: int = field(init=False)
    ends: np.ndarray = field(init=False, default_factory=lambda: np.zeros(1, np.int64))  # draws of the shards up to and with each

    def __post_init__(self) -> None:
        self.blocks = -(-self.size // self.block)
        self.quota = self.part = 0
        if not self.size:
            return
        whole, rest = divmod(round(self.target), self.size)
        # In the pass after the whole ones: k draws of whole blocks, one of which may be the short last block.
        short = self.blocks * self.block - self.size
        last = int(self.places(whole, np.array([self.blocks - 1]))[0])
        k = rest // self.block
        if last < k or (last == k and rest - k * self.block >= self.block - short):
            k = (rest + short) // self.block
        words = k * self.block - (short if last < k else 0)
        self.part = rest - words
        self.quota = whole * self.blocks + k + (self.part > 0)

    def places(self, pass_: int, blocks: np.ndarray) -> np.ndarray:
        """Where blocks stand in the permuted order of a pass: a keyed Feistel network, walked on until it falls within."""
        n = self.blocks
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        low = np.uint64((1 << half) - 1)
        x = blocks.astype(np.uint64)
        out = np.full(len(x), -1, np.int64)
        open_ = np.arange(len(x))
        while len(open_):
            left, right = x >> np.uint64(half), x & low
            for r in range(6):
                turn = mixed_bits(right + np.uint64(((self.key * 8 + pass_) * 8 + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                left, right = right, left ^ (turn & low)
            x = (left << np.uint64(half)) | right
            inside = x < n
            out[open_[inside]] = x[inside].astype(np.int64)
            open_, x = open_[~inside], x[~inside]
        return out

    def pieces(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Document, shard, first word and words of what is taken of documents that begin at these words of the source."""
        end = start + size
        count = np.where(size > 0, (end - 1) // self.block - start // self.block + 1, 0)
        doc = np.repeat(np.arange(len(start)), count)
        block = start[doc] // self.block + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.maximum(start[doc], block * self.block)
        stop = np.minimum(end[doc], (block + 1) * self.block)
        out = []
        for pass_ in range(-(-self.quota // self.blocks) if self.blocks else 0):
            draw = pass_ * self.blocks + self.places(pass_, block)
            most = np.where((draw == self.quota - 1) & (self.part > 0), np.minimum(stop, block * self.block + self.part), stop)
            taken = np.flatnonzero((draw < self.quota) & (most > begin))
            shard = np.searchsorted(self.ends, draw[taken], "right")
            out.append((doc[taken], shard, begin[taken] - start[doc[taken]], (most - begin)[taken]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


@dataclass
class Plan:
    sources: dict[str | None, Draws]
    shards: int
    documents: int


def sizes_of(column: pa.Array) -> np.ndarray:
    texts = Texts(column)
    _, _, doc = texts.runs(NON_SPACE[texts.data])
    return np.bincount(doc, minlength=texts.n).astype(np.int64)


def order_hash() -> Column:
    """The permuting hash; rows that tie are equal in id and text."""
    return F.xxhash64("doc_id", "text", F.lit(SEED))


def sized(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, source, h, size of each row."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.drop_columns(["text"]).append_column("size", pa.array(sizes_of(part.column("text"))))

    return docs.select("doc_id", "source", "text", order_hash().alias("h")).mapInArrow(run, "doc_id long, source string, h long, size long")


def plan_sources(table: DataFrame, block_words: int | None = None) -> Plan:
    """One row a source comes to the driver; quotas of all shards are drawn there."""
    rows = table.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # Python compares by code point
    sizes = [r["size"] for r in rows]
    wanted = targets(sizes)
    block = max(BLOCK_WORDS, sum(map(round, wanted)) >> MAX_BLOCKS)
    draws = [Draws(n, t, block, k) for k, (n, t) in enumerate(zip(sizes, wanted, strict=True))]
    quotas = np.array([d.quota for d in draws], np.int64)
    shards = max(1, min(-(-int(quotas.sum()) // SHARD_BLOCKS), MAX_QUOTAS // max(1, len(draws))))
    ends = np.cumsum(split_quotas(quotas, shards), axis=0)
    for d, e in zip(draws, ends.T, strict=True):
        d.ends = np.ascontiguousarray(e)
    return Plan({r["source"]: d for r, d in zip(rows, draws, strict=True)}, shards, sum(r["n"] for r in rows))


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources) block counts: each source's quota parted by the splitting tree; shard sizes differ by one at most."""
    out = np.zeros((shards, len(quotas)), np.int64)
    held = [(0, shards, np.asarray(quotas, np.int64))]
    while held:
        low, high, have = held.pop()
        if high - low == 1:
            out[low] = have
            continue
        middle = (low + high) // 2
        slots = int(have.sum()) * (middle - low) // (high - low)
        rng = np.random.Generator(np.random.Philox(key=[seed, low << 32 | high]))
        left = rng.multivariate_hypergeometric(have, slots, method="marginals") if len(have) else have
        held += [(low, middle, left), (middle, high, have - left)]
    return out


def ranges_of(plan: Plan) -> int:
    """Bits of the permuting hash that are its range."""
    return max(MIN_RANGES, plan.documents // RANGE_DOCS).bit_length() - 1


def with_range(table: DataFrame, bits: int, name: str) -> DataFrame:
    """The top bits of h, in the order of h."""
    return table.withColumn(name, F.shiftrightunsigned("h", 64 - bits).bitwiseXOR(1 << (bits - 1)).cast("int"))


def dealt(spark: SparkSession, table: DataFrame, sizes: DataFrame, plan: Broadcast, emit, schema) -> DataFrame:
    """What emit makes of the rows of table (h, source, and others) with their start words, in the permuted order.

    sizes: the stored source, h and size of the same rows. The words before each
    range come as rows of their own, first in their range, so no join is needed.
    """
    bits = ranges_of(plan.value)
    names = table.columns
    part, before, first = (unused(n, names) for n in ("_range", "_before", "_first"))
    sums = with_range(sizes, bits, "r").groupBy("source", "r").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    marks = sums.select("source", F.col("r").alias(part), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before), F.lit(True).alias(first))
    rows = with_range(table, bits, part).withColumn(before, F.lit(0).cast("long")).withColumn(first, F.lit(False))
    every = rows.unionByName(marks, allowMissingColumns=True)
    stood = every.repartition("source", part).sortWithinPartitions("source", part, F.col(first).desc(), "h", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for piece in slices(batch) if "text" in names else [batch]:
                size = sizes_of(piece.column("text")) if "text" in names else piece.column("size").fill_null(0).to_numpy()
                mark = piece.column(first).to_numpy(zero_copy_only=False)
                base = piece.column(before).to_numpy()
                # Words before each row since the last mark, or since the rows before this batch.
                run_on = np.cumsum(size) - size
                last = np.maximum.accumulate(np.where(mark, np.arange(len(mark)), -1))
                start = np.where(last >= 0, base[last] + run_on - run_on[last], at + run_on)
                at = int(start[-1] + size[-1]) if len(start) else at
                own = np.flatnonzero(~mark)
                yield from emit(piece.take(pa.array(own)), start[own], size[own], plan.value)

    return stood.mapInArrow(run, schema)


def by_source(column: pa.Array) -> Iterator[tuple[str | None, np.ndarray]]:
    coded = column.dictionary_encode(null_encoding="encode")
    own = coded.indices.to_numpy()
    for k, name in enumerate(coded.dictionary.to_pylist()):
        yield name, np.flatnonzero(own == k)


def pieces_of(batch: pa.RecordBatch, start: np.ndarray, size: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """Row, shard, place in the shard, first word and words of each piece, by row."""
    found = [(np.zeros(0, np.int64),) * 4]
    for name, rows in by_source(batch.column("source")):
        doc, shard, first, words = plan.sources[name].pieces(start[rows], size[rows])
        found.append((rows[doc], shard, first, words))
    row, shard, first, words = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((first, shard, row))
    row, shard, first, words = row[order], shard[order], first[order], words[order]
    h = batch.column("h").to_numpy().view(np.uint64)
    place = mixed_bits(h[row] + mixed_bits((start[row] + first).astype(np.uint64) * np.uint64(31) + shard.astype(np.uint64)))
    return row, shard, place.view(np.int64), first, words


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, pieces for each row: each piece with its output shard, its order there, and its words."""
    table = materialize(spark, sized(spark, docs), "sizes")
    plan = spark.sparkContext.broadcast(plan_sources(table))
    names = ["doc_id", "source", "size", "source_size", "target", "taken", "pieces"]

    def emit(batch: pa.RecordBatch, start: np.ndarray, size: np.ndarray, plan: Plan) -> Iterator[pa.RecordBatch]:
        row, shard, place, first, words = pieces_of(batch, start, size, plan)
        count = np.bincount(row, minlength=batch.num_rows)
        offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in (shard.astype(np.int64), place, first, words)], ["shard", "place", "first", "words"]))
        own = [plan.sources[s] for s in batch.column("source").to_pylist()]
        taken = np.bincount(row, words, batch.num_rows).astype(np.int64)
        yield pa.record_batch([batch.column("doc_id"), batch.column("source"), pa.array(size), pa.array([d.size for d in own], pa.int64()), pa.array([d.target for d in own], pa.float64()), pa.array(taken), pieces], names)

    return dealt(spark, table, table, plan, emit, f"doc_id long, source string, size long, source_size long, target double, taken long, pieces {PIECES}")


def words_between(texts: Texts, rows: np.ndarray, first: np.ndarray, words: np.ndarray) -> list[bytes]:
    """The text from a row's word first on, for so many words."""
    starts, ends, doc = texts.runs(NON_SPACE[texts.data])
    begin = np.searchsorted(doc, np.arange(texts.n))
    a, b = begin[rows] + first, begin[rows] + first + words - 1
    raw = texts.data.tobytes()
    return [raw[x:y] for x, y in zip(starts[a].tolist(), ends[b].tolist(), strict=True)]


def mixed_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pieces that the mix draws, as rows of docs, brought to their shards and shuffled there.

    A piece of all words of a text is the row as it is; others have their part of the
    text, and its characters in n_chars where there is such a column of numbers.
    Each shard is a partition, in an order by hash.
    """
    table = materialize(spark, sized(spark, docs).select("source", "h", "size"), "sizes")
    plan = spark.sparkContext.broadcast(plan_sources(table))
    names = docs.columns
    shard_, place_, whole_ = (unused(n, [*names, "h"]) for n in ("_shard", "_place", "_whole"))

    def emit(batch: pa.RecordBatch, start: np.ndarray, size: np.ndarray, plan: Plan) -> Iterator[pa.RecordBatch]:
        row, shard, place, first, words = pieces_of(batch, start, size, plan)
        whole = words == size[row]
        text = batch.column("text").take(pa.array(row))
        if not whole.all():
            cut = np.flatnonzero(~whole)
            parts = words_between(Texts(batch.column("text")), row[cut], first[cut], words[cut])
            parts = pa.array(parts, pa.binary()).cast(pa.string())
            index = np.arange(len(row))
            index[cut] = len(row) + np.arange(len(cut))
            text = pa.concat_arrays([text.cast(pa.string()), parts]).take(pa.array(index))
        taken = batch.take(pa.array(row))
        columns = [text if c == "text" else taken.column(own[c]) for c in names]
        yield pa.record_batch([*columns, pa.array(shard.astype(np.int64)), pa.array(place), pa.array(whole)], [*names, shard_, place_, whole_])

    # Within the plan the needed columns have fixed names; columns of the same names in other cases go by others.
    own = {c: c if c in ("doc_id", "source", "text") else f"c{k}" for k, c in enumerate(names)}
    read = docs.select(*(F.col(f"`{c}`").alias(own[c]) for c in names), order_hash().alias("h"))
    kinds = docs.withColumn(shard_, F.lit(0).cast("long")).withColumn(place_, F.lit(0).cast("long")).withColumn(whole_, F.lit(True)).schema
    drawn = dealt(spark, read, table, plan, emit, kinds)
    dealt_out = drawn.repartitionById(plan.value.shards, F.col(shard_).cast("int")).sortWithinPartitions(shard_, place_)
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        dealt_out = dealt_out.withColumn("n_chars", F.when(F.col(whole_), F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return dealt_out.select(*names)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.array_sort(F.array_distinct("pieces.shard")).alias("shards"))
