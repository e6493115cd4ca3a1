"""Hard negatives by exact search in a rotated space.

Components become integers, floor(SCALE * x). One orthogonal matrix, the principal
axes of all vectors about the origin, turns them so that the leading components
carry most of a product. An anchor and a row are multiplied over the leading
components alone; what the others can add is at most the product of the two
remainders' norms, plus a slack for rounding. A pair whose bounds miss what the
anchor asks for is dropped there; the rest go on through further components, and
what is left is verified by integer products. Any orthogonal matrix gives the
same results, so rounding in the axes costs time at most.

The search answers wants: an anchor, and a range low..high of scores, of which the
first TOP rows are asked for. Positives are one want an anchor, among the rows of
its label; negatives are one want for each score of a positive, among the rows of
other labels, from 4/5 of that score up to it. Anchors lie in files of the shared
folder, as many as tasks have read them; each task holds a block of rows, of at most
ELEMENTS numbers, and reads the files one after another. A block keeps only the
TOP + 1 least ids of equal vectors of a label (no more can be in an answer), and sends
on at most TOP rows a want. Nothing grows with copies, and no task holds more than
a block of rows and one of anchors.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; missing components of shorter vectors are zero, and an empty vector has
score 0 with all; a row with a null vec_id is no anchor, keeps its label and comes after others of its
score; rows that repeat, ids or all, are rows of their own (an anchor row's other copies are other rows), so an id
that repeats as an anchor is answered for each of its rows; rows of equal score and id are in the order of
the stored table, which the result does not show; scores beyond a long are the nearest long; an
empty table gives an empty table. Columns other than vec_id, embedding and label never matter.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize, new_folder, read_file, write_file

SCALE = 256
#: Answers to a want.
TOP = 5
#: Anchors and relabelled rows: those whose id these divide; labels.
ANCHORS, RELABELLED, LABELS = 100, 7, 10
#: Numbers in a block of rows, in a file of anchors, in a tile of products, and in the pairs looked at together.
ELEMENTS, ANCHOR_ELEMENTS, TILE, PAIRS = 8 << 20, 2 << 20, 1 << 20, 4 << 20
#: Coordinates that are turned; the others stay as they are.
TURNED = 1024
#: Shares of the coordinates after which bounds are looked at.
STEPS = (0.25, 0.5)
#: Rounding: products of n numbers, and the axes themselves, err by less than this times n times the norms.
EPSILON = 64 * 2.0**-52
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

FOUND = "want long, place int, row long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """row (a key of the stored table), vec_id, embedding, label of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % RELABELLED == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    return vectors.where(F.col("label").isNotNull() & x.isNotNull() & finite).select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding", label.cast("long").alias("label"))


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """A row of floor(SCALE * x) each, in doubles, which hold them exactly."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        out = flat.reshape(-1, width)
    else:
        out = np.zeros((len(sizes), width))
        out[np.arange(width) < sizes[:, None]] = flat
    return np.floor(SCALE * out)


def axes(rows: DataFrame) -> np.ndarray:
    """The orthogonal matrix of all rows: principal axes of the first TURNED coordinates, strongest first.

    Tasks sum up products of coordinates; the sums of tasks meet by coordinate, and
    TURNED^2 / 2 numbers at most come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, width = np.zeros((0, 0)), 0
        for batch in batches:
            x = whole_numbers(batch.column("embedding"), 0)
            width = max(width, x.shape[1])
            # Only directions matter: scaled down, no sum overflows.
            x = x[:, :TURNED] / max(1.0, float(np.abs(x).max(initial=0)))
            if x.shape[1] > len(total):
                total = np.pad(total, (0, x.shape[1] - len(total)))
            total[: x.shape[1], : x.shape[1]] += x.T @ x
        i, j = np.triu_indices(len(total))
        yield pa.record_batch({"i": pa.array(np.append(i, -1).astype(np.int32)), "j": pa.array(np.append(j, width).astype(np.int32)), "v": pa.array(np.append(total[i, j], 0.0))})

    sums = rows.select("embedding").mapInArrow(run, "i int, j int, v double")
    sums = sums.groupBy("i", F.when(F.col("i") >= 0, F.col("j")).alias("j")).agg(F.sum("v").alias("v"), F.max("j").alias("width")).toPandas()
    if not len(sums):
        return np.eye(0)
    width = int(sums["width"][sums["i"] < 0].max())
    turned, full = min(width, TURNED), sums[sums["i"] >= 0]
    moments = np.zeros((turned, turned))
    moments[full["i"].astype(int), full["j"].astype(int)] = full["v"]
    out = np.eye(width)
    if turned:
        values, vectors = np.linalg.eigh(moments + np.triu(moments, 1).T)
        out[:turned, :turned] = vectors[:, ::-1]
    return out


@dataclass
class Vectors:
    """Some vectors: whole numbers, turned, and norms of what follows each step."""

    whole: np.ndarray
    turned: np.ndarray
    rest: list[np.ndarray]
    norm: np.ndarray


def steps_of(width: int) -> list[int]:
    return sorted({max(1, int(width * s)) for s in STEPS} | {width}) if width else [0]


def vectors_of(whole: np.ndarray, turn: np.ndarray) -> Vectors:
    turned = whole @ turn
    size = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x))
    return Vectors(whole, turned, [size(turned[:, k:]) for k in steps_of(len(turn))], size(whole))


def integer_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs of rows of a and b."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < 2.0**62:
        return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    exact = [sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for u, v in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array([min(max(x, LEAST), MOST) for x in exact], np.int64)


@dataclass
class Answers:
    """The best TOP of each want so far, in order of score, id (none last) and row."""

    want: np.ndarray
    row: np.ndarray
    id: np.ndarray  # MOST and none: a row without id
    none: np.ndarray
    score: np.ndarray

    @staticmethod
    def empty() -> Answers:
        none = np.zeros(0, np.int64)
        return Answers(none, none, none, np.zeros(0, bool), none)

    def plus(self, want: np.ndarray, row: np.ndarray, id_: np.ndarray, none: np.ndarray, score: np.ndarray) -> Answers:
        parts = [np.concatenate(x) for x in zip((self.want, self.row, self.id, self.none, self.score), (want, row, id_, none, score), strict=True)]
        want, row, id_, none, score = parts
        order = np.lexsort((row, id_, none, ~score, want))
        first = np.searchsorted(want[order], want[order])
        return Answers(*(x[order[np.arange(len(order)) - first < TOP]] for x in parts))

    def floors(self, count: int) -> np.ndarray:
        """The score of each want's last answer, where it has TOP."""
        out = np.full(count, LEAST)
        n = np.bincount(self.want, minlength=count)
        ends = np.cumsum(n) - 1
        out[n == TOP] = self.score[ends[n == TOP]]
        return out


@dataclass
class Anchors:
    """A file of anchors with their wants; wants of an anchor stand together."""

    row: np.ndarray
    label: np.ndarray
    vectors: Vectors
    begin: np.ndarray  # of each anchor's wants
    want: np.ndarray  # their numbers
    place: np.ndarray
    low: np.ndarray
    high: np.ndarray


@dataclass
class Block:
    row: np.ndarray
    id: np.ndarray
    none: np.ndarray
    label: np.ndarray
    vectors: Vectors


def block_of(row: np.ndarray, id_: np.ndarray, none: np.ndarray, label: np.ndarray, whole: np.ndarray, turn: np.ndarray) -> Block:
    """Rows without those that TOP + 1 rows of the same vector and label come before."""
    if whole.shape[1]:
        marked = np.ascontiguousarray(np.column_stack([whole + 0.0, label.astype(np.float64)]))
        _, kind = np.unique(marked.view(np.dtype((np.void, marked.dtype.itemsize * marked.shape[1]))).ravel(), return_inverse=True)
    else:
        _, kind = np.unique(label, return_inverse=True)
    order = np.lexsort((row, id_, none, kind))
    first = np.searchsorted(kind[order], kind[order])
    keep = np.sort(order[np.arange(len(order)) - first <= TOP])
    return Block(row[keep], id_[keep], none[keep], label[keep], vectors_of(whole[keep], turn))


def search(block: Block, anchors: Anchors, same: bool) -> Answers:
    """The first TOP rows of the block for each want, among rows of the anchor's label, or of others."""
    a, b = anchors.vectors, block.vectors
    steps = steps_of(a.turned.shape[1])
    found, wants = Answers.empty(), len(anchors.want)
    # The anchors' own range: least low and greatest high of their wants.
    reach = np.append(anchors.begin, wants)
    if not wants or not len(block.row):
        return found
    rows_at_once = max(1, min(len(block.row), 4096))
    anchors_at_once = max(1, TILE // rows_at_once)
    slack = EPSILON * max(1, a.turned.shape[1])
    low = anchors.low.copy()
    for j in range(0, len(block.row), rows_at_once):
        y = slice(j, j + rows_at_once)
        low = np.maximum(low, found.floors(wants))
        floor, ceiling = limits(np.minimum.reduceat(low, anchors.begin), np.maximum.reduceat(anchors.high, anchors.begin))
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(0, len(anchors.row), anchors_at_once):
            x = slice(i, i + anchors_at_once)
            part = a.turned[x, : steps[0]] @ b.turned[y, : steps[0]].T
            spare = a.rest[0][x, None] * b.rest[0][None, y] + slack * a.norm[x, None] * b.norm[None, y]
            near = (part + spare >= floor[x, None]) & (part - spare <= ceiling[x, None])
            near &= (anchors.label[x, None] == block.label[None, y]) == same
            p, q = np.nonzero(near)
            hits.extend(survivors(a, b, p + i, q + j, part[p, q], floor, ceiling, steps, slack))
        for p, q in hits:
            score = integer_scores(a.whole[p], b.whole[q])
            other = anchors.row[p] != block.row[q]
            p, q, score = p[other], q[other], score[other]
            # A pair answers those of its anchor's wants whose range it is in.
            n = np.diff(reach)[p]
            pair = np.repeat(np.arange(len(p)), n)
            want = np.repeat(anchors.begin[p], n) + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            fits = (score[pair] >= low[want]) & (score[pair] <= anchors.high[want])
            pair, want = pair[fits], want[fits]
            at = q[pair]
            found = found.plus(want, block.row[at], block.id[at], block.none[at], score[pair])
    return found


def limits(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles, with room for their rounding; the ends of the longs are no limits, since scores beyond them stop there."""
    down, up = low.astype(np.float64), high.astype(np.float64)
    return np.where(low == LEAST, -np.inf, down - np.abs(down) * 2.0**-50), np.where(high == MOST, np.inf, up + np.abs(up) * 2.0**-50)


def survivors(a: Vectors, b: Vectors, p: np.ndarray, q: np.ndarray, part: np.ndarray, floor: np.ndarray, ceiling: np.ndarray, steps: list[int], slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs that the bounds after each further step leave, some at a time."""
    at_once = max(1, PAIRS // max(1, steps[-1]))
    for k in range(0, len(p), at_once):
        u, v, sums = p[k : k + at_once], q[k : k + at_once], part[k : k + at_once]
        for n, (before, now) in enumerate(zip(steps, steps[1:], strict=False), 1):
            sums = sums + np.einsum("ij,ij->i", a.turned[u, before:now], b.turned[v, before:now])
            spare = a.rest[n][u] * b.rest[n][v] + slack * a.norm[u] * b.norm[v]
            stay = (sums + spare >= floor[u]) & (sums - spare <= ceiling[u])
            u, v, sums = u[stay], v[stay], sums[stay]
        if len(u):
            yield u, v


def anchor_files(spark: SparkSession, wants: DataFrame, turn: np.ndarray) -> list[str]:
    """Files of the anchors of wants: row, label, embedding, and wants (want, place, low, high). Written by the tasks that read them."""
    folder, width = new_folder(spark, "anchors"), len(turn)
    at_once = max(1, ANCHOR_ELEMENTS // max(1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get(), 0
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, at_once):
                batch = whole_batch.slice(k, at_once)
                lists = batch.column("wants")
                flat = lists.flatten()
                count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                columns = {c: batch.column(c).to_numpy() for c in ("row", "label")} | {c: flat.field(c).to_numpy() for c in ("want", "place", "low", "high")}
                out = io.BytesIO()
                np.savez(out, whole=whole_numbers(batch.column("embedding"), width), begin=np.cumsum(count) - count, **columns)
                path = f"{folder}/anchors-{task.partitionId():06d}-{made:06d}"
                write_file(path, out.getvalue(), str(task.taskAttemptId()))
                made += 1
                yield pa.record_batch({"path": pa.array([path])})

    return sorted(r["path"] for r in wants.mapInArrow(run, "path string").collect())


@lru_cache(maxsize=1)
def anchors_at(path: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(read_file(path))) as f:
        return dict(f)


def answer(spark: SparkSession, rows: DataFrame, wants: DataFrame, turn: np.ndarray, same: bool) -> DataFrame:
    """FOUND of each block for each want of the anchors."""
    paths = anchor_files(spark, wants, turn)
    sent, width = spark.sparkContext.broadcast(turn), len(turn)
    limit = max(1, ELEMENTS // max(1, width))

    def found_in(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.Table.from_batches(batches)
        ids = own.column("vec_id")
        block = block_of(
            own.column("row").to_numpy(), pc.fill_null(ids, int(MOST)).to_numpy(), pc.is_null(ids).to_numpy(), own.column("label").to_numpy(),
            np.concatenate([whole_numbers(b.column("embedding"), width) for b in batches]), sent.value,
        )
        for path in paths:
            f = anchors_at(path)
            anchors = Anchors(f["row"], f["label"], vectors_of(f["whole"], sent.value), f["begin"], f["want"], f["place"], f["low"], f["high"])
            got = search(block, anchors, same)
            yield pa.record_batch({
                "want": pa.array(anchors.want[got.want]), "place": pa.array(anchors.place[got.want].astype(np.int32)), "row": pa.array(got.row),
                "vec_id": pa.array(got.id, mask=got.none), "score": pa.array(got.score),
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, limit):
                batch = whole_batch.slice(k, limit)
                if size + batch.num_rows > limit:
                    yield from found_in(held)
                    held, size = [], 0
                held.append(batch)
                size += batch.num_rows
        if held:
            yield from found_in(held)

    return rows.mapInArrow(run, FOUND)


def first_of(found: DataFrame) -> DataFrame:
    """FOUND with rank: the first TOP of each want over all blocks."""
    order = Window.partitionBy("want", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def hard_negatives(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive.

    Two searches over the stored rows; only answers are shuffled, at most TOP a want and block.
    """
    rows = materialize(spark, usable(vectors), "vectors")
    turn = axes(rows)
    anchors = rows.where(F.col("vec_id") % ANCHORS == 0)
    want = lambda place, low, high: F.struct(F.col("row").alias("want"), place.cast("int").alias("place"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    everything = anchors.select("row", "label", "embedding", F.array(want(F.lit(0), F.lit(int(LEAST)), F.lit(int(MOST)))).alias("wants"))
    positives = materialize(spark, first_of(answer(spark, rows, everything, turn, True)).select("want", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "positives")
    # Positives of one score want the same: the place of a want is the least rank that has its score. A score below zero has an empty range.
    scores = positives.where("positive_score >= 0").groupBy(F.col("want").alias("row"), "positive_score").agg(F.min("rank").alias("place"))
    # ceil(4/5 of the score), without overflow
    low = F.col("positive_score") - F.expr("positive_score div 5")
    ranges = scores.groupBy("row").agg(F.sort_array(F.collect_list(want(F.col("place"), low, F.col("positive_score")))).alias("wants"))
    negatives = first_of(answer(spark, rows, anchors.select("row", "label", "embedding").join(ranges, "row"), turn, False))
    negatives = negatives.select("want", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    least = Window.partitionBy("want", "positive_score")
    asked = positives.select("want", "positive_id", "positive_score", F.min("rank").over(least).alias("place"))
    named = asked.join(anchors.select(F.col("row").alias("want"), F.col("vec_id").alias("anchor_id")), "want")
    return named.join(negatives, ["want", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
