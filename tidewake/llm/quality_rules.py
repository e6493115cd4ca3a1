"""Quality rules: a linear-chain conditional random field over the lines of a text.

Each non-blank line is labelled content or boilerplate by Viterbi decoding, and
the share of a document's words that stand in content lines decides whether it
stays. Two counting rules come first: documents of under MIN_WORDS words, or
with over MAX_REPEAT of their words inside repeated WINDOW-word windows, fail.

The field is p(y | x) ~ exp(sum_t s_t (w.x_t + b) / 2 + tau / 2 sum_t s_t s_t+1)
with s = +1 for content, -1 for boilerplate. It is fitted by pseudo-likelihood:
each label given its line and its two neighbours, which is a logistic regression
solved by Newton steps. `labels` has no line labels, so lines of good documents
count as content, and lines of bad documents as what a first fit on lines alone
says of them (the worst line always as boilerplate).

Defined results: a null text counts as empty; an empty text has no words and
fails the rules; texts of any length are judged whole; repeated rows are judged alike,
each on its own, whatever their ids, null or not; an empty table
gives an empty table; without usable labels every line is content. Other columns
never matter and pass through `keep_good` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches
from .text import NON_SPACE, Texts, byte_set, grams, mix, slices

MIN_WORDS = 20
WINDOW = 8
#: Percent of words in repeated windows above which a document fails.
MAX_REPEAT = 30
#: Least share of words in content lines.
MIN_CONTENT = 0.5
#: Bounds of the training sample: documents of each label, and characters of one.
SAMPLE_DOCS, SAMPLE_CHARS = 1200, 20_000

SYMBOL = byte_set(*((ord(c), ord(c)) for c in "#*$%&|<>"))
UPPER, DIGIT = byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))
NOISE = byte_set((0x21, 0x21), (0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
STOP = byte_set(*((ord(c), ord(c)) for c in ".!?:;"))
N_FEATURES = 10

BASE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, content_share double"


@dataclass
class Field:
    weights: np.ndarray
    bias: float
    coupling: float
    mean: np.ndarray
    scale: np.ndarray


ALL_CONTENT = Field(np.zeros(N_FEATURES), 1.0, 0.0, np.zeros(N_FEATURES), np.ones(N_FEATURES))


@dataclass
class Measured:
    """Counts per document, and its non-blank lines one after another."""

    counts: dict[str, np.ndarray]
    first_line: np.ndarray  # of each document, and the number of lines at last
    line_words: np.ndarray
    features: np.ndarray


def measure(column: pa.Array) -> Measured:
    texts = Texts(column)
    data, n = texts.data, texts.n
    inside = NON_SPACE[data] if len(data) else np.zeros(0, bool)
    starts, ends, doc = texts.runs(inside)
    words = np.bincount(doc, minlength=n).astype(np.int64)
    hashes = texts.hashes(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    counts = {
        "n_words": words,
        "word_chars": texts.per_document(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": texts.per_document(SYMBOL[data] if len(data) else inside),
    }
    covered = repeated_words(hashes, doc)
    counts["n_repeat_words"] = np.bincount(doc, covered, n).astype(np.int64)

    # Lines: the spans between newlines and document bounds that hold a word.
    line_starts, line_ends, line_doc = texts.runs(data != 0x0A)
    total = np.zeros(len(data) + 1, np.int64)
    total[starts + 1] = 1
    total = np.cumsum(total)
    held = total[line_ends] - total[line_starts]
    full = held > 0
    line_starts, line_ends, line_doc, held = line_starts[full], line_ends[full], line_doc[full], held[full]
    keys = mix(texts.hashes(line_starts, line_ends) ^ mix(line_doc.astype(np.uint64) + np.uint64(1))) if len(line_starts) else np.zeros(0, np.uint64)
    earlier = equal_to_earlier(keys)
    counts["n_dup_lines"] = np.bincount(line_doc, earlier, n).astype(np.int64)

    size = np.maximum(line_ends - line_starts, 1)

    def share(table: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=seen[1:])
        return (seen[line_ends] - seen[line_starts]) / size

    first = total[line_starts]
    cover = np.concatenate([[0], np.cumsum(covered)])
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 1:
        same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    last = np.zeros(0, np.uint8)
    if len(line_starts):
        word_last = ends[first + held - 1] - 1
        last = data[word_last]
    features = np.stack([
        np.log1p(size),
        np.log1p(held),
        (size / np.maximum(held, 1)).clip(0, 60) / 10,
        share(NOISE).clip(0, 0.5) * 4,
        share(SYMBOL).clip(0, 0.5) * 4,
        share(UPPER),
        share(DIGIT),
        STOP[last].astype(float) if len(last) else np.zeros(0),
        (cover[first + held] - cover[first]) / np.maximum(held, 1),
        (same[first + held] - same[np.minimum(first + 1, len(hashes))]) / np.maximum(held, 1),
    ], axis=1) if len(line_starts) else np.zeros((0, N_FEATURES))
    first_line = np.concatenate([[0], np.cumsum(np.bincount(line_doc, minlength=n))]).astype(np.int64)
    return Measured(counts, first_line, held, features)


def repeated_words(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words stand in a WINDOW-word window that occurs twice or more in its document."""
    out = np.zeros(len(hashes), bool)
    if len(hashes) < WINDOW:
        return out
    keys = grams(hashes, WINDOW)
    whole = doc[: len(keys)] == doc[WINDOW - 1 :]
    at = np.flatnonzero(whole)
    keys = mix(keys[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    begin = at[twice]
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def equal_to_earlier(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), bool)
    order = np.argsort(keys, kind="stable")
    out[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last column of x is not penalised."""
    theta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ theta).clip(-30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * theta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        theta += step.clip(-2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return theta


def fit(measured: list[Measured], good: list[np.ndarray]) -> Field:
    """measured, good: batches of documents and whether each is good."""
    x = np.concatenate([m.features for m in measured]) if measured else np.zeros((0, N_FEATURES))
    lines = np.concatenate([np.diff(m.first_line) for m in measured]) if measured else np.zeros(0, int)
    label = np.concatenate(good) if good else np.zeros(0, bool)
    if not len(x) or label.all() or not label.any():
        return ALL_CONTENT
    doc = np.repeat(np.arange(len(lines)), lines)
    y = label[doc].astype(float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    one = np.ones((len(z), 1))
    weight = np.where(y > 0, 1.0, max(1.0, y.sum() / max(1.0, (1 - y).sum())))
    alone = logistic(np.hstack([z, one]), y, weight)
    p = np.hstack([z, one]) @ alone
    bad = ~label[doc]
    y = np.where(bad & (p < 0), 0.0, 1.0)
    begin = np.concatenate([[0], np.cumsum(lines)])
    for d in np.flatnonzero(~label & (lines > 0)):
        y[begin[d] + np.argmin(p[begin[d] : begin[d + 1]])] = 0.0
    s = 2 * y - 1
    near = np.zeros(len(s))
    joined = doc[1:] == doc[:-1]
    near[1:] += s[:-1] * joined
    near[:-1] += s[1:] * joined
    theta = logistic(np.hstack([z, near[:, None], one]), y, np.ones(len(y)))
    return Field(theta[:-2], float(theta[-1]), float(theta[-2]), mean, scale)


def viterbi(field: Field, first_line: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The most probable labels (content: True); all documents advance together, a line at a time."""
    unary = ((features - field.mean) / field.scale) @ field.weights + field.bias
    lines = np.diff(first_line)
    content = np.zeros(len(unary), bool)
    order = np.argsort(-lines, kind="stable")
    begin, lines = first_line[:-1][order], lines[order]
    alive = int((lines > 0).sum())
    if not alive:
        return content
    half = field.coupling / 2
    best = np.stack([-unary[begin[:alive]] / 2, unary[begin[:alive]] / 2])
    came = np.zeros((2, len(unary)), bool)  # came[y, t]: whether the line before is content, given y at t
    for t in range(1, int(lines[0])):
        alive = int(np.searchsorted(-lines, -t, "left"))
        at = begin[:alive] + t
        low, high = best[0, :alive].copy(), best[1, :alive].copy()
        came[0, at] = high - half > low + half
        came[1, at] = high + half >= low - half
        best[0, :alive] = np.maximum(high - half, low + half) - unary[at] / 2
        best[1, :alive] = np.maximum(high + half, low - half) + unary[at] / 2
    alive = int((lines > 0).sum())
    state = best[1, :alive] >= best[0, :alive]
    content[begin[:alive] + lines[:alive] - 1] = state
    current = state.astype(np.int64)
    for back in range(1, int(lines[0])):
        alive = int(np.searchsorted(-lines, -back, "left"))
        at = begin[:alive] + lines[:alive] - back
        current[:alive] = came[current[:alive], at]
        content[at - 1] = current[:alive].astype(bool)
    return content


def judge(field: Field, column: pa.Array) -> dict[str, np.ndarray]:
    m = measure(column)
    c = m.counts
    content = viterbi(field, m.first_line, m.features)
    seen = np.concatenate([[0], np.cumsum(np.where(content, m.line_words, 0))])
    in_content = seen[m.first_line[1:]] - seen[m.first_line[:-1]]
    c["base_failed"] = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT * c["n_words"])
    c["content_share"] = in_content / np.maximum(c["n_words"], 1)
    c["kept"] = ~c["base_failed"] & (c["content_share"] >= MIN_CONTENT)
    c["n_lines"] = np.diff(m.first_line)
    return c


def sample_labelled(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> DataFrame:
    """text and label of at most per_class labelled documents of each value, those of the smallest hash.

    The ids are chosen from `labels` alone: their number is bounded by the
    parameter, so that side of the join is broadcast.
    """
    ids = None
    for value in (0, 1):
        part = labels.where(F.col(label) == value).select("doc_id", F.lit(value).alias("_y")).distinct()
        part = part.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    fit_on = docs.select(F.col("doc_id"), F.col("text")).where(F.length("text").between(1, max_chars))
    return fit_on.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "_y")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Field:
    """Fit on the measured lines of the sample; only numbers come to the driver, of SAMPLE_DOCS documents a label."""
    small_batches(spark)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                m = measure(part.column("text"))
                rows = [m.features[a:b].astype(np.float64).tobytes() for a, b in zip(m.first_line[:-1], m.first_line[1:], strict=True)]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "good": part.column("_y"), "features": pa.array(rows, pa.binary())})

    sample = sample_labelled(spark, docs, labels, "quality", SAMPLE_DOCS, SAMPLE_CHARS)
    got = sample.select("doc_id", "text", F.col("_y").cast("int")).mapInArrow(features, "doc_id long, good int, features binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.good, r.features))
    x = [np.frombuffer(r.features).reshape(-1, N_FEATURES) for r in got]
    lines = np.concatenate([[0], np.cumsum([len(v) for v in x])]).astype(np.int64)
    every = Measured({}, lines, np.zeros(0), np.concatenate(x) if x else np.zeros((0, N_FEATURES)))
    return fit([every], [np.array([r.good == 1 for r in got], bool)])


def score(spark: SparkSession, docs: DataFrame, field: Field) -> DataFrame:
    """doc_id and BASE_SCHEMA for each row of docs."""
    small_batches(spark)
    names = [x.split()[0] for x in BASE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = judge(field, part.column("text"))
                yield pa.record_batch([part.column("doc_id"), *(pa.array(got[k]) for k in names)], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {BASE_SCHEMA}")


def keep_good(spark: SparkSession, docs: DataFrame, field: Field) -> DataFrame:
    """The rows of docs that stay, all columns as they are; no shuffle."""
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(judge(field, part.column("text"))["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(spark, docs, train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
