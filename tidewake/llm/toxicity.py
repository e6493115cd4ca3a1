"""Toxicity by maximum-scoring segments of token log-odds.

Fit. In how many training texts of each label a token stands gives its log-odds
with an informative Dirichlet prior (LEAST for each token and PRIOR more by the pooled shares); the
score is its lower confidence bound, at FLOOR at least, so rare tokens and tokens
not seen count against toxicity. Exact copies among the training texts count once.

Search. In each text all maximal scoring segments are found by the linear-time
scan over runs of positive tokens (Ruzzo and Tompa). Calibration is by extreme-value theory:
under the clean texts' token law, a text of n tokens holds about
K n exp(-lambda S) segments of score S or more; lambda solves E exp(lambda s) = 1, K is the
maximum-likelihood value over clean training texts. Segments with an expectation under
SIGNIFICANT are reported. A text's evidence, of its best segment and of all its
positive ones together, becomes a probability by a logistic fit on the training texts.

Rows whose crc32(doc_id as text) mod 4 is HELD_OUT give no labels. doc_id,
source and lang are no inputs. The training sample has SAMPLE_DOCS texts a label at
most, of SAMPLE_CHARS characters at most, those of the least hashes.

Defined results: null and empty texts have no tokens and get the score of a text
without positive tokens; texts of any length are scored whole; repeated rows are scored
alike; a null doc_id is not held out; an empty table gives an empty table; with no usable labels of both kinds every score is 0. Other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality_rules import logistic, sample_labelled
from .shared import small_batches
from .text import ALNUM, Texts, slices

FOLDS, HELD_OUT = 4, 2
SAMPLE_DOCS, SAMPLE_CHARS = 3000, 20_000
LEAST, PRIOR = 0.5, 500.0
#: Standard errors below the estimate, least token score, and what each token's score is lowered by.
CAUTION, FLOOR, DRIFT = 2.5, -1.0, 0.1
LEAST_TEXTS = 3
SIGNIFICANT = 0.01
THRESHOLD = 0.3

RESULT = "doc_id long, held_out boolean, score double, predicted int, n_segments long, evidence double, segments string"


@dataclass
class Model:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    rate: float  # lambda
    k: float
    weights: np.ndarray  # of best evidence, total evidence, 1; empty: no model


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]:
    texts = Texts(column, lower=True)
    starts, ends, doc = texts.runs(ALNUM[texts.data])
    hashes = texts.hashes(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return hashes, doc, texts.n, starts - texts.bounds[doc], ends - texts.bounds[doc]


def scored(model: Model, hashes: np.ndarray) -> np.ndarray:
    if not len(model.tokens) or not len(hashes):
        return np.full(len(hashes), FLOOR - DRIFT)
    at = np.minimum(np.searchsorted(model.tokens, hashes), len(model.tokens) - 1)
    return np.where(model.tokens[at] == hashes, model.scores[at], FLOOR) - DRIFT


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in one pass over its runs of positive scores."""
    positive = s > 0
    if not positive.any():
        return []
    edge = np.diff(np.concatenate([[0], positive.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    total = np.concatenate([[0.0], np.cumsum(s)])
    held: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum through, the one before with a smaller sum before
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        before, through = float(total[a]), float(total[b])
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0 or held[j][3] >= through:
                held.append((a, b, before, through, j))
                break
            a, before = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, through - before) for a, b, before, through, _ in held]


def fit_scores(texts: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """texts: the distinct token hashes of each training text."""
    seen = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    label = np.repeat(toxic, [len(t) for t in texts])
    tokens, place = np.unique(seen, return_inverse=True)
    count = np.stack([np.bincount(place[label == y], minlength=len(tokens)) for y in (0, 1)]).astype(float)
    keep = count.sum(0) >= LEAST_TEXTS
    tokens, count = tokens[keep], count[:, keep]
    if not len(tokens):
        return tokens, np.zeros(0)
    prior = LEAST + PRIOR * count.sum(0) / count.sum()
    total = count.sum(1, keepdims=True)
    with_prior = count + prior
    odds = np.log(with_prior / (total + prior.sum() - with_prior))
    error = np.sqrt((1 / with_prior).sum(0))
    return tokens, np.maximum(odds[1] - odds[0] - CAUTION * error, FLOOR)


def decay(values: np.ndarray, share: np.ndarray) -> float:
    """The positive lambda with E exp(lambda s) = 1."""
    if not (values > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    rise = lambda x: float(share @ np.exp(np.minimum(x * values, 700)))
    while rise(high) < 1 and high < 100:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if rise(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def evidence(model: Model, found: list[tuple[int, int, float]], n: int) -> tuple[float, float, list[float]]:
    """Of the best segment and of all, as -log of the expected number; and each segment's expected number."""
    expect = [model.k * max(n, 1) * float(np.exp(-model.rate * x)) for _, _, x in found]
    gains = [min(60.0, float(np.log1p(1 / max(e, 1e-30)))) for e in expect]
    return max(gains, default=0.0), float(np.log1p(sum(gains))), expect


def inputs(best: float, total: float) -> np.ndarray:
    return np.array([best / 10, total, 1.0])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """The token hashes of the bounded sample come to the driver; the model goes to the tasks."""
    small_batches(spark)
    known = labels.where(F.col("toxic").isin(0, 1)).where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    sample = sample_labelled(spark, docs, known, "toxic", SAMPLE_DOCS, SAMPLE_CHARS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, doc, n, _, _ = tokens_of(part.column("text"))
                bounds = np.searchsorted(doc, np.arange(n + 1))
                yield pa.record_batch({"toxic": part.column("_y"), "tokens": pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())})

    rows = sample.select(F.col("_y").cast("int"), "text").mapInArrow(run, "toxic int, tokens binary").collect()
    distinct = sorted({(bytes(r.tokens), r.toxic) for r in rows})
    texts = [np.frombuffer(t, np.uint64) for t, _ in distinct]
    toxic = np.array([y for _, y in distinct], np.int64)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, np.zeros(0))
    if not toxic.any() or toxic.all():
        return nothing
    model = nothing
    model.tokens, model.scores = fit_scores([np.unique(t) for t in texts], toxic)
    every = [scored(model, t) for t in texts]
    clean = np.concatenate([s for s, y in zip(every, toxic, strict=True) if not y])
    values, count = np.unique(clean, return_counts=True)
    # Positive scores that no clean text shows still have the prior's half count.
    more = np.setdiff1d(model.scores - DRIFT, values)
    more = more[more > 0]
    share = np.concatenate([count, np.full(len(more), 0.5)])
    model.rate = decay(np.concatenate([values, more]), share / share.sum())
    found = [segments(s) for s in every]
    tops = np.array([max((x for _, _, x in f), default=0.0) for f in found])
    lengths = np.array([max(len(s), 1) for s in every], float)
    quiet = toxic == 0
    model.k = float(quiet.sum() / np.sum(lengths[quiet] * np.exp(-model.rate * np.minimum(tops[quiet], 50))))
    x = np.array([inputs(*evidence(model, f, len(s))[:2]) for f, s in zip(found, every, strict=True)])
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = np.array([totals.get(int(y), 1) / max(1, int((toxic == y).sum())) for y in toxic])
    model.weights = logistic(x, toxic.astype(float), weight / weight.mean(), ridge=1e-2)
    return model


def judge(model: Model, column: pa.Array) -> tuple[list[float], list[int], list[float], list[str]]:
    hashes, doc, n, starts, ends = tokens_of(column)
    s = scored(model, hashes)
    bounds = np.searchsorted(doc, np.arange(n + 1))
    any_positive = np.zeros(n, bool)
    any_positive[doc[s > 0]] = True
    plain = float(1 / (1 + np.exp(-(inputs(0.0, 0.0) @ model.weights)))) if len(model.weights) else 0.0
    score, count, best_of, spans = [plain] * n, [0] * n, [0.0] * n, [""] * n
    for d in np.flatnonzero(any_positive).tolist():
        a, b = int(bounds[d]), int(bounds[d + 1])
        found = segments(s[a:b])
        best, total, expect = evidence(model, found, b - a)
        if len(model.weights):
            score[d] = float(1 / (1 + np.exp(-(inputs(best, total) @ model.weights))))
        real = [(x, y) for (x, y, _), e in zip(found, expect, strict=True) if e <= SIGNIFICANT]
        count[d], best_of[d] = len(real), best
        spans[d] = ",".join(f"{starts[a + x]}:{ends[a + y - 1]}" for x, y in real)
    return score, count, best_of, spans


def toxicity(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """RESULT for each row. segments: start:end in bytes of the significant passages."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score, count, best, spans = judge(sent.value, part.column("text"))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "score": pa.array(score, pa.float64()),
                    "n_segments": pa.array(count, pa.int64()),
                    "evidence": pa.array(best, pa.float64()),
                    "segments": pa.array(spans, pa.string()),
                })

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_segments long, evidence double, segments string")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "n_segments", "evidence", "segments")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity(spark, docs, train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
