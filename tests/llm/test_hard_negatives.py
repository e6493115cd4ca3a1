"""Hard negatives: brute force over awkward and skewed rows, bounds that never lose a pair."""

import math

import numpy as np
import pytest

from tidewake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, want int, row int, score string"


def brute(rows):
    """Rows (vec_id, embedding, label) by hand, from the contract."""
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    product = lambda a, b: min(max(sum(x * y for x, y in zip(a, b, strict=False)), -(2**63)), 2**63 - 1)
    out = []
    for k, (anchor, vector, label) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(((-product(vector, v), i is None, i or 0, own) for j, (i, v, own) in enumerate(usable) if j != k), key=lambda x: x[:3])
        positives = [x for x in scored if x[3] == label][:5]
        for p in positives:
            fits = [n for n in scored if n[3] != label and 80 * -p[0] <= 100 * -n[0] <= 100 * -p[0]][:5]
            out += [(anchor, None if p[1] else p[2], rank, None if n[1] else n[2], -p[0], -n[0]) for rank, n in enumerate(fits, 1)]
    return sorted(out, key=str)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 0, 0, "x") for r in rows], SCHEMA).repartition(parts)
    out = hn.hard_negatives(spark, df)
    assert out.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    return sorted((tuple(r) for r in out.collect()), key=str)


def clustered(n, dim, labels, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(labels, dim)) * 0.2 + 0.1
    label = rng.integers(0, labels, n)
    return [(i, [float(x) for x in (centers[c] + spread * 0.2 * rng.normal(size=dim)).astype(np.float32)], int(c)) for i, c in enumerate(label)]


def test_against_brute_force(spark):
    rows = clustered(900, 12, 10, 1)
    want = brute(rows)
    assert len(want) > 100
    assert got(spark, rows) == want


def test_corpus(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    out = hn.op11_hard_negatives(spark, sf_dir)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want


def test_awkward_rows(spark):
    rows = clustered(300, 6, 4, 2)
    rows += [(400, None, 1), (500, [0.5, None, 0.5, 0.1, 0.1, 0.1], 1), (600, [float("nan")] * 6, 1), (700, [float("inf")] * 6, 2), (800, [0.1] * 6, None), (900, [], 1), (1000, [0.3, 0.2], 2)]
    rows += [(None, [0.4] * 6, 1), (None, [0.4] * 6, 2), (200, rows[200][1], rows[200][2]), (100, [0.25] * 6, 3), (1100, [-1.0] * 6, 0), (1200, [0.0] * 6, 1)]
    assert got(spark, rows) == brute(rows)


def test_scores_beyond_a_long(spark):
    rows = [(k, [3e38 if k % 3 else 2e38, 1.0], k % 4) for k in range(0, 300, 25)] + [(k, [-3e38, 1.0], k % 3) for k in range(1, 20)]
    assert got(spark, rows) == brute(rows)


def test_equal_vectors_are_no_load(spark):
    rows = clustered(200, 8, 5, 3)
    rows += [(1000 + k, [0.3] * 8, 1 if k % 3 else 2) for k in range(600)]
    assert got(spark, rows) == brute(rows)
    whole = np.array([hn.SCALE * np.array(r[1]) for r in rows]).round()
    n = len(rows)
    block = hn.block_of(np.arange(n), np.arange(n), np.zeros(n, bool), np.array([r[2] for r in rows]), whole, np.eye(8))
    assert len(block.row) <= 200 + 2 * (hn.TOP + 1)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(100, [0.5], 1)]) == []


def test_several_blocks_and_files(spark, monkeypatch):
    rows = clustered(700, 8, 3, 5)
    want = brute(rows)
    turn = hn.axes(hn.usable(spark.createDataFrame([(*r, 0, 0, "x") for r in rows], SCHEMA)))
    assert np.allclose(turn @ turn.T, np.eye(8), atol=1e-12)
    whole = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(np.float64))
    label = np.array([(r[2] + (r[0] % 7 == 0)) % 10 for r in rows])
    at = np.arange(0, 700, 100)
    lo, hi = np.full(len(at), hn.LEAST), np.full(len(at), hn.MOST)
    anchors = hn.Anchors(at, label[at], hn.vectors_of(whole[at], turn), np.arange(len(at)), at, np.zeros(len(at), np.int64), lo, hi)
    found = hn.Answers.empty()
    for b in np.array_split(np.arange(700), 5):
        one = hn.search(hn.block_of(b, b, np.zeros(len(b), bool), label[b], whole[b], turn), anchors, True)
        found = found.plus(one.want, one.row, one.id, one.none, one.score)
    positives = {(w, p) for w, p, *_ in want}
    assert positives <= {(int(at[w]), int(i)) for w, i in zip(found.want, found.id, strict=True)}


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e12])
def test_bounds_lose_no_pair(scale):
    """After every step, the bounds hold the integer product."""
    rng = np.random.default_rng(9)
    whole = np.floor(scale * rng.normal(size=(60, 20)))
    turn = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    v = hn.vectors_of(whole, turn)
    exact = [[sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for b in whole] for a in whole]
    for k, n in enumerate(hn.steps_of(20)):
        part = v.turned[:, :n] @ v.turned[:, :n].T
        spare = v.rest[k][:, None] * v.rest[k] + hn.EPSILON * 20 * v.norm[:, None] * v.norm
        assert all(abs(exact[i][j] - part[i, j]) <= spare[i, j] for i in range(60) for j in range(60))
