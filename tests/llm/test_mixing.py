"""The mix against targets, quotas and blocks done by hand, with blocks small enough for many shards."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewake.llm import mixing

from .test_operators import awkward, docs, empty  # noqa: F401  fixtures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes):
    """Give each open source its share by weight; who is above twice its size stops there, and all is shared anew."""
    weights, stopped = [Fraction((5, 2, 1)[k % 3]) for k in range(len(sizes))], set()
    while True:
        left = Fraction(3, 2) * sum(sizes) - 2 * sum(sizes[k] for k in stopped)
        open_ = [k for k in range(len(sizes)) if k not in stopped and sizes[k]]
        share = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        over = {k for k in open_ if share[k] > 2 * sizes[k]}
        if not over:
            return [2 * n if k in stopped else share.get(k, Fraction(0)) for k, n in enumerate(sizes)]
        stopped |= over


@pytest.mark.parametrize("sizes", [[100, 1000, 10, 0, 400], [], [0, 0], [1, 1, 1], [5, 10**12, 3, 8, 8, 8], [7]])
def test_targets(sizes):
    assert mixing.targets(sizes) == pytest.approx([float(t) for t in targets_by_hand(sizes)])


@pytest.mark.parametrize("n", [1, 2, 3, 9, 100, 1025])
def test_blocks_are_permuted(n):
    d = mixing.Draws(n * 10, 0.0, 10, 3)
    for pass_ in range(2):
        assert sorted(d.places(pass_, np.arange(n)).tolist()) == list(range(n))


@pytest.mark.parametrize("size", [1, 9, 10, 11, 95, 100, 101, 1234])
def test_quota_ends_on_the_target(size):
    for target in range(2 * size + 1):
        d = mixing.Draws(size, float(target), 10, 1)
        d.ends = np.array([d.quota])
        doc, _, first, words = d.pieces(np.array([0]), np.array([size]))
        assert words.sum() == target and (words > 0).all() and len(doc) == d.quota
        times = Counter(w for a, n in zip(first.tolist(), words.tolist(), strict=True) for w in range(a, a + n))
        assert all(target // size <= times[w] <= -(-target // size) for w in range(size))


def test_splitting_tree():
    quotas = np.array([5, 0, 17, 200, 1])
    out = mixing.split_quotas(quotas, 7)
    assert (out.sum(0) == quotas).all() and (out >= 0).all() and np.ptp(out.sum(1)) <= 3
    assert (out == mixing.split_quotas(quotas, 7)).all()
    # The mean of a shard's quota is its share of the slots.
    many = np.array([mixing.split_quotas(np.array([40, 120]), 4, seed)[:, 0] for seed in range(400)])
    assert np.abs(many.mean(0) - 10).max() < 0.6 and many.std() > 1


@pytest.fixture(params=["small", "awkward"])
def table(request, spark, sf_dir, docs):  # noqa: F811
    return spark.read.parquet(f"{sf_dir}/documents.parquet") if request.param == "small" else docs


def test_mix(spark, table, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 40)
    got = mixing.mix(spark, table).collect()
    texts = table.select("doc_id", "source", "text").collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in texts)
    assert Counter(map(str, got)) == Counter(map(str, mixing.mix(spark, table).collect()))
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken == sum(p.words for p in r.pieces) <= 2 * r["size"]
        assert all(p.first >= 0 and p.words > 0 and p.first + p.words <= r["size"] for p in r.pieces)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    wanted = targets_by_hand(sizes)
    words, shards = Counter(), Counter()
    for s, n, t in zip(order, sizes, wanted, strict=True):
        assert by[s][0].target == pytest.approx(float(t)) and by[s][0].source_size == n
        assert abs(sum(r.taken for r in by[s]) - t) <= 1
        for r in by[s]:
            for p in r.pieces:
                words[s, p.shard] += p.words
                shards[p.shard] += 1
    assert len(shards) >= 16
    # Each shard has its quota of each source, in blocks; the last block and the last draw of a source are short.
    draws = [mixing.Draws(n, float(t), 64, k) for k, (n, t) in enumerate(zip(sizes, wanted, strict=True))]
    quotas = mixing.split_quotas(np.array([d.quota for d in draws]), len(shards))
    short = {s: sum(max(0, 64 * int(q) - words[s, k]) > 0 for k, q in enumerate(quotas[:, i])) for i, s in enumerate(order)}
    assert all(words[s, k] <= 64 * q for i, s in enumerate(order) for k, q in enumerate(quotas[:, i]))
    assert max(short.values()) <= 3
    rows = mixing.mixed_rows(spark, table)
    assert rows.columns == table.columns and rows.rdd.getNumPartitions() == len(shards)
    taken = [(r.doc_id, p.first, p.words) for r in got for p in r.pieces]
    assert Counter((r.doc_id, len(WORD.findall(r.text))) for r in rows.collect()) == Counter((i, n) for i, _, n in taken)
    parts = {r.doc_id: r.text for r in texts}
    assert all(r.text in (parts[r.doc_id] or "") for r in rows.collect() if r.doc_id is not None and r.doc_id != 5)


def test_hot_source_and_long_document(spark):
    rows = [(k, "w " * (40 + k % 7), "big" if k % 3 else f"s{k % 10}") for k in range(600)] + [(1000, "w " * 300_000, "big")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(spark, table).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 1 for r in got)


def test_blocks_grow_only_beyond_the_bound(spark, monkeypatch):
    sizes = spark.createDataFrame([("a", 10_000, 1), ("b", 5_000, 2)], "source string, size long, h long")
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 1)
    for bits, block in ((20, 1), (10, 22500 >> 10)):
        monkeypatch.setattr(mixing, "MAX_BLOCKS", bits)
        plan = mixing.plan_sources(sizes)
        assert {d.block for d in plan.sources.values()} == {block}
        assert sum(d.quota for d in plan.sources.values()) <= (2 << bits) + 2
