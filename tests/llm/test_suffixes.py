"""Suffix arrays and longest matches against brute force."""

import random

import numpy as np
import pytest

from tidewake.llm import decontamination
from tidewake.llm.suffixes import SuffixArray

from .test_operators import ALNUM, awkward, docs, empty, lower  # noqa: F401  fixtures


@pytest.mark.parametrize("seed", range(8))
def test_order_and_search(seed):
    rng = random.Random(seed)
    texts = [[rng.randrange(1 + seed) + 1 for _ in range(rng.choice([1, 2, 5, 40]))] for _ in range(12)]
    texts += texts[:3]
    words = np.array([w for t in texts for w in t], np.uint64) * np.uint64(0x123456789ABCDEF)
    own = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    array = SuffixArray(words, own)
    suffix = [words[k : array.end[k]].tolist() for k in range(len(words))]
    rank = {w: k for k, w in enumerate(sorted(set(words.tolist())))}
    order = [[rank[w] for w in suffix[k]] for k in array.order.tolist()]
    assert order == sorted(order) and sorted(array.order.tolist()) == list(range(len(words)))
    for length in (1, 2, 3, 9, 30):
        start = np.flatnonzero(array.end - np.arange(len(words)) >= length)
        low, high = array.find(array.ids, start, np.full(len(start), length))
        for k, a, b in zip(start.tolist(), low.tolist(), high.tolist(), strict=True):
            want = {j for j in range(len(words)) if suffix[j][:length] == suffix[k][:length]}
            assert set(array.order[a:b].tolist()) == want
    other = np.array([rng.randrange(2 + seed) + 1 for _ in range(60)], np.uint64) * np.uint64(0x123456789ABCDEF)
    length, low, high = array.longest(array.numbers(other), np.arange(60), np.full(60, 60))
    for k in range(60):
        common = [next((d for d, (x, y) in enumerate(zip(other[k:].tolist(), s, strict=False)) if x != y), min(60 - k, len(s))) for s in suffix]
        assert length[k] == max(common)
        if length[k]:
            assert set(array.order[low[k] : high[k]].tolist()) == {j for j, c in enumerate(common) if c == max(common)}


def longest_by_hand(text, items):
    """(words, document's word, item, item's word): the longest match from where a window occurs, the first of equals."""
    w = ALNUM.findall(lower(text))
    begins = set()
    for _, t in items:
        v = ALNUM.findall(lower(t))
        for k in range(max(len(v) - 9, min(len(v), 1))):
            begins |= {p for p in range(len(w)) if w[p : p + len(v[k : k + 10])] == v[k : k + 10]}
    best = (0, 0, True, "", 0)
    for p in begins:
        for name, t in items:
            v = ALNUM.findall(lower(t))
            for k in range(len(v)):
                n = next((d for d, (x, y) in enumerate(zip(w[p:], v[k:], strict=False)) if x != y), min(len(w) - p, len(v) - k))
                best = min(best, (-n, p, name is None, name or "", k))
    return (0, None, None, None) if not best[0] else (-best[0], best[1], None if best[2] else best[3], best[4])


@pytest.mark.parametrize("block", [500_000, 30])
def test_longest_match(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    rng = random.Random(block)
    items = [("a", " ".join(f"w{k}" for k in range(30))), ("b", "x y z"), (None, "n o"), ("c", " ".join(f"w{k % 4}" for k in range(25))), ("d", " ".join(f"w{k}" for k in range(5, 22))), ("e", None), ("f", "...")]
    texts = [None, "", "n o", "q " + items[0][1] + " x y z n o", "W3 w4 " + items[4][1] + " w22", "w0 w1 w2 w3 " * 12, "x y", " ".join(f"w{k}" for k in range(3, 14)) + " # " + " ".join(f"w{k}" for k in range(9, 30))]
    texts += [" ".join(f"w{rng.randrange(4)}" for _ in range(3000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    test = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: (r.longest_match, r.match_word, r.match_item, r.match_item_word) for r in decontamination.contamination(spark, rows, test).collect()}
    assert got == {k: longest_by_hand(t, items) for k, t in enumerate(texts)}


def test_longest_match_on_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    test = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(str(r.item_id), r.text) for r in test.collect()]
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = [r for r in decontamination.contamination(spark, rows, test).collect() if r.contaminated]
    assert got
    for r in got[:12]:
        assert (r.longest_match, r.match_word, r.match_item, r.match_item_word) == longest_by_hand(texts[r.doc_id], items)
