"""The near-dedup stage by groups: ids that are null or repeat on unlike texts."""

import random
from collections import Counter

import corpus_pipeline

from .test_operators import fingerprint, linked_by_hand


def test_one_row_of_each_group(spark, sf_dir):
    rng = random.Random(3)
    a, b, c, d, e, f, g = (" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(7))
    rows = [(None, a), (None, b), (None, c), (5, c), (7, d), (7, e), (3, e), (5, f), (None, a), (9, g), (9, g), (None, None), (11, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, mark int").repartition(3)
    group = linked_by_hand([fingerprint(t) for _, t in rows], list(range(len(rows))))
    least = {}
    for (i, _), x in zip(rows, group, strict=True):
        least[x] = min(least.get(x, (True, 0)), (i is None, i or 0))
    kept = corpus_pipeline.near_dedup_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert all((r.doc_id, r.text) == rows[r.mark] for r in got)
    assert Counter(group[r.mark] for r in got) == Counter(set(group))
    assert all((r.doc_id is None, r.doc_id or 0) == least[group[r.mark]] for r in got)
