"""What a task holds: lines of one template, rows without ids, benchmarks of many blocks, roots of large components."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewake.llm import components, decontamination, line_dedup, token_output
from tidewake.llm.token_counts import vocabulary_path


def linked(sets):
    return {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


@pytest.mark.parametrize("pairs", [1 << 6, 1 << 10, 1 << 19])
def test_candidates_of_a_template(monkeypatch, pairs):
    """Whatever is held at once, every linked pair is a candidate, as a pair or within a group."""
    monkeypatch.setattr(line_dedup, "PAIRS", pairs)
    monkeypatch.setattr(line_dedup, "HOT", 64)
    rng = random.Random(pairs)
    texts = [f"posted by member{k} in forum general chat on our site today" for k in range(150)]
    texts += [" ".join(rng.sample([f"w{i}" for i in range(30)], rng.randint(3, 12))) for _ in range(150)]
    lines = line_dedup.Lines(pa.array(["\n".join(texts)]), np.arange(1 << line_dedup.BUCKET_BITS, dtype=np.uint32) % 7)
    counts = np.zeros(1 << line_dedup.BUCKET_BITS, np.int64)
    at = line_dedup.Seen().fresh(lines)
    np.add.at(counts, line_dedup.bucket_of(line_dedup.slot_hash(line_dedup.prefix_rows(lines, at)[2])), 1)
    blocks = line_dedup.block_counts(counts)
    assert blocks.max() > 1
    rows = line_dedup.rows_of(lines, at, blocks)
    found, groups = set(), {}
    number = {int(c): k for k, c in enumerate(lines.classes[at].view(np.int64).tolist())}
    slot = line_dedup.mix(line_dedup.slot_hash(rows.token) + rows.part.astype(np.uint64)) % np.uint64(3)
    for s in range(3):
        for batch in line_dedup.slot_candidates(rows.take(np.flatnonzero(slot == np.uint64(s)))):
            for u, v, n, block in zip(*(batch.column(c).to_pylist() for c in ("u", "v", "n", "block")), strict=True):
                if n:
                    groups.setdefault((v, n), set()).add((number[u], block))
                else:
                    found.add(tuple(sorted((number[u], number[v]))))
    for members in groups.values():
        found |= {tuple(sorted((a, b))) for a, x in members for b, y in members if a < b and (x == 0 or x != y)}
    sets = [set(lines.set_of(k).tolist()) for k in at.tolist()]
    assert linked(sets) and linked(sets) <= found


def test_groups_of_any_size(monkeypatch):
    """Strips and products as narrow as it takes give the same links."""
    sets = [np.sort(np.array([*range(10), 100 + k], np.uint64)) for k in range(40)]
    table = pa.table({"class": list(range(40)), "signature": [0] * 40, "tokens": [x.tobytes() for x in sets], "doc_id": list(range(40)), "line_no": [0] * 40, "block": [0] * 40, "token": [-(1 << 63)] * 40})
    want = line_dedup.group_links(table).to_pylist()
    monkeypatch.setattr(line_dedup, "MATRIX", 100)
    assert line_dedup.group_links(table).to_pylist() == want and [r["links"] for r in want] == [39] * 40


def test_rows_without_ids_are_dealt_out(spark, tmp_path):
    rows = spark.range(4000).selectExpr("cast(null as long) doc_id", "concat('text number ', id) text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # so few bytes would be one task
    try:
        parts = token_output.write_shards(spark, rows, vocabulary_path("byte_bpe_50k.json"), f"file://{tmp_path}").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.part for r in parts}) >= 4 and max(r.n_docs for r in parts) < 2000 and sum(r.n_docs for r in parts) == 4000


def test_benchmark_of_many_blocks(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(str, decontamination.contamination(spark, docs, items).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 300)
    assert len(decontamination.item_blocks(spark, items)) >= 10
    assert sorted(map(str, decontamination.contamination(spark, docs, items).collect())) == want
    assert decontamination.item_blocks(spark, items.limit(0)) == []


def test_components_with_a_hot_root(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT_ROWS", 100)
    monkeypatch.setattr("tidewake.llm.shared.HOT_ROWS", 100)
    links = spark.range(1, 3000).selectExpr("id u", "0L v").unionByName(spark.range(5000, 5200).selectExpr("id u", "id + 1 v"))
    got = {r.node: r.component for r in components.components(spark, links).collect()}
    assert all(got.get(k, 0) == 0 for k in range(3000)) and all(got.get(k, 5000) == 5000 for k in range(5000, 5201))
