"""The pipeline against its stages done by hand, on the smallest tables and on an awkward one."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tidewake.llm import mixing, quality_rules
from tidewake.llm.token_counts import vocabulary_path

from .test_operators import ALNUM, SCHEMA, SPACE, contaminated_by_hand, fingerprint, linked_by_hand, lower


def windows_of(spark, sf_dir):
    out = defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = ALNUM.findall(lower(r.text))
        for k in range(max(len(w) - 9, min(len(w), 1))):
            out[tuple(w[k : k + 10])].add(str(r.item_id))
    return out


def pieces_by_hand(spark, rows):
    """(id, text) of all that the mix takes of (id, text, source) rows: documents in order of their hashes, end to end, block after block."""
    hashed = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", mixing.order_hash().alias("h")).collect()
    names = sorted({r.source for r in hashed}, key=lambda s: (s is None, s or ""))
    words = lambda s: sum(len(SPACE.findall(r.text or "")) for r in hashed if r.source == s)
    out = []
    for k, (s, t) in enumerate(zip(names, mixing.targets([words(s) for s in names]), strict=True)):
        d, at = mixing.Draws(words(s), t, mixing.BLOCK_WORDS, k), 0
        places = [d.places(p, np.arange(d.blocks)).tolist() for p in range(2)]
        for r in sorted((r for r in hashed if r.source == s), key=lambda r: (r.h & (1 << 64) - 1) ^ 1 << 63):
            found = [(m.start(), m.end()) for m in SPACE.finditer(r.text or "")]
            for p in range(2):
                taken = []
                for w in range(at, at + len(found)):
                    place = places[p][w // d.block] + p * d.blocks
                    most = d.part if place == d.quota - 1 and d.part else d.block
                    if place < d.quota and w % d.block < most:
                        taken.append((w // d.block, w - at))
                for b in sorted({b for b, _ in taken}):
                    own = [w for c, w in taken if c == b]
                    out.append((r.doc_id, r.text if len(own) == len(found) else r.text[found[own[0]][0] : found[own[-1]][1]]))
            at += len(found)
    return out


_library = {}


def ids_by_hand(text):
    from tokenizers import Tokenizer

    if "library" not in _library:
        _library["library"] = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    return [*_library["library"].encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("block", [1 << 14, 100])
def test_pipeline(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = quality_rules.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality_rules.score(spark, docs, field).collect() if r.kept}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in good}
    ids = sorted(rows)
    least = linked_by_hand([fingerprint(rows[i].text) for i in ids], ids)
    windows = windows_of(spark, sf_dir)
    clean = [i for i, c in zip(ids, least, strict=True) if i == c and not contaminated_by_hand(rows[i].text, windows)[-1]]
    want = Counter()
    for i, text in pieces_by_hand(spark, [(i, rows[i].text, rows[i].source) for i in clean]):
        own = ids_by_hand(text)
        want[i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)


def awkward(rng):
    """Null and repeated ids on unlike texts, copies, empty and long texts, null sources; among columns whose names clash."""
    line = lambda n: " ".join(f"v{rng.randrange(900)}" for _ in range(n)) + "."
    texts = [line(60) for _ in range(14)] + [None, "", " \n", "few words", line(30_000)]
    texts += [texts[0], texts[0], texts[1]]
    ids = [None, None, 3, 3, *range(10, 10 + len(texts) - 6), None, 3]
    return [(i, t, rng.choice(["a", "b", None, ""]), None, 1, *[k] * 11) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def test_stages_on_awkward_rows(spark, sf_dir):
    rng = random.Random(2)
    rows = awkward(rng)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    text = dict(enumerate(r[1] for r in rows))
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    good = kept.collect()
    assert all((r.text, r.doc_id, r["_hash"]) == (text[r["class"]], rows[r["class"]][0], r["class"]) for r in good)
    assert not {r.text for r in good} & {None, "", " \n", "few words"}
    one = corpus_pipeline.near_dedup_stage(spark, docs, sf_dir)
    assert one.columns == docs.columns
    # Each text once, but for those without words, which are one group.
    assert Counter(r.text for r in one.collect() if r.text and r.text.strip()) == Counter({t for t in text.values() if t and t.strip()})
    clean = corpus_pipeline.decontamination_stage(spark, docs, sf_dir)
    assert clean.columns == docs.columns and Counter(r["class"] for r in clean.collect()) == Counter(text.keys())
    mixed = corpus_pipeline.mixing_stage(spark, docs, sf_dir)
    assert mixed.columns == docs.columns
    drawn = mixed.collect()
    assert drawn and all(r.text in text[r["class"]] and r.doc_id == rows[r["class"]][0] for r in drawn)
    assert all(r.n_chars == (1 if r.text == text[r["class"]] else len(r.text)) for r in drawn)
    tokens = corpus_pipeline.token_stage(spark, docs, sf_dir).collect()
    assert len(tokens) == len(rows) and Counter(r.doc_id for r in tokens) == Counter(r[0] for r in rows)


def test_stages_on_no_rows(spark, sf_dir):
    none = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, none, sf_dir)
        assert got.collect() == [], name
        assert name == "token_output" or got.columns == none.columns
