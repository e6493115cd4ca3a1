"""The ten operators: brute force over a small table, awkward rows, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidewake.llm import decontamination, license_scan, line_dedup, mixing, pii, quality_rules, simhash, token_counts, token_output, toxicity, wavelet
from tidewake.llm.codec import Codec
from tidewake.llm.text import Texts
from tidewake.llm.token_counts import vocabulary_path

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, `_hash` int, `_doc` int, `_copies` int, `_gone` int, `_kept_id` int, `row` int, `class` int, token int, h int, fp int, size int"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def awkward():
    rng = random.Random(7)
    words = [f"w{k}" for k in range(60)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    texts = [None, "", "   \n\t\n", "one", "one two", "Zürich straße 漢字 ÀÉ", line(400_000 // 3), "a" * 30_000, "1" * 5_000 + "@" * 50, ". " * 3_000]
    base = [line(30) for _ in range(12)]
    texts += ["\n".join(base), "\n".join(base), "\n".join(base).replace("w1 ", "w2 ", 1), "\n".join(reversed(base))]
    texts += [f"{line(15)}\nLicensed under the Apache License, Version 2.0.\nmail a.b@c.de card 4539578763621486 +1 (017) 555-7713 10.0.0.1" for _ in range(3)]
    texts += ["licensed under the apche license verson 2.0", "MIT license", "token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\" GB82 WEST 1234 5698 7654 32"]
    texts += [line(12) for _ in range(20)] + ["same text again"] * 30
    ids = [None, *range(1, len(texts) - 1), 5]  # a null id, and one that repeats
    return [(i, t, rng.choice(["a", "b", "b", "b", "", None]), None, 1, *[k] * 11) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["docs", "corpus"])
def table(request):
    return request.getfixturevalue(request.param)


def as_counts(rows):
    return Counter(map(tuple, rows))


# 3


def quality_by_hand(text):
    w = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality_counts(spark, table):
    got = quality_rules.score(spark, table, quality_rules.ALL_CONTENT)
    want = [(i, *quality_by_hand(t)) for i, t in texts_of(table)]
    assert as_counts(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == as_counts(want)


def test_quality_viterbi_is_exact():
    rng = np.random.default_rng(3)
    field = quality_rules.Field(rng.normal(size=10), 0.3, 1.1, np.zeros(10), np.ones(10))
    sizes = [0, 1, 2, 3, 7, 5, 1, 8]
    first = np.concatenate([[0], np.cumsum(sizes)])
    x = rng.normal(size=(first[-1], 10)) * 0.4
    got = quality_rules.viterbi(field, first, x)
    unary = x @ field.weights + field.bias
    for a, b in zip(first[:-1], first[1:], strict=True):
        def score(m, a=a, b=b):
            s = [1 if m >> k & 1 else -1 for k in range(b - a)]
            return sum(v * u / 2 for v, u in zip(s, unary[a:b], strict=True)) + field.coupling / 2 * sum(p * q for p, q in zip(s, s[1:], strict=False))

        best = max(range(1 << (b - a)), key=score)
        assert [bool(best >> k & 1) for k in range(b - a)] == got[a:b].tolist()


def test_quality_model_agrees_with_labels(spark, sf_dir, corpus):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = quality_rules.train(spark, corpus, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = {r.doc_id: r for r in quality_rules.score(spark, corpus, field).collect()}
    judged = [(truth[i], rows[i].kept) for i in truth if not rows[i].base_failed]
    assert sum(q == k for q, k in judged) >= 0.95 * len(judged)
    assert quality_rules.keep_good(spark, corpus, field).count() == sum(r.kept for r in rows.values())


def test_quality_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.train(spark, docs, none).bias == quality_rules.ALL_CONTENT.bias
    assert quality_rules.keep_good(spark, empty, quality_rules.ALL_CONTENT).collect() == []
    kept = quality_rules.keep_good(spark, docs, quality_rules.ALL_CONTENT)
    assert kept.columns == docs.columns and all(r["_hash"] == r["size"] for r in kept.collect())


# 8


def fingerprint(text):
    w = SPACE.findall(lower(text))
    if not w:
        return 0
    h = np.array([xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))


def linked_by_hand(fps, ids):
    own = list(range(len(fps)))

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                own[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for k, i in enumerate(ids):
        if i is not None:
            least[root(k)].append(i)
    return [min(least[root(k)], default=None) for k in range(len(fps))]


def test_simhash(spark, table):
    rows = texts_of(table)
    fps = [fingerprint(t) for _, t in rows]
    want = list(zip([i for i, _ in rows], fps, linked_by_hand(fps, [i for i, _ in rows]), strict=True))
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(spark, table).collect()]
    assert Counter(got) == Counter(want)
    kept = simhash.one_of_each_group(spark, table)
    assert kept.columns == table.columns
    least = defaultdict(list)
    for (i, _), group in zip(rows, linked_by_hand(fps, list(range(len(rows)))), strict=True):
        least[group].append((i is None, i or 0))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == Counter(map(min, least.values()))


def test_simhash_dense_and_hot_groups(spark, monkeypatch):
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    monkeypatch.setattr(simhash, "HOT", 40)
    monkeypatch.setattr(simhash, "MAX_HOT", 10**6)
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    meeting = simhash.variants(spark, table).repartition(4, "variant", "part").sortWithinPartitions("variant", "part", "fp")
    links = meeting.mapInArrow(simhash.group_links, "u long, v long").distinct().collect()
    own = {f: f for f in signed}

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for u, v in links:
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= 4
        a, b = root(u), root(v)
        own[max(a, b)] = min(a, b)
    want = linked_by_hand(fps, list(range(len(fps))))
    got = defaultdict(set)
    for k, f in enumerate(signed):
        got[root(f)].add(want[k])
    assert all(len(x) == 1 for x in got.values()) and len(got) == len(set(want))


def test_simhash_empty(spark, empty):
    assert simhash.near_duplicates(spark, empty).collect() == [] and simhash.one_of_each_group(spark, empty).collect() == []


# 10


def contaminated_by_hand(text, windows):
    w = ALNUM.findall(lower(text))
    hit, items = set(), set()
    for n in {len(x) for x in windows}:
        for k in range(len(w) - n + 1):
            own = windows.get(tuple(w[k : k + n]))
            if own:
                hit.update(range(k, k + n))
                items |= own
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [500_000, 60])
def test_decontamination(spark, table, sf_dir, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(12).selectExpr("cast(item_id as string) item_id", "text")
    extra = [("x", "same text again"), ("y", None), ("z", " . "), ("w", "one"), ("x", "same text again"), (None, "one two"), ("long", " ".join(f"w{k % 7}" for k in range(30)))]
    items = items.unionByName(spark.createDataFrame(extra, "item_id string, text string"))
    windows = defaultdict(set)
    for i, t in [(r.item_id, r.text) for r in items.collect()]:
        w = ALNUM.findall(lower(t))
        for k in range(max(len(w) - 9, min(len(w), 1))):
            windows[tuple(w[k : k + 10])] |= {i} - {None} or {""}
    windows = {k: v - {""} for k, v in windows.items()}

    def by_hand(text):
        w = ALNUM.findall(lower(text))
        hit = {p for n in {len(x) for x in windows} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)}
        n, _, m, digest, _ = contaminated_by_hand(text, windows)
        return n, len(hit), m, digest, bool(hit)

    want = [(i, *by_hand(t)) for i, t in texts_of(table)]
    got = decontamination.contamination(spark, table, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert as_counts(got.collect()) == as_counts(want)
    clean = decontamination.remove_contaminated(spark, table, items)
    assert clean.columns == table.columns and clean.count() == sum(not x[-1] for x in want)


def test_decontamination_empty(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(spark, empty, none).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(spark, docs, none).collect())


# 5


def test_mixing_empty(spark, empty):
    assert mixing.mix(spark, empty).collect() == [] and mixing.mixed_rows(spark, empty).collect() == []


# 6 and 7


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_is_the_library(name):
    from tokenizers import Tokenizer

    rng = random.Random(11)
    parts = [*"aB1 \n\t  'é漢. 　́Σİ \x85\x1cſ<|", "'s", "<|endoftext|>", " <|endoftext|> ", "don't", "  ", "\r\n", "​", "﻿", "x y"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + [None, "", "word " * 20_000]
    own, library = Codec(vocabulary_path(name)), Tokenizer.from_file(vocabulary_path(name))
    ids, sizes = own.encode(Texts(pa.array(texts)))
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want] == own.lengths(Texts(pa.array(texts))).tolist()
    assert ids.tolist() == [x for w in want for x in w]


def test_token_counts(spark, table):
    from tokenizers import Tokenizer

    path = vocabulary_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = texts_of(table)
    n = [len(e.ids) for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = [(i, len((t or "").encode()), k, k > 2048) for (i, t), k in zip(rows, n, strict=True)]
    assert as_counts(token_counts.token_counts(spark, table, path).collect()) == as_counts(want)


def test_token_output(spark, table):
    from tokenizers import Tokenizer

    path = vocabulary_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = sorted(texts_of(table), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert as_counts(token_output.token_output(spark, table, path).collect()) == as_counts(want)


def test_tokens_empty(spark, empty):
    path = vocabulary_path("byte_bpe_50k.json")
    assert token_output.token_output(spark, empty, path).collect() == [] and token_counts.token_counts(spark, empty, path).collect() == []


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (63, 3), (64, 40), (5000, 50257), (1500, 200_000)])
def test_wavelet(n, top):
    x = (np.random.default_rng(n).zipf(1.3, n) - 1) % top
    shard = wavelet.WaveletShard(wavelet.build(x, np.array([0, n]), [None]))
    assert shard.decode().tolist() == x.tolist() and shard.doc_ids == [None]
    assert [shard.access(i) for i in range(0, n, 41)] == x[::41].tolist()
    for token in {0, 1, 2, top - 1}:
        at = np.flatnonzero(x == token)
        assert shard.count(token) == len(at) and shard.rank(token, n // 3) == (x[: n // 3] == token).sum()
        assert [shard.select(token, k) for k in range(len(at))][:50] == at[:50].tolist()
    with pytest.raises(IndexError):
        shard.access(n)


# 4


def pii_by_hand(t):
    out = []
    for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if k == "card" and not (14 <= len(d) <= 19 and sum(int(c) if j % 2 == 0 else sum(divmod(2 * int(c), 10)) for j, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if k == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), ["email", "ip", "card", "phone"].index(k), f"{k}:{m.start()}:{m.end()}"))
    out.sort()
    n = Counter(x[1] for x in out)
    return n[0], n[1], n[2], n[3], hashlib.sha256(",".join(x[2] for x in out).encode()).hexdigest()


def test_pii(spark, table):
    want = [(i, *pii_by_hand("" if t and t.startswith("1" * 5000) else t or "")) for i, t in texts_of(table)]
    got = pii.find_personal_data(spark, table).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert as_counts(got.collect()) == as_counts(want)


def test_pii_random():
    rng = random.Random(5)
    parts = ["1", "23", "255", "256", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "4539578763621486", "é", "x@y.z"]
    for _ in range(5000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.examine(t)[:5] == pii_by_hand(t)


def test_pii_method():
    kinds = lambda t: [s.split(":")[0] for s in pii.examine(t)[5].split(",") if s]
    assert "iban" in kinds("pay GB82 WEST 1234 5698 7654 32 now") and "iban" not in kinds("pay GB83 WEST 1234 5698 7654 32 now")
    assert "secret" in kinds('token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"') and "secret" not in kinds("commit 9b0b3c6a43eb78aa99cbd7049c572391524f37a8")
    assert "ssn" in kinds("SSN 123-45-6789") and "ssn" not in kinds("part 123-45-6789")


# 9


def test_license(spark, table):
    want = []
    for i, t in texts_of(table):
        w = ALNUM.findall(lower(t))
        at = [(k, label) for phrase, label in license_scan.PHRASES.items() for p in [phrase.split()] for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
        places = [k for k, _ in at]
        want.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    got = license_scan.license_scan(spark, table)
    assert as_counts(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()) == as_counts(want)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got.collect())


def test_license_fuzzy():
    got = license_scan.scan(pa.array(["Licensed under the Apche License verson 2.0", "nothing here", "released under the MIT licence", None, "x" * 50_000]))
    assert got["labels"][:2] == ["apache", ""] and got["labels"][2] == "mit" and got["n_base"] == [0] * 5
    assert 0.9 < got["score"][0] < 1 and got["score"][1] == 0


# 2


def test_segments_are_maximal():
    rng = random.Random(2)
    for _ in range(300):
        s = np.array([rng.choice([-1.0, -0.5, 0.4, 1.0, 1.5]) for _ in range(rng.randint(0, 40))])
        got = toxicity.segments(s)
        best = max((s[a:b].sum() for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=0)
        assert max((x for _, _, x in got), default=0) == pytest.approx(max(best, 0))
        for a, b, x in got:
            assert s[a:b].sum() == pytest.approx(x) and all(s[a:k].sum() > 0 for k in range(a + 1, b + 1)) and all(s[k:b].sum() > 0 for k in range(a, b))
        assert all(b <= c for (_, b, _), (c, _, _) in zip(got, got[1:], strict=False))


def test_toxicity(spark, docs, empty):
    bad = ["idiot", "scum", "moron", "trash"]
    rng = random.Random(4)
    rows = []
    for k in range(400):
        words = [f"v{rng.randint(0, 300)}" for _ in range(60)]
        if k % 4 == 0:
            for _ in range(4):
                words[rng.randint(0, 59)] = rng.choice(bad)
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(spark, train.select("doc_id", "text"), train.select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.toxicity(spark, train, model).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in got if got[i].held_out]
    assert sum(got[i].predicted == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    out = toxicity.toxicity(spark, docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert toxicity.toxicity(spark, empty, model).collect() == []
    none = toxicity.train(spark, docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.toxicity(spark, docs, none).collect()} == {0.0}


# 1


def lines_by_hand(rows):
    first, every = {}, []
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(SPACE.findall(lower(line)))
            if s:
                at = (line_dedup.NULL_ID if i is None else i, k)
                every.append((i, k, s, at))
                first[s] = min(first.get(s, at), at)
    links, near = Counter(), {}
    sets = list(first)
    for a, x in enumerate(sets):
        for y in sets[:a]:
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                for p, q in ((x, y), (y, x)):
                    links[p] += 1
                    near[p] = min(near.get(p, first[q]), first[q])
    return [(i, k, links[s], at > first[s] or (s in near and near[s] < first[s])) for i, k, s, at in every]


@pytest.mark.parametrize("hot", [1500, 8])
def test_line_dedup(spark, table, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    got = line_dedup.line_classes(spark, table).select("doc_id", "line_no", "links", "removed")
    assert as_counts(got.collect()) == as_counts(lines_by_hand(texts_of(table)))


def test_line_dedup_dense(spark):
    rng = random.Random(9)
    base = [f"t{k}" for k in range(40)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(40)] = f"x{rng.randrange(50)}"
        rows.append((k, " ".join(w) + f"\nonly line {k} here of its own kind"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_classes(spark, table).select("doc_id", "line_no", "links", "removed")
    want = lines_by_hand(rows)
    assert as_counts(got.collect()) == as_counts(want)
    gone = Counter(i for i, _, _, r in want if r)
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark, table).collect()}
    assert all(len(left[i].split("\n") if left[i] else []) == 2 - gone[i] for i in left)


def test_line_dedup_empty(spark, empty, docs):
    assert line_dedup.line_classes(spark, empty).collect() == []
    out = line_dedup.dedup_lines(spark, docs)
    assert out.columns == docs.columns and out.count() == docs.count() and all(r["_gone"] == r["_hash"] for r in out.collect())


def test_line_dedup_block_without_members(spark, monkeypatch):
    """A group of more blocks than members: a pair of one block is not counted again where the other block is empty."""
    monkeypatch.setattr(line_dedup, "HOT", 1)
    rows = [(k, "a b c d e f g h i j" + (f" x{k}" if k else "")) for k in range(5)]
    got = line_dedup.line_classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "line_no", "links", "removed")
    assert as_counts(got.collect()) == as_counts(lines_by_hand(rows))


def test_codec_with_little_memory(monkeypatch):
    from tokenizers import Tokenizer

    from tidewake.llm import codec

    monkeypatch.setattr(codec, "REMEMBERED", 40)
    path = vocabulary_path("byte_bpe_50k.json")
    own, library, rng = Codec(path), Tokenizer.from_file(path), random.Random(1)
    for _ in range(6):
        texts = [" ".join(f"{rng.choice('abc')}{rng.randint(0, 90)}" for _ in range(30)) for _ in range(10)]
        ids, sizes = own.encode(Texts(pa.array(texts)))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
