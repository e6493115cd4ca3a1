"""Results of the queries that SQL cannot express, against slow versions written out plainly; and held-out labels."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewake.llm import decontamination, license_scan, line_dedup, pii, quality_rules, toxicity
from tidewake.llm.text import Texts

from .test_operators import ALNUM, SPACE, as_counts, contaminated_by_hand, corpus, docs, empty, lines_by_hand, lower, quality_by_hand, table, texts_of  # noqa: F401  fixtures

# Hashes


def thue_morse(n):
    """Two texts that any polynomial hash modulo a power of two confuses."""
    t = "a"
    for _ in range(n):
        t += t.translate(str.maketrans("ab", "ba"))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_structured_texts_are_told_apart(spark):
    one, other = thue_morse(10)
    rows = [(1, f"{one}\n{other}"), (2, f"{one} x y z"), (3, f"{other} x y z"), (4, " ".join(one)), (5, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_rules.score(spark, docs, quality_rules.ALL_CONTENT)
    assert as_counts(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == as_counts([(i, *quality_by_hand(t)) for i, t in rows])
    lines = line_dedup.line_classes(spark, docs).select("doc_id", "line_no", "links", "removed")
    assert as_counts(lines.collect()) == as_counts(lines_by_hand(rows))
    items = [("a", one), ("b", " ".join(one[:40]))]
    windows = {tuple(ALNUM.findall(lower(t))[k : k + 10]): {i} for i, t in items for k in range(max(1, len(t.split()) - 9))}
    found = decontamination.contamination(spark, docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    for r in found:
        assert r.contaminated == contaminated_by_hand(dict(rows)[r.doc_id], windows)[-1]


def test_hashes_are_of_bytes():
    rng = random.Random(8)
    words = ["".join(rng.choice("abé\0") for _ in range(n)) for n in [*range(70)] * 6] + ["a", "a\0", "a\0\0", "a" * 48, "a" * 49]
    rng.shuffle(words)
    texts = Texts(pa.array(words))
    got = texts.hashes(texts.starts, texts.ends).tolist()
    assert len(set(zip(words, got, strict=True))) == len(set(words)) == len(set(got))


# 1


@pytest.mark.parametrize("dense", [0, 12, 10**6])
def test_pairs_and_groups_agree(spark, monkeypatch, dense):
    """Near copies of several sizes, long lines among them: links are the same whether pairs or members travel."""
    monkeypatch.setattr(line_dedup, "DENSE", dense)
    monkeypatch.setattr(line_dedup, "HOT", 30)
    rng = random.Random(dense)
    rows = []
    for n in (4, 5, 9, 30, 70, 140, 600, 3000):
        base = [f"t{n}x{k}" for k in range(n)]
        for _ in range(8 if n > 200 else 24):
            w = [x if rng.random() > 0.06 else f"y{rng.randrange(30)}" for x in base]
            rng.shuffle(w)
            rows.append((rng.randrange(60), " ".join(w)))
    want = lines_by_hand(rows)
    got = line_dedup.line_classes(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select("doc_id", "line_no", "links", "removed")
    assert sum(links for _, _, links, _ in want) > 200 and as_counts(got.collect()) == as_counts(want)


def test_dedup_takes_only_own_lines(spark):
    """Ids that are null or repeat on unlike texts lose only lines that are copies."""
    rows = [(1, "a b c d\nonly here"), (None, "first of none\na b c d"), (None, "a b c d\nsecond of none"), (7, "one two three\nx"), (7, "x y\none two three")]
    got = line_dedup.dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = Counter((r.doc_id, r.text) for r in got)
    assert left == Counter([(1, "a b c d\nonly here"), (None, "first of none"), (None, "second of none"), (7, "one two three\nx"), (7, "x y")])


# 2

MIDDLE, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def maximal(s, low):
    """The best segment, then those of what is left and right of it; the shortest of equals, the first of those."""
    best, at = 0.0, None
    for a in range(len(s)):
        total = 0.0
        for b in range(a, len(s)):
            total += s[b]
            if total > best + 1e-9 or (at and abs(total - best) <= 1e-9 and b + 1 - a < at[1] - at[0]):
                best, at = total, (a, b + 1)
    if at is None:
        return []
    a, b = at
    return [*maximal(s[:a], low), (low + a, low + b, best), *maximal(s[b:], low + b)]


@pytest.mark.skipif(not os.path.exists(MIDDLE), reason="needs the larger tables")
def test_toxicity_by_hand(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    model = toxicity.train(spark, rows, labels)
    scores = dict(zip(model.tokens.tolist(), model.scores.tolist(), strict=True))
    texts = {r.doc_id: r.text for r in rows.collect()}
    positive = 0
    for r in toxicity.toxicity(spark, rows, model).collect():
        text = lower(texts[r.doc_id])
        found = [(m.start(), m.end(), m[0]) for m in ALNUM.finditer(text)]
        if len(found) > 400:
            continue
        column = Texts(pa.array([w for _, _, w in found], pa.string()))
        hashes = column.hashes(column.starts, column.ends).tolist()
        s = [scores.get(h, toxicity.FLOOR) - toxicity.DRIFT for h in hashes]
        segments = maximal(s, 0)
        expect = [model.k * max(len(s), 1) * math.exp(-model.rate * x) for _, _, x in segments]
        gains = [min(60.0, math.log1p(1 / max(e, 1e-30))) for e in expect]
        best, total = max(gains, default=0.0), math.log1p(sum(gains))
        score = 1 / (1 + math.exp(-(model.weights[0] * best / 10 + model.weights[1] * total + model.weights[2])))
        at = lambda k: len(text[:k].encode())
        spans = [f"{at(found[a][0])}:{at(found[b - 1][1])}" for (a, b, _), e in zip(segments, expect, strict=True) if e <= toxicity.SIGNIFICANT]
        assert r.score == pytest.approx(score) and r.predicted == int(r.score >= 0.3)
        assert r.evidence == pytest.approx(best) and r.n_segments == len(spans) and r.segments == ",".join(spans)
        positive += bool(segments)
    assert positive


@pytest.mark.skipif(not os.path.exists(LARGER), reason="needs the larger tables")
def test_held_out_labels(spark):
    """Toxic documents whose labels the fit never saw."""
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = spark.read.parquet(f"{LARGER}/documents.parquet")
    got = toxicity.toxicity(spark, rows, toxicity.train(spark, rows, labels)).where("held_out").select("doc_id", "predicted")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    hit, missed, wrong = (counts.get(k, 0) for k in ((1, 1), (1, 0), (0, 1)))
    assert hit >= 0.85 * (hit + missed) and hit >= 0.85 * (hit + wrong)


# 3


def line_features(line, words, covered):
    """The ten features of one line, from its bytes."""
    raw = line.encode()
    share = lambda some: sum(b in some for b in raw) / max(len(raw), 1)
    noise = set(b"!#$%&*+/<=>@[\\]^_`{|}~")
    return [
        math.log1p(max(len(raw), 1)), math.log1p(len(words)), min(max(len(raw), 1) / max(len(words), 1), 60) / 10,
        min(share(noise), 0.5) * 4, min(share(set(b"#*$%&|<>")), 0.5) * 4, share(set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")), share(set(b"0123456789")),
        float(words[-1].encode()[-1] in b".!?:;"), sum(covered) / len(words), sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words),
    ]


def test_content_share_by_hand(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    field = quality_rules.train(spark, rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = {r.doc_id: r.text for r in rows.collect()}
    shares = set()
    for r in quality_rules.score(spark, rows, field).collect():
        text = texts[r.doc_id] or ""
        w = SPACE.findall(text)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = [False] * len(w)
        for k in range(len(w) - 7):
            if seen[tuple(w[k : k + 8])] > 1:
                covered[k : k + 8] = [True] * 8
        unary, sizes, at = [], [], 0
        for line in text.split("\n"):
            own = SPACE.findall(line)
            if own:
                x = line_features(line, own, covered[at : at + len(own)])
                unary.append(sum((v - m) / s * c for v, m, s, c in zip(x, field.mean, field.scale, field.weights, strict=True)) + field.bias)
                sizes.append(len(own))
                at += len(own)
        # The best labelling by trying all ends of each prefix.
        best = {0: (0.0, []), 1: (0.0, [])}
        for t, u in enumerate(unary):
            best = {y: max(((v + (field.coupling / 2 * (1 if y == z else -1) if t else 0) + (u if y else -u) / 2, [*path, y]) for z, (v, path) in best.items() if t or y == z), key=lambda p: p[0]) for y in (0, 1)}
        labelling = max(best.values(), key=lambda p: p[0])[1] if unary else []
        share = sum(n for n, y in zip(sizes, labelling, strict=True) if y) / max(len(w), 1)
        assert r.content_share == pytest.approx(share, abs=1e-9) and r.kept == (not r.base_failed and share >= 0.5)
        shares.add(round(share, 2))
    assert len(shares) > 2


# 4


def added_by_hand(t):
    """Added spans with their scores, place by place."""
    alnum = lambda c: c.isascii() and c.isalnum()
    out, end = [], 0
    for i in range(len(t) - 4):
        if i < end or (i and alnum(t[i - 1])) or not re.fullmatch("[A-Z]{2}[0-9]{2}", t[i : i + 4]) or t[i : i + 2] not in pii.IBAN_LENGTH:
            continue
        j, have = i + 4, t[i : i + 4]
        while len(have) < pii.IBAN_LENGTH[t[i : i + 2]]:
            j += t[j : j + 1] == " "
            if not re.fullmatch("[A-Z0-9]", t[j : j + 1]):
                break
            have += t[j]
            j += 1
        if len(have) == pii.IBAN_LENGTH[t[i : i + 2]] and not alnum(t[j : j + 1] or " ") and int("".join(str(int(c, 36)) for c in have[4:] + have[:4])) % 97 == 1:
            out.append((i, j, "iban"))
            end = j
    body = lambda c: alnum(c) or c in "_+/-"
    i = 0
    while i < len(t):
        if not body(t[i]) or (i and (body(t[i - 1]) or t[i - 1] == ".")):
            i += 1
            continue
        j = i
        while j < len(t) and (body(t[j]) or (t[j] == "." and body(t[j + 1 : j + 2] or " "))):
            j += 1
        k = j
        while k < len(t) and t[k] == "=" and k < j + 2:
            k += 1
        pieces = re.split("[+/.=]+", t[i:k])
        if k - i >= 20 and any(len(p) >= 12 and re.search("[0-9]", p) and re.search("[A-Za-z]", p) for p in pieces):
            out.append((i, k, "secret"))
        i = max(k, i + 1)
    out += [(m.start(), m.end(), "ssn") for m in re.finditer("(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", t)]
    return [s for s in out if score_by_hand(t, *s) >= 0.5]


def score_by_hand(t, a, b, kind):
    near = (t[max(0, a - 40) : a] + " " + t[b : b + 40]).lower()
    score = pii.RAISING[kind][0] + (0.4 if [w for w in pii.RAISING[kind][1] if w in near] else 0)
    return min(1, max(0, score - (0.3 if set(re.findall("[a-z]+", near)) & pii.LOWERING[kind] else 0)))


def spans_by_hand(t):
    added = added_by_hand(t)
    every = sorted([*pii.base_spans(t), *added], key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))
    clean = math.prod(1 - min(0.99, score_by_hand(t, *s)) for s in every)
    return ",".join(f"{k}:{a}:{b}" for a, b, k in every), len(added), 1 - clean


IBANS = ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "GB83 WEST 1234 5698 7654 32"]


def test_added_spans(spark, table):  # noqa: F811
    want = [(i, *spans_by_hand(t or "")) for i, t in texts_of(table) if len(t or "") < 20_000]
    got = {(r.doc_id, r.spans, r.n_added, round(r.risk, 9)) for r in pii.find_personal_data(spark, table).collect()}
    assert {(i, s, n, round(x, 9)) for i, s, n, x in want} <= got


def test_added_spans_random():
    rng = random.Random(6)
    parts = [*IBANS, " ", " ", "NOW", "BIC NWBKGB2L", "token = ", "key: ", "abcdef123456", "x" * 70 + "1", "A1b2" * 40, ".", "/", "+", "==", "-", "123-45-6789", "ssn ", "example ", "checksum ", "é", "\n", "a"]
    seen = Counter()
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        got = pii.examine(t)
        assert got[5:7] == spans_by_hand(t)[:2] and got[7] == pytest.approx(spans_by_hand(t)[2]), t
        seen.update(s.split(":")[0] for s in got[5].split(","))
    assert min(seen[k] for k in ("iban", "secret", "ssn")) > 50


def test_added_spans_of_any_length():
    kinds = lambda t: [s.split(":")[0] for s in pii.examine(t)[5].split(",") if s]
    for key in ("a1" * 70, "x" * 64 + "9", "abcd/efgh+1234567890ABCDEFGH==", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkw.SflKxwRJSMeKKF2QT4fwpM"):
        assert "secret" in kinds(f"token = {key}") and "secret" in kinds(f"token={key}."), key
        assert pii.examine(f"token = {key}")[5].split(",")[0] == f"secret:8:{8 + len(key)}"
    assert kinds("PAY GB82 WEST 1234 5698 7654 32 NOW PLEASE") == ["iban"] == kinds("IBAN GB82WEST12345698765432 BIC NWBKGB2L")
    assert "iban" not in kinds("an example of serial GB82 WEST 1234 5698 7654 32")
    # Context never takes a base span away.
    assert kinds("isbn 4539578763621486") == ["card"] and pii.examine("isbn 4539578763621486")[7] < pii.examine("card 4539578763621486")[7]


# 9


def least_edits(notice, text):
    """Edits of the best place of notice in text, by the table of prefixes."""
    row = np.zeros(len(text) + 1, np.int64)
    codes = np.frombuffer(text, np.uint8)
    for k, c in enumerate(notice, 1):
        best = np.minimum(row[:-1] + (codes != c), row[1:] + 1)
        best = np.concatenate([[k], best])
        steps = np.arange(len(best))
        row = np.minimum.accumulate(best - steps) + steps
    return int(row.min())


def test_notices_by_hand(spark, table):  # noqa: F811
    found = 0
    for r in license_scan.license_scan(spark, table.dropDuplicates(["doc_id"])).collect():
        text = next(t for i, t in texts_of(table) if i == r.doc_id) if r.notice_spans else None
        if not r.notice_spans:
            continue
        reduced = " ".join(ALNUM.findall(lower(text))).encode()
        spans = [s.split(":") for s in r.notice_spans.split(",")]
        allowed = {label: [n for n, x in license_scan.NOTICES.items() if x == label] for label in license_scan.NOTICES.values()}
        for label, a, b, e in spans:
            part = " ".join(ALNUM.findall(lower(text[int(a) : int(b)]))).encode()
            assert min(least_edits(n.encode(), part) for n in allowed[label]) <= int(e)
        assert set(r.labels.split(",")) == {x for x in {s[0] for s in spans} | set(r.base_labels.split(",")) if x}
        for notice, label in license_scan.NOTICES.items():
            edits = least_edits(notice.encode(), reduced)
            if edits <= license_scan.edits_of(notice):
                # It is reported, or something of no greater share of edits stands in its way.
                assert label in r.labels.split(",") or any(int(s[3]) * len(notice) <= edits * 200 + len(notice) for s in spans)
        found += 1
    assert found


def test_notices_that_are_not_there(spark, sf_dir):
    """No notice within its edits goes unreported: texts without spans have none."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in rows.collect()}
    none = [r.doc_id for r in license_scan.license_scan(spark, rows).collect() if not r.notice_spans]
    for i in none[::3]:
        reduced = " ".join(ALNUM.findall(lower(texts[i]))).encode()[:20_000]
        assert all(least_edits(n.encode(), reduced) > license_scan.edits_of(n) for n in license_scan.NOTICES)
