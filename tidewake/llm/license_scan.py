"""License notices by fuzzy short-notice search.

A text is reduced to its lower-case words joined by single spaces. Base phrases
must stand there exactly, word by word. A notice of NOTICES may differ by up to
len / EDIT_SHARE edits, MAX_EDITS at most: cut into one piece more than edits
allowed, one piece must stand exactly, so an Aho-Corasick automaton over all
pieces proposes places, and the regex library's bounded-error matching verifies
them and gives the span and its edits. Each place is verified once for a notice.

score: 1 with a base phrase, else one less the share of edits of the best notice.
Edits are counted in UTF-8 bytes; spans of notices are places in the document, in
code points. Defined results: a null text counts as empty, which has no words, places
or labels; texts of any length are searched whole; repeated rows each get a row, and
so do rows without a doc_id; an empty table gives an empty table. Other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .shared import small_batches
from .text import ALNUM, LOWER, Texts, slices

#: Base phrases and their labels: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Short notices and their labels, in the reduced form.
NOTICES = {
    "licensed under the gnu general public license": "gpl",
    "under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
EDIT_SHARE, MAX_EDITS = 12, 4

RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notice_spans string"


def edits_of(notice: str) -> int:
    return min(MAX_EDITS, len(notice) // EDIT_SHARE)


@lru_cache(maxsize=1)
def machinery() -> tuple[ahocorasick.Automaton, list, list]:
    """The automaton; its targets (kind, number, offset, length) are listed by pattern."""
    targets: dict[str, list] = {}
    for k, phrase in enumerate(PHRASES):
        targets.setdefault(phrase, []).append(("base", k, 0))
    patterns = []
    for k, notice in enumerate(NOTICES):
        allowed = edits_of(notice)
        bounds = np.linspace(0, len(notice), allowed + 2).astype(int)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            targets.setdefault(notice[a:b], []).append(("notice", k, int(a)))
        patterns.append((regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={allowed}}}"), len(notice), allowed))
    automaton = ahocorasick.Automaton()
    for text, found in targets.items():
        automaton.add_word(text, (len(text), found))
    automaton.make_automaton()
    return automaton, patterns, list(NOTICES.values())


def scan(column: pa.Array) -> dict[str, list]:
    texts = Texts(column)
    n = texts.n
    starts, ends, doc = texts.runs(ALNUM[texts.data])
    words = np.bincount(doc, minlength=n)
    base: dict[int, list[tuple[int, int]]] = {}
    spans: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
    lengths = ends - starts + 1
    begin = np.cumsum(lengths) - lengths
    first = np.cumsum(words) - words
    if len(starts):
        joined = np.full(int(lengths.sum()), 0x20, np.uint8)
        inside = np.ones(len(joined), bool)
        inside[begin + lengths - 1] = False
        joined[inside] = LOWER[texts.data[ALNUM[texts.data]]]
        # A line break after the last word of a text keeps matches inside it.
        last = (first + words - 1)[words > 0]
        joined[(begin + lengths - 1)[last]] = 0x0A
        text = joined.tobytes().decode("latin-1")
        automaton, patterns, _ = machinery()
        bounds = np.concatenate([[0], (begin + lengths)[last]])
        full = np.flatnonzero(words)
        verified: dict[tuple[int, int], int] = {}  # end of the last region searched
        for stop, (size, found) in automaton.iter(text):
            at = stop + 1 - size
            row = int(np.searchsorted(bounds, at, "right")) - 1
            d, low, high = int(full[row]), int(bounds[row]), int(bounds[row + 1]) - 1
            for kind, k, offset in found:
                if kind == "base":
                    if (at == low or text[at - 1] == " ") and (stop + 1 == high or text[stop + 1] == " "):
                        base.setdefault(d, []).append((int(np.searchsorted(begin, at)) - int(first[d]), k))
                    continue
                pattern, length, allowed = patterns[k]
                a, b = max(low, at - offset - allowed), min(high, at - offset + length + allowed)
                if verified.get((d, k), -1) >= b:
                    continue
                verified[d, k] = b
                hit = pattern.search(text, a, b)
                if hit:
                    spans.setdefault(d, {}).setdefault(k, []).append((hit.start() - low, hit.end() - low, sum(hit.fuzzy_counts)))
    labels_of, phrase_labels = list(NOTICES.values()), list(PHRASES.values())
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)]) if spans else None

    def in_document(d: int, at: int, end: bool) -> int:
        """The code point of a place of the reduced text of a document; of the place after a character if end."""
        place = int(begin[first[d]]) + at
        word = int(np.searchsorted(begin, place - end, "right")) - 1
        byte = min(int(starts[word]) + place - int(begin[word]), int(ends[word]))
        return int(points[byte] - points[texts.bounds[d]])

    sizes = [len(x) for x in NOTICES]
    out: dict[str, list] = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "notice_spans")}
    for d in range(n):
        places, own = base.get(d, ()), nearest(spans.get(d, {}), sizes)
        at = [w for w, _ in places]
        known = {phrase_labels[k] for _, k in places}
        out["n_base"].append(len(at))
        out["first_word"].append(min(at) if at else None)
        out["last_word"].append(max(at) if at else None)
        out["base_labels"].append(",".join(sorted(known)))
        out["labels"].append(",".join(sorted(known | {labels_of[k] for k in own})))
        best = max((1 - e / sizes[k] for k, hits in own.items() for _, _, e in hits), default=0.0)
        out["score"].append(1.0 if at else best)
        out["notice_spans"].append(",".join(f"{labels_of[k]}:{in_document(d, a, False)}:{in_document(d, b, True)}:{e}" for a, b, e, k in sorted({(a, b, e, k) for k, hits in own.items() for a, b, e in hits})))
    out["n_words"] = words.tolist()
    return out


def nearest(found: dict[int, list[tuple[int, int, int]]], sizes: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """Of notices that overlap, the one with the least share of edits (then the longer one)."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: list[tuple[int, int]] = []
    for _, _, k, (a, b, e) in sorted((x[2] / sizes[k], -sizes[k], k, x) for k, hits in found.items() for x in hits):
        if all(b <= c or a >= d for c, d in taken):
            taken.append((a, b))
            out.setdefault(k, []).append((a, b, e))
    return out


def license_scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """RESULT for each row. notice_spans: label:start:end:edits, comma-joined."""
    small_batches(spark)
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = {"first_word": pa.int64(), "last_word": pa.int64(), "n_base": pa.int64(), "n_words": pa.int64(), "score": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = scan(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), *(pa.array(got[k], kinds.get(k, pa.string())) for k in names[1:])], names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
