"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has a bit set where over half of the 64-bit XXH64 hashes of the
text's 4-word shingles do. Fingerprints of at most RADIUS = 4 differing bits
link. Cut into SEGMENTS = 3 segments, one of them differs by at most one bit
(three segments of two or more would make six), so two linked fingerprints
share a one-wildcard variant of a segment: 64 variants each, one for each bit
left out. Equal variants meet in a shuffle and are verified on all 64 bits.

Copies are no load: the search runs over distinct fingerprints. In a group of
equal variants only links of a spanning forest leave the task, found by
breadth-first search that compares each member with the members not yet
reached, so a dense group of n members gives n - 1 links. Groups of over
HOT members are cut into blocks, and each pair of blocks is a group of its own.
The variants that are hot are known from counts of segment values; at most
3 * N / (hot / 2) values can be, and hot grows with N so that they fit a broadcast
of MAX_HOT rows.

Defined results: null and empty texts have fingerprint zero and link like any
other; texts of any length are hashed whole; a null doc_id keeps its row, and its component_id is the least doc_id of
the component, or null without any; repeated rows each get a row; an empty table
gives an empty table. Other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import join_facts, materialize, small_batches, unused
from .sieve import passes, sieve_of
from .text import LOWER, NON_SPACE, Texts, slices

SHINGLE = 4
RADIUS = 4
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a variant group above which it is cut into blocks, and the most hot segment values.
HOT, MAX_HOT = 20_000, 50_000
#: Parts that a component's fingerprints are dealt to.
SALTS = 32


def fingerprints(column: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    texts = Texts(column)
    out = np.zeros(texts.n, np.uint64)
    if not len(texts.data):
        return out
    inside = NON_SPACE[texts.data]
    starts, ends, doc = texts.runs(inside)
    if not len(starts):
        return out
    # Words of a text, each followed by one space.
    lengths = ends - starts + 1
    new_starts = np.cumsum(lengths) - lengths
    joined = np.full(int(lengths.sum()), 0x20, np.uint8)
    place = np.ones(len(joined), bool)
    place[new_starts + lengths - 1] = False
    joined[place] = LOWER[texts.data[inside]]
    new_ends = new_starts + lengths - 1
    words = np.bincount(doc, minlength=texts.n)
    first = np.cumsum(words) - words
    shingles = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    which = np.repeat(np.arange(texts.n), shingles)
    begin = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    end = np.minimum(begin + SHINGLE, (first + words)[which]) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(data[a:b], 42) for a, b in zip(new_starts[begin].tolist(), new_ends[end].tolist(), strict=True)), np.uint64, len(begin))
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(shingles)
    at = np.cumsum(shingles) - shingles
    ones = np.add.reduceat(bits, at[full], axis=0, dtype=np.int32)
    out[full] = np.packbits(2 * ones > shingles[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint_table(spark: SparkSession, docs: DataFrame, marked: bool = False) -> DataFrame:
    """doc_id, fp of each row; marked: and mark, a hash of the text, which with doc_id tells a row from others."""
    small_batches(spark)
    kept = ["doc_id", "mark"] if marked else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.record_batch({**{c: part.column(c) for c in kept}, "fp": pa.array(fingerprints(part.column("text")).view(np.int64))})

    read = docs.select("doc_id", "text", *([F.xxhash64("text").alias("mark")] if marked else []))
    return read.mapInArrow(run, ", ".join(f"{c} long" for c in [*kept, "fp"]))


def segment_value(fp: np.ndarray, segment: int) -> np.ndarray:
    low, bits = SEGMENTS[segment]
    return (fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << bits) - 1)


def hot_values(distinct: DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each segment the values that over hot / 2 fingerprints have, with counts; and hot."""
    n = distinct.count()
    hot = max(HOT, 6 * n // MAX_HOT)
    values = F.array(*(F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned("fp", low).bitwiseAND((1 << bits) - 1).alias("value")) for s, (low, bits) in enumerate(SEGMENTS)))
    rows = distinct.select(F.explode(values).alias("x")).groupBy("x.segment", "x.value").count().where(F.col("count") > hot // 2).collect() if n > hot // 2 else []
    out = []
    for s in range(len(SEGMENTS)):
        own = sorted((r["value"], r["count"]) for r in rows if r["segment"] == s)
        out.append((np.array([v for v, _ in own], np.uint64), np.array([c for _, c in own], np.int64)))
    return out, hot


def variants(spark: SparkSession, distinct: DataFrame) -> DataFrame:
    """(variant, part, side, fp): the members of each group of equal variants; part, side: pairs of blocks of hot groups."""
    hot_of, hot = hot_values(distinct)
    sent = spark.sparkContext.broadcast(hot_of)

    def counts(s: int, value: np.ndarray) -> np.ndarray:
        known, count = sent.value[s]
        if not len(known):
            return np.zeros(len(value), np.int64)
        at = np.minimum(np.searchsorted(known, value), len(known) - 1)
        return np.where(known[at] == value, count[at], 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for s, (low, bits) in enumerate(SEGMENTS):
                value = segment_value(fp, s)
                own = counts(s, value)
                for b in range(bits):
                    flag = np.uint64(1 << b)
                    # The variant with its wildcard's place, in one number of 6 + 22 bits.
                    key = ((np.uint64(low + b) << np.uint64(22)) | (value & ~flag)).astype(np.int64)
                    members = own + counts(s, value ^ flag)
                    blocks = np.where(members > 0, -(-(members + hot // 2) // hot), 1)
                    yield from emit(key, fp, blocks)

    def emit(key: np.ndarray, fp: np.ndarray, blocks: np.ndarray) -> Iterator[pa.RecordBatch]:
        plain = blocks <= 1
        if plain.any():
            count = int(plain.sum())
            yield pa.record_batch({"variant": pa.array(key[plain]), "part": pa.array(np.zeros(count, np.int32)), "fp": pa.array(fp[plain])})
        many = np.flatnonzero(~plain)
        for k in range(0, len(many), 1000):
            at = many[k : k + 1000]
            n = blocks[at]
            own = ((fp[at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % n
            which = np.repeat(np.arange(len(at)), n)
            other = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            part = np.minimum(own[which], other) * n[which] + np.maximum(own[which], other) + 1
            yield pa.record_batch({"variant": pa.array(key[at][which]), "part": pa.array(part.astype(np.int32)), "fp": pa.array(fp[at][which])})

    return distinct.select("fp").mapInArrow(run, "variant long, part int, fp long")


def forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph of members at most RADIUS bits apart."""
    rest, own, other = fp.view(np.uint64), [], []
    front: list[np.uint64] = []
    while len(rest) and (front or len(rest) > 1):
        if not front:
            front, rest = [rest[0]], rest[1:]
        center = front.pop()
        near = np.bitwise_count(rest ^ center) <= RADIUS
        if near.any():
            reached = rest[near]
            own.append(np.full(len(reached), center))
            other.append(reached)
            front.extend(reached)
            rest = rest[~near]
    if not own:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(own).view(np.int64), np.concatenate(other).view(np.int64)


def group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (variant, part): the links within each group; a group may span batches."""
    held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        now = tuple(batch.column(c).to_numpy() for c in ("variant", "part", "fp"))
        if held is not None:
            now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
        variant, part, _ = now
        if not len(variant):
            continue
        # The last group may go on in the next batch.
        cut = len(variant) - 1
        edge = np.flatnonzero((variant[1:] != variant[:-1]) | (part[1:] != part[:-1]))
        cut = int(edge[-1]) + 1 if len(edge) else 0
        held = tuple(x[cut:] for x in now)
        if cut:
            yield links_of(*(x[:cut] for x in now))
    if held is not None and len(held[0]):
        yield links_of(*held)


def links_of(variant: np.ndarray, part: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    new = np.concatenate([[True], (variant[1:] != variant[:-1]) | (part[1:] != part[:-1])])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(variant)))
    two = begin[size == 2]
    a, b = fp[two], fp[two + 1]
    near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= RADIUS
    own, other = [a[near]], [b[near]]
    for k, n in zip(begin[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        u, v = forest(fp[k : k + n])
        if len(u):
            own.append(u)
            other.append(v)
    return pa.record_batch({"u": pa.array(np.concatenate(own)), "v": pa.array(np.concatenate(other))})


def labelled_fingerprints(spark: SparkSession, table: DataFrame, first: Column) -> DataFrame:
    """fp, first_id, component of each distinct fp of table; first: the aggregate of its rows that is first_id."""
    distinct = materialize(spark, table.groupBy("fp").agg(first.alias("first_id"), F.count("*").alias("copies")), "distinct-fingerprints")
    meeting = variants(spark, distinct).repartition("variant", "part").sortWithinPartitions("variant", "part", "fp")
    links = meeting.mapInArrow(group_links, "u long, v long").distinct()
    component = materialize(spark, components(spark, links), "components")
    return distinct.join(component, distinct.fp == component.node, "left").select("fp", "first_id", "copies", F.coalesce("component", "fp").alias("component"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for each row of docs."""
    table = materialize(spark, fingerprint_table(spark, docs), "fingerprints")
    labelled = labelled_fingerprints(spark, table, F.min("doc_id"))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    # A component of many fingerprints is dealt out by salt; fingerprints alone in theirs need no join.
    least = least.where("members > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("members")
    salted = labelled.withColumn("salt", F.pmod(F.hash("fp"), F.lit(SALTS)))
    of_fp = salted.join(least, ["component", "salt"], "left").select("fp", "copies", F.coalesce("component_id", "first_id").alias("component_id"))
    of_fp = materialize(spark, of_fp, "fingerprint-components")
    return join_facts(table, of_fp, ["fp"], "copies", table.count()).select("doc_id", "fp", "component_id")


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of docs for each component of fingerprints, of its least doc_id, null last; all columns as they are.

    A row is known by its doc_id and a hash of its text, so ids that are null or
    repeat on unlike texts are rows of their own. Rows that no Bloom filter of the
    rows in question holds stay where they are; only the rest, mostly the copies,
    are shuffled and joined.
    """
    table = materialize(spark, fingerprint_table(spark, docs, marked=True), "fingerprints")
    labelled = labelled_fingerprints(spark, table, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")))
    first = labelled.groupBy("component").agg(F.min("first_id").alias("x")).select(F.col("x.doc_id").alias("first_doc"), F.col("x.mark").alias("first_mark"), F.lit(True).alias("stays"))
    rows = table.groupBy("doc_id", "mark").agg(F.count("*").alias("rows"))
    judged = rows.join(first, rows["doc_id"].eqNullSafe(first["first_doc"]) & (rows["mark"] == first["first_mark"]), "left")
    judged = materialize(spark, judged.select("doc_id", "mark", "rows", F.coalesce("stays", F.lit(False)).alias("stays")), "kept-rows")
    # In question: rows that are not the first of their component, and rows with the same id and text.
    doubtful = judged.where(~F.col("stays") | (F.col("rows") > 1))
    sieve = spark.sparkContext.broadcast(sieve_of(doubtful.select(F.xxhash64("doc_id", "mark").alias("h")), "h", doubtful.count()))
    names = docs.columns
    mark, h, id_, kept_mark = (unused(n, names) for n in ("_mark", "_hash", "_kept_id", "_kept_mark"))
    hashed = docs.withColumn(mark, F.xxhash64("text")).withColumn(h, F.xxhash64("doc_id", mark))

    def side(inside: bool, columns: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doubt = passes(sieve.value, batch.column(h).to_numpy())
                yield batch.filter(pa.array(doubt == inside)).select(columns)

        return hashed.mapInArrow(run, hashed.select(*columns).schema)

    kept = judged.where("stays").select(F.col("doc_id").alias(id_), F.col("mark").alias(kept_mark), "rows")
    rest = side(True, [*names, mark])
    rest = rest.join(kept, rest["doc_id"].eqNullSafe(kept[id_]) & (rest[mark] == kept[kept_mark]), "left_semi").select(*names, mark)
    # Where id and text repeat, any of the rows stands for them.
    if kept.where("rows > 1").limit(1).count():
        rest = rest.dropDuplicates(["doc_id", mark])
    return side(False, names).unionByName(rest.select(*names))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(spark, docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
