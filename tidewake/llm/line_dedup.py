"""Line dedup by an exact set-similarity join over the lines of a corpus.

A line's set is its distinct words, A-Z lower-cased. Lines of equal sets are one
class; two classes link if the Jaccard similarity of their sets is 0.8 or more.
A line is removed if an earlier line, by (doc_id, line number), has its class or
a linked one. Lines without a word are never removed.

The join. Tokens are ordered by rarity: by the count, over all texts, of the
token's bucket of 2^18, then by hash; any one order is right, rarer first is fast.
Two linked sets of n <= m tokens share one of the first n - ceil(0.8 n) + 1
tokens of either (prefix filter), n >= 0.8 m (length filter), and what can still
follow a shared token bounds the overlap (positional filter). Round one meets on
prefix tokens with sizes, positions and signatures: each token flips one bit of
a signature of 64 to MAX_WIDTH bits, by the set's size, so sets differ in at
least as many tokens as their signatures do in bits. What passes is verified in
round two on the token sets. A pair counts where its first shared token is, so
each is counted once, in either of two forms:
pairs, where a token's candidates have few partners each (a pair brings the first
token that it was found at, and both sets), and groups, where they are dense:
members bring their sets, overlaps are counted by matrix products, and pairs never
leave the task. Tokens that over HOT classes begin with, by the counts of prefix
tokens in buckets, are cut into blocks before the shuffle, and each pair of blocks is a group.

Prefix rows travel as packed arrays, one for each task and slot of tokens. A class
is known by a 64-bit hash of its set with the set's 64-bit signature. Token
sets are compared by 64-bit hashes. Copies are dropped per task before any shuffle.

Defined results: null texts have no lines, empty lines none either; a text of any length is
handled whole; repeated rows, having equal positions, stay or go together; a null
doc_id counts as the greatest; an empty table gives an empty table. Other columns
pass through `dedup_lines` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import join_facts, materialize, small_batches, unused
from .sieve import passes, sieve_of
from .text import NON_SPACE, Texts, mix, slices

#: Similarity as a fraction.
NUMER, DENOM = 4, 5
BUCKET_BITS = 18
#: Buckets whose counts travel as one array.
CHUNK = 1 << 12
#: Bits of the widest signature: a filter alone, wider sets than it parts are verified.
MAX_WIDTH = 1024
#: Members above which a group is cut into blocks; class hashes that a task remembers.
HOT, REMEMBERED = 1024, 300_000
#: Pairs looked at together.
PAIRS = 1 << 19
#: Pairs for each member above which a group's candidates travel as members.
DENSE = 12
#: Prefix rows that a task packs at once, and of a slot about.
PACKED_ROWS, SLOT_ROWS = 1 << 20, 1 << 19
NULL_ID = (1 << 63) - 1


def words_of(column: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased texts, and start, document and hash of each word."""
    texts = Texts(column, lower=True)
    starts, ends, doc = texts.runs(NON_SPACE[texts.data])
    return texts, starts, doc, texts.hashes(starts, ends)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


#: The most tokens of a set whose signature has 1, 2, 4, ... words of 64 bits.
STEPS = 64 << np.arange(MAX_WIDTH.bit_length() - 7)


def width_of(size: np.ndarray) -> np.ndarray:
    """64-bit words of a set's signature: a bit for each token, rounded up to a power of two."""
    return 1 << np.searchsorted(STEPS, size)


def by_line(line: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order by line, then key: by both in one number, if no two keys that differ are then equal."""
    if len(line) and line[-1] < 1 << 20:
        both = (line.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20))
        order = np.argsort(both)
        both, own = both[order], key[order]
        if not ((both[1:] == both[:-1]) & (own[1:] != own[:-1])).any():
            return order
    return np.lexsort((key, line))


class Lines:
    """The lines with a word of some texts: document, number, class, and their sets, rarest token first, one after another."""

    def __init__(self, column: pa.Array, rank: np.ndarray):
        texts, starts, doc, hashes = words_of(column)
        breaks = np.zeros(len(texts.data) + 1, np.int32)
        np.cumsum(texts.data == 0x0A, out=breaks[1:])
        number = breaks[starts] - breaks[texts.bounds[doc]]
        new = np.ones(len(starts), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        line = np.cumsum(new) - 1
        # A token sorts by its bucket's rank, then by the hash below its bucket bits: another form of the hash.
        low = np.uint64(64 - BUCKET_BITS)
        key = (rank[bucket_of(hashes)].astype(np.uint64) << low) | (hashes & np.uint64((1 << (64 - BUCKET_BITS)) - 1))
        order = by_line(line, key)
        at = np.flatnonzero(new)
        self.doc, self.number = doc[at], number[at].astype(np.int64)
        line, key = line[order], key[order]
        keep = np.ones(len(line), bool)
        keep[1:] = (line[1:] != line[:-1]) | (key[1:] != key[:-1])
        self.line, self.tokens = line[keep], key[keep]
        self.size = np.bincount(self.line, minlength=len(at))
        self.begin = np.cumsum(self.size) - self.size
        self.mixed = mix(hashes[order][keep] + np.uint64(7))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.mixed, dtype=np.uint64)])
        self.classes = mix((total[self.begin + self.size] - total[self.begin]) ^ mix(self.size.astype(np.uint64)))
        bit = np.uint64(1) << (self.mixed >> np.uint64(58))
        self.signature = np.bitwise_xor.reduceat(bit, self.begin) if len(at) else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.begin)

    def set_of(self, k: int) -> np.ndarray:
        return self.tokens[self.begin[k] : self.begin[k] + self.size[k]]

    def wide(self, rows: np.ndarray, words: int) -> np.ndarray:
        """(rows, words) signatures of as many 64-bit words; in the first of them is the bit that tells which."""
        out = np.zeros((len(rows), words), np.uint64)
        size = self.size[rows]
        at = np.arange(int(size.sum())) + np.repeat(self.begin[rows] - (np.cumsum(size) - size), size)
        mixed = self.mixed[at]
        place = np.repeat(np.arange(len(rows)) * words, size) + (mixed & np.uint64(words - 1)).astype(np.int64)
        np.bitwise_xor.at(out.reshape(-1), place, np.uint64(1) << (mixed >> np.uint64(58)))
        return out


class Seen:
    """Remembers classes, so that a task passes on a class once or a few times."""

    def __init__(self) -> None:
        self.known: dict[int, int] = {}

    def fresh(self, lines: Lines) -> np.ndarray:
        """Places of the first of each class not met before."""
        _, first, back = np.unique(lines.classes, return_index=True, return_inverse=True)
        if (lines.signature != lines.signature[first[back]]).any():  # a hash that two classes have
            _, first = np.unique(np.stack([lines.classes, lines.signature], axis=1), axis=0, return_index=True)
        first = np.sort(first)
        keys, marks, known = lines.classes[first].tolist(), lines.signature[first].tolist(), self.known
        out = first[np.array([known.get(k) != s for k, s in zip(keys, marks, strict=True)], bool)]
        if len(known) > REMEMBERED:
            known.clear()
        known.update(zip(keys, marks, strict=True))
        return out


def prefix_length(size: np.ndarray) -> np.ndarray:
    return size - (NUMER * size + DENOM - 1) // DENOM + 1


def needed(n, m):
    """The least overlap of linked sets of n and m tokens: ceil(J / (1 + J) (n + m))."""
    return -(-(NUMER * (n + m)) // (NUMER + DENOM))


def chunks(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The counts in arrays of CHUNK, those with any, by number."""
    for k, part in enumerate(counts.reshape(-1, CHUNK)):
        if part.any():
            yield k, part.astype("<i8" if part.max() >> 31 else "<i4").tobytes()


def summed(found: DataFrame) -> np.ndarray:
    """All counts from (chunk, counts) rows; 2^BUCKET_BITS numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(data, "<i4" if len(data) == 4 * CHUNK else "<i8")
                sums[k] = sums.get(k, 0) + part.astype(np.int64)
        yield pa.record_batch({"chunk": pa.array(list(sums), pa.int64()), "counts": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    out = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in found.repartition("chunk").mapInArrow(run, "chunk long, counts binary").collect():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], "<i8")
    return out


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """The place of each bucket by the count of its words in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for part in slices(batch):
                np.add.at(counts, bucket_of(words_of(part.column("text"))[3]), 1)
        found = list(chunks(counts))
        yield pa.record_batch({"chunk": pa.array([k for k, _ in found], pa.int64()), "counts": pa.array([c for _, c in found], pa.binary())})

    counts = summed(docs.select("text").mapInArrow(run, "chunk long, counts binary"))
    rank = np.empty(len(counts), np.uint32)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    return rank


def prefix_rows(lines: Lines, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, place and token of each prefix token of the lines at, those that can link."""
    at = at[lines.size[at] >= NUMER]
    n = prefix_length(lines.size[at])
    pos = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), pos, lines.tokens[np.repeat(lines.begin[at], n) + pos]


def slot_hash(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens ^ np.uint64(0xA24BAED4963EE407))


def line_table(docs: DataFrame, ranks: Broadcast) -> DataFrame:
    """(doc_id, line_no, class, signature) of each line; rows with counts: those of prefix tokens by bucket, class is the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = Seen(), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for part in slices(batch):
                lines = Lines(part.column("text"), ranks.value)
                np.add.at(counts, bucket_of(slot_hash(prefix_rows(lines, seen.fresh(lines))[2])), 1)
                ids = part.column("doc_id").fill_null(NULL_ID).to_numpy()
                yield line_batch(ids[lines.doc], lines.number, lines.classes, lines.signature, [None] * len(lines))
        found = list(chunks(counts))
        none = np.zeros(len(found), np.int64)
        yield line_batch(none, none, np.array([k for k, _ in found], np.int64), none, [c for _, c in found])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, line_no long, class long, signature long, counts binary")


def line_batch(doc_id: np.ndarray, line_no: np.ndarray, classes: np.ndarray, signature: np.ndarray, counts: list[bytes | None]) -> pa.RecordBatch:
    columns = {"doc_id": doc_id, "line_no": line_no, "class": classes.view(np.int64), "signature": signature.view(np.int64)}
    return pa.record_batch({**{k: pa.array(v) for k, v in columns.items()}, "counts": pa.array(counts, pa.binary())})


def block_counts(counts: np.ndarray) -> np.ndarray:
    """The blocks that a token of each bucket is cut into: one for each HOT rows, or for each twice the mean of all buckets if that is more."""
    limit = max(HOT, 2 * int(counts.sum()) // len(counts))
    return np.maximum(-(-counts // limit), 1).astype(np.uint32)


def line_sets(docs: DataFrame, ranks: Broadcast, ids: Broadcast, sieve: Broadcast) -> DataFrame:
    """(class, signature, tokens) once a task for classes that the sieve lets through, from rows whose id the other one does; tokens: the set, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            some = batch.filter(pa.array(passes(ids.value, batch.column("id").to_numpy())))
            for part in slices(some):
                lines = Lines(part.column("text"), ranks.value)
                first = seen.fresh(lines)
                at = first[passes(sieve.value, lines.classes.view(np.int64)[first])]
                yield pa.record_batch({
                    "class": pa.array(lines.classes[at].view(np.int64)),
                    "signature": pa.array(lines.signature[at].view(np.int64)),
                    "tokens": pa.array([lines.set_of(k).tobytes() for k in at.tolist()], pa.binary()),
                })

    return docs.select(id_hash(F.col("doc_id")).alias("id"), "text").mapInArrow(run, "class long, signature long, tokens binary")


def id_hash(doc_id: Column) -> Column:
    return F.xxhash64(F.coalesce(doc_id, F.lit(NULL_ID)))


@dataclass
class Rows:
    """Prefix rows; signatures one after another, width words each. part, block: of tokens cut into blocks, else 0."""

    token: np.ndarray
    cls: np.ndarray
    size: np.ndarray
    pos: np.ndarray
    part: np.ndarray
    block: np.ndarray
    signature: np.ndarray  # flat

    KINDS = ("<u8", "<u8", "<u4", "<u4", "<u8", "<u4", "<u8")

    def fields(self) -> tuple[np.ndarray, ...]:
        return self.token, self.cls, self.size, self.pos, self.part, self.block, self.signature

    def __len__(self) -> int:
        return len(self.token)

    def take(self, at: np.ndarray) -> Rows:
        width = width_of(self.size)
        own = width[at]
        words = np.arange(int(own.sum())) + np.repeat((np.cumsum(width) - width)[at] - (np.cumsum(own) - own), own)
        return Rows(*(x[at] for x in self.fields()[:-1]), self.signature[words])

    def cut(self, edges: list[int]) -> Iterator[Rows]:
        """The rows between each two edges."""
        word = np.concatenate([[0], np.cumsum(width_of(self.size))])[edges].tolist()
        for a, b, c, d in zip(edges[:-1], edges[1:], word[:-1], word[1:], strict=True):
            yield Rows(*(x[a:b] for x in self.fields()[:-1]), self.signature[c:d])

    def pack(self) -> bytes:
        return b"".join([np.int64(len(self)).tobytes(), *(np.ascontiguousarray(x.astype(k, copy=False)).tobytes() for x, k in zip(self.fields(), self.KINDS, strict=True))])

    @staticmethod
    def unpack(data: bytes) -> Rows:
        n, at, out = int(np.frombuffer(data, "<i8", 1)[0]), 8, []
        for kind in Rows.KINDS[:-1]:
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        return Rows(*out, np.frombuffer(data, "<u8", -1, at))

    @staticmethod
    def together(parts: list[Rows]) -> Rows:
        return parts[0] if len(parts) == 1 else Rows(*(np.concatenate(x) for x in zip(*(p.fields() for p in parts), strict=True)))


def rows_of(lines: Lines, at: np.ndarray, blocks_of: np.ndarray) -> Rows:
    """The prefix rows of the lines at; those of tokens in several blocks once for each pair of blocks that they are in."""
    line, pos, token = prefix_rows(lines, at)
    blocks = blocks_of[bucket_of(slot_hash(token))].astype(np.int64)
    own = np.zeros(len(line), np.int64)
    part = np.zeros(len(line), np.int64)
    if len(blocks) and int(blocks.max()) > 1:
        own = (mix(lines.classes[line] + np.uint64(5)) % blocks.astype(np.uint64)).astype(np.int64)
        which = np.repeat(np.arange(len(line)), blocks)
        other = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        line, pos, token, own, blocks = line[which], pos[which], token[which], own[which], blocks[which]
        part = np.where(blocks > 1, np.minimum(own, other) * blocks + np.maximum(own, other) + 1, 0)
        # Across two blocks only their members of different blocks meet; within one, all.
        own = np.where(own == other, 0, own + 1)
    size = lines.size[line]
    width = width_of(size)
    ends = np.cumsum(width)
    flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for words in np.unique(width).tolist():
        rows = np.flatnonzero(width == words)
        first, back = np.unique(line[rows], return_inverse=True)
        flat[((ends[rows] - words)[:, None] + np.arange(words)).ravel()] = lines.wide(first, words)[back].ravel()
    return Rows(token, lines.classes[line], size, pos, part, own, flat)


def prefixes(docs: DataFrame, ranks: Broadcast, blocks: Broadcast, slots: int) -> DataFrame:
    """(slot, rows): packed prefix rows of the classes that can link, by slots of tokens and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        held: list[Rows] = []
        n = 0
        for batch in batches:
            for part in slices(batch):
                lines = Lines(part.column("text"), ranks.value)
                held.append(rows_of(lines, seen.fresh(lines), blocks.value))
                n += len(held[-1])
                if n >= PACKED_ROWS:
                    yield packed(Rows.together(held))
                    held, n = [], 0
        if n:
            yield packed(Rows.together(held))

    def packed(rows: Rows) -> pa.RecordBatch:
        slot = (mix(slot_hash(rows.token) + rows.part.astype(np.uint64)) % np.uint64(slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        full, begin = np.unique(slot[order], return_index=True)
        blobs = [part.pack() for part in rows.take(order).cut([*begin.tolist(), len(order)])]
        return pa.record_batch({"slot": pa.array(full.astype(np.int32)), "rows": pa.array(blobs, pa.binary())})

    return docs.select("text").mapInArrow(run, "slot int, rows binary")


class Slot:
    """The rows of a slot in order of (token, part, size), copies of a class once, each with the rows after it whose size is near enough."""

    def __init__(self, rows: Rows):
        width = width_of(rows.size)
        first = np.cumsum(width) - width
        order = self.sorted(rows, rows.signature[first])
        token, part, cls, mark = rows.token[order], rows.part[order], rows.cls[order], rows.signature[first][order]
        new = np.ones(len(order), bool)
        new[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
        keep = new.copy()
        keep[1:] |= (cls[1:] != cls[:-1]) | (mark[1:] != mark[:-1])
        # Rows alone with their token meet none.
        group = np.cumsum(new) - 1
        keep &= (np.bincount(group[keep], minlength=len(new)) > 1)[group]
        order, group = order[keep], group[keep]
        self.token, self.cls, self.block = token[keep], cls[keep], rows.block[order]
        self.size, self.pos = rows.size[order].astype(np.int32), rows.pos[order].astype(np.int32)
        self.width, self.first, self.signature = width[order], first[order], rows.signature
        self.group = np.cumsum(np.diff(group, prepend=-1) > 0) - 1 if len(group) else group
        place = (self.group << 32) | self.size
        most = (self.group << 32) | (self.size.astype(np.int64) * DENOM // NUMER)
        self.reach = np.searchsorted(place, most, "right") - np.arange(len(order)) - 1

    @staticmethod
    def sorted(rows: Rows, mark: np.ndarray) -> np.ndarray:
        """By token, part and size, copies side by side; tokens without parts take two plain sorts."""
        if rows.part.any() or (len(rows) and int(rows.size.max()) >> 20) or len(rows) >> 23:
            return np.lexsort((mark, rows.cls, rows.size, rows.part, rows.token))
        order = np.argsort(rows.token)
        token = rows.token[order]
        number = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) if len(order) else order
        fine = (number.astype(np.uint64) << np.uint64(40)) | (rows.size[order].astype(np.uint64) << np.uint64(20)) | (rows.cls[order] >> np.uint64(44))
        return order[np.argsort(fine)]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Rows x, y of pairs that can link, some millions of pairs at a time, and the first group that may have more of them."""
        total = np.cumsum(self.reach)
        edges = np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, PAIRS)).tolist() + [len(total)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            reach = self.reach[low:high]
            x = np.repeat(np.arange(low, high), reach)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(reach) - reach, reach)
            for s in range(0, len(x), 4 * PAIRS):
                end = s + 4 * PAIRS
                after = x[end] if end < len(x) else high
                yield *self.passing(x[s:end], y[s:end]), int(self.group[after]) if after < len(self.group) else len(self.group)

    def passing(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those that can link by position, block, and the bits that their signatures differ in."""
        n, m, p, q = self.size[x], self.size[y], self.pos[x], self.pos[y]
        need = needed(n, m)
        good = np.minimum(p, q) + np.minimum(n - p, m - q) >= need
        if self.block.any():
            good &= (self.block[x] == 0) | (self.block[x] != self.block[y])
        at = np.flatnonzero(good)
        x, y, most = x[at], y[at], (n + m - 2 * need)[at]
        # A wider signature folds to a narrower one: the parts of equal places are put together.
        words = np.minimum(self.width[x], self.width[y])
        fine = np.zeros(len(x), bool)
        for w in np.unique(words).tolist():
            at = np.flatnonzero(words == w)
            fine[at] = np.bitwise_count(self.folded(x[at], w) ^ self.folded(y[at], w)).sum(1, dtype=np.int32) <= most[at]
        return x[fine], y[fine]

    def folded(self, at: np.ndarray, words: int) -> np.ndarray:
        first, own = self.first[at], self.width[at]
        out = self.signature[first[:, None] + np.arange(words)]
        for k in range(1, int(own.max()) // words):
            more = np.flatnonzero(own > k * words)
            out[more] ^= self.signature[first[more][:, None] + np.arange(k * words, (k + 1) * words)]
        return out


CANDIDATE = "u long, v long, token long, n int, block int"


def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CANDIDATE rows of a slot: pairs of classes (n 0) that can link, u < v; or members u of a dense group (n members, v the group's name)."""
    blobs: dict[int, list[Rows]] = {}
    for batch in batches:
        for slot, data in zip(batch.column("slot").to_pylist(), batch.column("rows").to_pylist(), strict=True):
            blobs.setdefault(slot, []).append(Rows.unpack(data))
    for slot in list(blobs):
        yield from slot_candidates(Rows.together(blobs.pop(slot)))


def slot_candidates(rows: Rows) -> Iterator[pa.RecordBatch]:
    """Group after group: pairs stand in the rows' order, so a group is decided as soon as all of its pairs are known.

    No more pairs are held than a portion's, and those of the one group under way; once
    a group has over PAIRS and is dense, its pairs are let go and only its members are marked.
    """
    slot = Slot(rows)
    none = np.zeros(0, np.int64)
    x, y = none, none
    marked = np.zeros(len(slot.group), bool)  # members of the group under way, where it is dense for certain
    open_dense = -1
    for more_x, more_y, upto in slot.pairs():
        own = slot.group[more_x]
        if open_dense >= 0:
            inside = own == open_dense
            marked[more_x[inside]] = marked[more_y[inside]] = True
            more_x, more_y = more_x[~inside], more_y[~inside]
            if upto > open_dense:
                yield from dense_members(slot, np.flatnonzero(marked))
                marked[:], open_dense = False, -1
        x, y = np.concatenate([x, more_x]), np.concatenate([y, more_y])
        done = slot.group[x] < upto
        yield from decided(slot, x[done], y[done])
        x, y = x[~done], y[~done]
        if len(x) > PAIRS and len(x) > DENSE * len(np.unique(np.concatenate([x, y]))):
            # One group alone is under way. More pairs make it no less dense than its members do; either form is right.
            open_dense = int(slot.group[x[0]])
            marked[x] = marked[y] = True
            x, y = none, none
    if open_dense >= 0:
        yield from dense_members(slot, np.flatnonzero(marked))
    yield from decided(slot, x, y)


def decided(slot: Slot, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A dense group's members go on, of the others their pairs. Different classes of one hash are both verified."""
    if not len(x):
        return
    members = np.unique(np.concatenate([x, y]))
    first = int(slot.group[x].min())
    groups = int(slot.group[x].max()) + 1 - first
    dense = np.bincount(slot.group[x] - first, minlength=groups) > DENSE * np.bincount(slot.group[members] - first, minlength=groups)
    loose = ~dense[slot.group[x] - first]
    x, y = x[loose], y[loose]
    u, v = slot.cls[x], slot.cls[y]
    yield candidate_batch(np.minimum(u, v), np.maximum(u, v), slot.token[x], np.zeros(len(x), np.int64))
    yield from dense_members(slot, members[dense[slot.group[members] - first]])


def dense_members(slot: Slot, inside: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(inside):
        return
    inside = inside[np.lexsort((slot.cls[inside], slot.group[inside]))]
    g, cls = slot.group[inside], slot.cls[inside]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    n = np.diff(np.append(start, len(g)))
    # Equal groups of several tokens are one, of the first of the tokens. A block of a pair of blocks marks its members.
    mixed = mix(cls * np.uint64(3) + slot.block[inside].astype(np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    name = mix((total[start + n] - total[start]) ^ n.astype(np.uint64))
    yield candidate_batch(cls, np.repeat(name, n), slot.token[inside], np.repeat(n, n), slot.block[inside])


def candidate_batch(u: np.ndarray, v: np.ndarray, token: np.ndarray, n: np.ndarray, block: np.ndarray | None = None) -> pa.RecordBatch:
    # Tokens keep their order as signed numbers.
    signed = (token ^ np.uint64(1 << 63)).view(np.int64)
    block = np.zeros(len(u), np.int64) if block is None else block
    return pa.record_batch({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64)), "token": pa.array(signed), "n": pa.array(n.astype(np.int32)), "block": pa.array(block.astype(np.int32))})


LINKS = "class long, signature long, links long, near_doc long, near_line long"


def link_batch(links: dict[tuple[int, int], list]) -> pa.RecordBatch:
    kinds = {"class": [c for c, _ in links], "signature": [s for _, s in links], "links": [e[0] for e in links.values()], "near_doc": [e[1][0] for e in links.values()], "near_line": [e[1][1] for e in links.values()]}
    return pa.record_batch({k: pa.array(v, pa.int64()) for k, v in kinds.items()})


def token_of(signed: int) -> int:
    return (signed + (1 << 63)) & ((1 << 64) - 1)


def verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """LINKS from pairs with both sets, those whose first shared token is the one they were found at."""
    for batch in batches:
        rows = {k: batch.column(k).to_pylist() for k in batch.schema.names}
        links: dict[tuple[int, int], list] = {}
        for k, token in enumerate(rows["token"]):
            p, q = (rows["u"][k], rows["u_signature"][k]), (rows["v"][k], rows["v_signature"][k])
            if p[0] == q[0] and p[1] >= q[1]:
                continue
            a, b = (frozenset(np.frombuffer(rows[side][k], np.uint64).tolist()) for side in ("u_tokens", "v_tokens"))
            both = a & b
            if (NUMER + DENOM) * len(both) < NUMER * (len(a) + len(b)) or min(both) != token_of(token):
                continue
            for own, at in ((p, (rows["v_doc"][k], rows["v_line"][k])), (q, (rows["u_doc"][k], rows["u_line"][k]))):
                e = links.setdefault(own, [0, at])
                e[0] += 1
                e[1] = min(e[1], at)
        yield link_batch(links)


def by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of a group each, from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column(key).to_numpy()
        edge = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if held and held[-1].column(key)[0] != batch.column(key)[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


#: Rows of a strip, and tokens of one matrix product; both are fewer in groups of over MATRIX / COLUMNS members, so that no matrix has over MATRIX numbers.
STRIP, COLUMNS, MATRIX = 1024, 2048, 1 << 25


def verify_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """LINKS from members with their sets, sorted by group: pairs whose first shared token is the group's."""
    for table in by_group(batches, "group"):
        table = table.sort_by([("doc_id", "ascending"), ("line_no", "ascending")])
        got = group_links(table)
        if got is not None:
            yield got


def group_links(table: pa.Table) -> pa.RecordBatch | None:
    """Members in order of their places, so the first linked one is the earliest."""
    sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
    size, block = np.array([len(x) for x in sets]), table.column("block").to_numpy()
    owner = np.repeat(np.arange(len(sets)), size)
    tokens, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Tokens of one member alone are shared by none.
    shared = count > 1
    place = np.cumsum(shared) - 1
    inside = shared[column]
    owner, column = owner[inside], place[column[inside]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = int(shared.sum())
    before = int(np.searchsorted(tokens[shared], np.uint64(token_of(table.column("token")[0].as_py()))))
    n, links, near = len(sets), np.zeros(len(sets), np.int64), np.full(len(sets), -1)
    strip, columns = (max(1, min(most, MATRIX // n)) for most in (STRIP, COLUMNS))
    for low in range(0, n, strip):
        high = min(low + strip, n)
        overlap, earlier = np.zeros((high - low, n), np.float32), np.zeros((high - low, n), bool)
        edges = sorted({*range(0, width, columns), before, width})
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at = slice(*np.searchsorted(column, (a, b)).tolist())
            matrix = np.zeros((n, b - a), np.float32)
            matrix[owner[at], column[at] - a] = 1
            product = matrix[low:high] @ matrix.T
            overlap += product
            if b <= before:
                earlier |= product > 0
        linked = ((NUMER + DENOM) * overlap >= NUMER * (size[low:high, None] + size)) & ~earlier
        linked &= (block[low:high, None] == 0) | (block[low:high, None] != block)
        linked[np.arange(high - low), np.arange(low, high)] = False
        links[low:high] = linked.sum(1)
        near[low:high] = np.where(links[low:high] > 0, linked.argmax(1), -1)
    at = np.flatnonzero(links)
    if not len(at):
        return None
    rows, first = table.take(pa.array(at)), table.take(pa.array(near[at]))
    return pa.record_batch({
        "class": rows.column("class").combine_chunks(), "signature": rows.column("signature").combine_chunks(), "links": pa.array(links[at]),
        "near_doc": first.column("doc_id").combine_chunks(), "near_line": first.column("line_no").combine_chunks(),
    })


def position() -> Column:
    return F.struct("doc_id", "line_no")


def candidate_table(spark: SparkSession, docs: DataFrame, ranks: Broadcast, counts: np.ndarray) -> DataFrame:
    """CANDIDATE rows, each pair and each member of an equal group once, with the first token that it was found at."""
    cut = block_counts(counts)
    blocks = spark.sparkContext.broadcast(cut)
    # A token's rows come once for each of its blocks.
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int((counts * cut.astype(np.int64)).sum()) // SLOT_ROWS + 1)
    met = prefixes(docs, ranks, blocks, slots).repartitionById(slots, "slot")
    found = met.mapInArrow(candidates, CANDIDATE).groupBy("u", "v", "n", "block").agg(F.min("token").alias("token"))
    return materialize(spark, found, "line-candidates")


def line_links(spark: SparkSession, found: DataFrame, sets: DataFrame) -> DataFrame:
    """(class, signature, links, near) from CANDIDATE rows and (class, signature, tokens, doc_id, line_no) of their classes."""
    side = lambda x: sets.select(F.col("class").alias(x), *(F.col(c).alias(f"{x}_{t}") for c, t in (("signature", "signature"), ("tokens", "tokens"), ("doc_id", "doc"), ("line_no", "line"))))
    pairs = found.where("n = 0").select("u", "v", "token").join(side("u"), "u").join(side("v"), "v")
    members = found.where("n > 0").select(F.col("u").alias("class"), F.col("v").alias("group"), "token", "block").join(sets, "class")
    dense = members.repartition("group").sortWithinPartitions("group").mapInArrow(verify_groups, LINKS)
    every = pairs.mapInArrow(verify_pairs, LINKS).unionByName(dense)
    return every.groupBy("class", "signature").agg(F.sum("links").alias("links"), F.min(F.struct(F.col("near_doc").alias("doc_id"), F.col("near_line").alias("line_no"))).alias("near"))


def line_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, line_no, class_doc, class_line, copies, links, removed for each line with a word; class_id, class_mark: the class's hashes."""
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(rarity_ranks(docs))
    table = materialize(spark, line_table(docs, ranks), "lines")
    lines = table.where("counts is null").drop("counts")
    counts = summed(table.where("counts is not null").select(F.col("class").alias("chunk"), "counts"))
    found = candidate_table(spark, docs, ranks, counts)
    key = ["class", "signature"]
    classes = materialize(spark, lines.groupBy(*key).agg(F.min(position()).alias("first"), F.count("*").alias("copies")), "line-classes")
    met = found.select(F.explode(F.when(F.col("n") == 0, F.array("u", "v")).otherwise(F.array("u"))).alias("class")).distinct()
    # The sets of candidates are read from the documents that have their first lines.
    met = materialize(spark, met.join(classes, "class").select(*key, "first.doc_id", "first.line_no"), "line-members")
    n = met.count()
    sieve = spark.sparkContext.broadcast(sieve_of(met, "class", n))
    ids = spark.sparkContext.broadcast(sieve_of(met.select(id_hash(F.col("doc_id")).alias("id")).distinct(), "id", n))
    sets = line_sets(docs, ranks, ids, sieve).groupBy(*key).agg(F.first("tokens").alias("tokens"))
    sets = materialize(spark, sets.join(met, key).select(*key, "tokens", "doc_id", "line_no"), "line-sets")
    links = line_links(spark, found, sets)
    judged = classes.join(links, key, "left").select(*key, "first", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce(F.col("near") < F.col("first"), F.lit(False)).alias("late"))
    judged = materialize(spark, judged, "line-links")
    removed = (position() > F.col("first")) | F.col("late")
    named = F.when(F.col("first.doc_id") != NULL_ID, F.col("first.doc_id"))
    out = join_facts(lines, judged, key, "copies", lines.count())
    return out.select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "line_no", named.alias("class_doc"), F.col("first.line_no").alias("class_line"), "copies", "links", removed.alias("removed"), F.col("class").alias("class_id"), F.col("signature").alias("class_mark"))


def dedup_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with the removed lines taken out of text.

    A line goes where its number and its words are those of a removed line of
    its doc_id, so rows that share an id, or have none, lose only their own lines.
    """
    small_batches(spark)
    id_, gone_, number = (unused(n, docs.columns) for n in ("_doc", "_gone", "_numbers"))
    gone = line_classes(spark, docs).where("removed").groupBy(F.col("doc_id").alias(id_)).agg(F.collect_set(F.struct("line_no", "class_id", "class_mark")).alias(gone_))
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone[id_]), "left").drop(id_)
    none = np.arange(1 << BUCKET_BITS, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                lines = Lines(part.column("text"), none)
                rows: list[list[int]] = [[] for _ in range(part.num_rows)]
                known = [{(x["line_no"], x["class_id"], x["class_mark"]) for x in r} if r else () for r in part.column(gone_).to_pylist()]
                if any(known):
                    for d, k, c, m in zip(lines.doc.tolist(), lines.number.tolist(), lines.classes.view(np.int64).tolist(), lines.signature.view(np.int64).tolist(), strict=True):
                        if (k, c, m) in known[d]:
                            rows[d].append(k)
                yield part.drop_columns([gone_]).append_column(number, pa.array(rows, pa.list_(pa.int64())))

    marked = joined.mapInArrow(run, docs.withColumn(number, F.array().cast("array<bigint>")).schema)
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, k: F.when(~F.array_contains(number, k.cast("bigint")), x)), lambda x: x.isNotNull())
    return marked.withColumn("text", F.when(F.size(number) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class is named by the place of its first line."""
    return line_classes(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("class_id", "class_mark")
