"""Repair of the structure of conversations by cheapest edits.

The rows of a conversation, in order, are to give role initials `(s?(ua)+)?`. Each row is
kept (0), given the role user or assistant (1) or deleted (2, the only way for a blank row or one
that repeats an earlier one); a row without text, user or assistant, may be inserted anywhere (5); a row that ends
without a mark and stays adds 5. The states of the grammar between rows are the nodes of a
graph, edits its arcs. Costs are small integers, so Dial's queue, a ring of as many
buckets as the dearest arc is long and one, settles the distances of all nodes to the end; from the
start, the least letter among tight arcs (those that keep to the distance) is walked again and
again: the cheapest audit, and of equals the least in ASCII.

A conversation that lies within a task is repaired there. One that is spread over
tasks, however large, is cut into segments: each, on its own, gets the distance between every state
at its beginning and every state at its end; these small tables are put together from the last
to the first, giving the distances to the end of the conversation at each cut; with them every
segment walks its own arcs, from each state that it may be entered in; from the first to the last
the states are chosen; then each segment writes its part. A task holds one segment, or the small
tables of one conversation (16 numbers for 4,096 rows).

Repaired conversations come as rows of REPAIRED: a row a conversation, or several in order of part.

Defined results: rows come by turn, null first, ties by role (null first), then by the text's first 64 characters
and a hash; a null role or text is one space; a role's initial is its first character, and a row with an empty role is never kept as it is; rows
with a null conv_id are one conversation; a conversation whose rows are all gone is one without rows: zeros, an
empty audit and no turns; repeated rows are duplicates; texts of any length are handled whole; an
empty table gives an empty table. Other columns never matter. The digest of a repaired conversation is one
SHA-256, so its parts pass through one task in order, each forgotten when it is digested.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .shared import materialize, small_batches
from .turns import WHOLE_ROWS, Turn, by_conversation, conversations, in_order, packed

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
DEAREST = REROLE + TRUNCATED
FAR = 1 << 60
#: The grammar's states: nothing yet, a system row, a user row, an assistant row. Where it may end, and what comes next.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (NOTHING, ASSISTANT)
NEXT = ("user", "user", "assistant", "user")
AFTER = {"user": USER, "assistant": ASSISTANT}
LEGAL = {"su", "ua", "au"}
CONTENT, MARK = re.compile(r"[^\x20\x09-\x0D]"), ".!?"

TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("rows", pa.int64()), ("gaps", pa.int64())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    + [("first", pa.string()), ("last", pa.string()), ("audit", pa.string()), ("turns", TURNS)]
)
RAW = pa.schema([("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("gone", pa.bool_())])
DIGEST = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


class Row(NamedTuple):
    """What edits depend on."""

    initial: str
    must_go: bool
    truncated: bool


class Arc(NamedTuple):
    letter: str
    cost: int
    step: int  # rows it takes
    state: int


def arcs(row: Row | None, state: int, insert: bool) -> list[Arc]:
    """From a state before the row (None: at the end), by letter."""
    out = []
    expected = NEXT[state]
    if row is not None:
        out.append(Arc("D", DELETE, 1, state))
    if insert:
        out.append(Arc("I", INSERT, 0, AFTER[expected]))
    if row is not None and not row.must_go:
        more = TRUNCATED if row.truncated else 0
        if row.initial == "s" and state == NOTHING:
            out.append(Arc("K", KEEP + more, 1, SYSTEM))
        elif row.initial == expected[0]:
            out.append(Arc("K", KEEP + more, 1, AFTER[expected]))
        out.append(Arc("R", REROLE + more, 1, AFTER[expected]))
    return out


def distances(rows: list[Row], ends: list[int], last: bool) -> list[int]:
    """Of each node, 4 * row + state, to the end; ends: those of the states after the last row. Rows may be inserted there if last.

    Dial's queue, run backwards: distances are settled in increasing order, and no arc is longer than DEAREST.
    """
    n = len(rows)
    into: list[list[tuple[int, int]]] = [[] for _ in range(4 * n + 4)]
    for i in range(n + 1):
        for g in STATES:
            for arc in arcs(rows[i] if i < n else None, g, i < n or last):
                into[4 * (i + arc.step) + arc.state].append((4 * i + g, arc.cost))
    out = [FAR] * (4 * n + 4)
    # The ends may be far apart: a bucket takes them in when its distance comes.
    waiting = sorted(((d, g) for g, d in enumerate(ends) if d < FAR), reverse=True)
    ring: list[list[int]] = [[] for _ in range(DEAREST + 1)]
    now = waiting[-1][0] if waiting else 0
    open_ = 0
    while open_ or waiting:
        if not open_:
            now = max(now, waiting[-1][0])
        bucket = ring[now % (DEAREST + 1)]
        while waiting and waiting[-1][0] == now:
            bucket.append(4 * n + waiting.pop()[1])
            open_ += 1
        # Arcs of cost zero add to the bucket while it is emptied.
        while bucket:
            node = bucket.pop()
            open_ -= 1
            if out[node] <= now:
                continue
            out[node] = now
            for before, cost in into[node]:
                if out[before] > now + cost:
                    ring[(now + cost) % (DEAREST + 1)].append(before)
                    open_ += 1
        now += 1
    return out


def walk(rows: list[Row], to_end: list[int], state: int, ends: list[int], last: bool) -> tuple[str, int]:
    """The least letters along tight arcs from the state before the first row, and the state after the last."""
    letters, i, n = [], 0, len(rows)
    while True:
        at = to_end[4 * i + state]
        # At the very end, and no way on is shorter than to stop.
        if i == n and ends[state] == at:
            return "".join(letters), state
        arc = next(a for a in arcs(rows[i] if i < n else None, state, i < n or last) if at == a.cost + to_end[4 * (i + a.step) + a.state])
        letters.append(arc.letter)
        i, state = i + arc.step, arc.state


def edited(turns: list[tuple[str, str]], audit: str, state: int) -> list[dict]:
    """The rows that stay, from the state before the first."""
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            out.append({"role": NEXT[state], "text": ""})
        elif letter == "R":
            out.append({"role": NEXT[state], "text": turns[i][1]})
        elif letter == "K":
            out.append({"role": turns[i][0], "text": turns[i][1]})
        if letter != "D":
            state = SYSTEM if letter == "K" and state == NOTHING and turns[i][0][:1] == "s" else AFTER[NEXT[state]]
        i += letter != "I"
    return out


def filled(text: str | None) -> str:
    return " " if text is None else text


def is_blank(text: str) -> bool:
    return CONTENT.search(text) is None


def is_truncated(text: str) -> bool:
    stripped = text.rstrip(" \t\n\v\f\r")
    return not stripped or stripped[-1] not in MARK


def gaps_of(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


class Facts(NamedTuple):
    rows: list[Row]
    blank: int
    duplicate: int
    truncated: int
    illegal: int


def facts(turns: list[tuple[str, str]], repeats: list[bool]) -> Facts:
    rows, counts = [], [0, 0, 0]
    for (role, text), again in zip(turns, repeats, strict=True):
        blank = is_blank(text)
        cut = not blank and not again and is_truncated(text)
        for k, fault in enumerate((blank, not blank and again, cut)):
            counts[k] += fault
        rows.append(Row(role[:1], blank or again, cut))
    return Facts(rows, *counts, sum(a.initial + b.initial not in LEGAL for a, b in zip(rows, rows[1:], strict=False)))


def at_end() -> list[int]:
    return [0 if g in ENDS else FAR for g in STATES]


def repair(conv_id: int | None, part: int, turns: list[Turn]) -> tuple:
    """A whole conversation, as REPAIRED."""
    there = [t for t in turns if not t.gone]
    texts = [(filled(t.role), filled(t.text)) for t in there]
    seen: set[tuple[str, str]] = set()
    repeats = []
    for x in texts:
        repeats.append(x in seen)
        seen.add(x)
    found = facts(texts, repeats)
    to_end = distances(found.rows, at_end(), True)
    audit, _ = walk(found.rows, to_end, NOTHING, at_end(), True)
    ends = (found.rows[0].initial, found.rows[-1].initial) if texts else (None, None)
    return conv_id, part, True, len(texts), gaps_of([t.turn for t in there]), found.blank, found.duplicate, found.truncated, found.illegal, to_end[NOTHING], *ends, audit, edited(texts, audit, NOTHING)


def segment_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows sorted by (conv_id, segment, place), segment after segment."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["conv_id"], held[0]["segment"]) != (row["conv_id"], row["segment"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def per_segment(rows: DataFrame, work: Callable[[list[dict]], tuple], schema: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((work(group) for group in segment_groups(batches)), schema)

    return rows.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place").mapInArrow(run, from_arrow_schema(schema))


def per_conversation(tables: DataFrame, work: Callable[[list[dict]], list[tuple]], schema: pa.Schema) -> DataFrame:
    """work(rows of a conversation's segments, in order) gives rows."""

    def fold(state: list[dict] | None, row: dict) -> list[dict]:
        state = [] if state is None else state
        state.append(row)
        return state

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed((out for rows in by_conversation(batches, fold, lambda key, state: state) for out in work(rows)), schema)

    return tables.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, from_arrow_schema(schema))


ROW = ("conv_id", "segment", "place", "initial", "must_go", "truncated")
SEGMENT = [("conv_id", pa.int64()), ("segment", pa.int64())]
TABLE = pa.schema([*SEGMENT, ("costs", pa.list_(pa.int64()))])
BACK = pa.schema([*SEGMENT, ("ends", pa.list_(pa.int64())), ("last", pa.bool_())])
EXITS = pa.schema([*SEGMENT, ("exits", pa.list_(pa.int64()))])
ENTRY = pa.schema([*SEGMENT, ("entry", pa.int64()), ("head", pa.bool_()), ("before", pa.string())])


def rows_in(group: list[dict]) -> list[Row]:
    return [Row(r["initial"], r["must_go"], r["truncated"]) for r in group]


def costs_between(group: list[dict]) -> tuple:
    """Of a segment: the distance from each state before it to each after it, end by end. Rows inserted after it belong to the next segment."""
    rows = rows_in(group)
    costs = []
    for end in STATES:
        costs += distances(rows, [0 if g == end else FAR for g in STATES], False)[:4]
    return group[0]["conv_id"], group[0]["segment"], costs


def distances_back(tables: list[dict]) -> list[tuple]:
    """Of each segment: the distance of each state after it to the conversation's end. Rows may be inserted at the beginning of the next segment, or at the end."""
    ends, out = at_end(), []
    for k in range(len(tables) - 1, -1, -1):
        t = tables[k]
        out.append((t["conv_id"], t["segment"], ends, k == len(tables) - 1))
        # The last segment's end states may be reached by inserting rows.
        if k == len(tables) - 1:
            ends = distances([], ends, True)
        costs = t["costs"]
        ends = [min(min(costs[4 * e + g] + ends[e] for e in STATES), FAR) for g in STATES]
    return out[::-1]


def exits_of(group: list[dict]) -> tuple:
    """Of a segment: the state that each state before it leads to."""
    rows, ends, last = rows_in(group), group[0]["ends"], group[0]["last"]
    to_end = distances(rows, ends, last)
    return group[0]["conv_id"], group[0]["segment"], [walk(rows, to_end, g, ends, last)[1] if to_end[g] < FAR else -1 for g in STATES]


def entries(tables: list[dict]) -> list[tuple]:
    state, out, before = NOTHING, [], None
    for k, t in enumerate(tables):
        out.append((t["conv_id"], t["segment"], state, k == 0, before))
        state, before = t["exits"][state], t["final"]
    return out


def write_segment(group: list[dict]) -> tuple:
    head = group[0]
    rows, texts = rows_in(group), [(r["role"], r["text"]) for r in group]
    to_end = distances(rows, head["ends"], head["last"])
    audit, _ = walk(rows, to_end, head["entry"], head["ends"], head["last"])
    blank = [is_blank(t) for _, t in texts]
    counts = sum(blank), sum(r.must_go for r in rows) - sum(blank), sum(r.truncated for r in rows)
    initials = ([] if head["head"] else [head["before"]]) + [r.initial for r in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    cost = to_end[head["entry"]] if head["head"] else 0
    return head["conv_id"], head["segment"], False, len(rows), 0, *counts, illegal, cost, rows[0].initial, rows[-1].initial, audit, edited(texts, audit, head["entry"])


def with_segment(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """rows with the columns of their segment's row in table."""
    own = table.withColumnsRenamed({"conv_id": "own_conv", "segment": "own_segment"})
    return rows.join(own, F.col("conv_id").eqNullSafe(F.col("own_conv")) & (F.col("segment") == F.col("own_segment")), how).drop("own_conv", "own_segment")


def repair_spread(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """REPAIRED, a row a segment, of conversations that no task has whole: raw (conv_id, place, turn, role, text, gone)."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    there = raw.where("not gone").select("conv_id", "place", "turn", role.alias("role"), text.alias("text"), F.shiftright("place", WHOLE_ROWS.bit_length() - 1).alias("segment"))
    # The first row of each role and text; groups of equal rows are counted down before they meet.
    first = there.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    blank = ~F.col("text").rlike(CONTENT.pattern)
    again = F.col("first").isNull()
    cut = ~blank & ~again & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = there.join(first, "place", "left").select("conv_id", "segment", "place", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), (blank | again).alias("must_go"), cut.alias("truncated"))
    marked = materialize(spark, marked, "spread-rows")
    rows = marked.select(*ROW)
    # What follows is small: a few numbers a segment.
    back = materialize(spark, per_conversation(per_segment(rows, costs_between, TABLE), distances_back, BACK), "segment-distances")
    final = marked.groupBy("conv_id", "segment").agg(F.max_by("initial", "place").alias("final"))
    exits = per_segment(with_segment(rows, back), exits_of, EXITS)
    entry = materialize(spark, per_conversation(with_segment(exits, final), entries, ENTRY), "segment-entries")
    written = per_segment(with_segment(with_segment(marked, back), entry), write_segment, REPAIRED)
    # Turns are counted over all of a conversation; conversations without rows get one empty part.
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    known = raw.groupBy("conv_id").agg(F.count(F.when(~F.col("gone"), 1)).alias("there"))
    gaps = there.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).alias("span"), F.min("segment").alias("segment"))
    head = with_segment(written.withColumnRenamed("part", "segment").drop("gaps"), gaps, "left").withColumnsRenamed({"segment": "part", "span": "gaps"})
    gone = known.where("there = 0").select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(True).alias("whole"), *(F.lit(0).cast("long").alias(c) for c in ("rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("last"), F.lit("").alias("audit"), F.array().cast("array<struct<role:string,text:string>>").alias("turns"))
    return head.withColumn("gaps", F.coalesce("gaps", F.lit(0))).select(*REPAIRED.names).unionByName(gone)


def repair_conversations(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """REPAIRED for conversations (conv_id, turn, role, text; gone: rows that only tell that the conversation is there)."""
    small_batches(spark)
    both = pa.schema([*REPAIRED, *RAW])
    no_result, no_row = (None,) * (len(REPAIRED) - 1), (None,) * len(RAW)

    def rows_of(runs: Iterator[tuple[bool, int, list[Turn]]]) -> Iterator[tuple]:
        for whole, place, turns in runs:
            if whole:
                yield *repair(turns[0].conv_id, place, turns), *no_row
            else:
                for k, t in enumerate(turns):
                    yield t.conv_id, *no_result, place + k, t.turn, t.role, t.text, t.gone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(rows_of(conversations(batches)), both)

    stored = materialize(spark, in_order(rows).mapInArrow(run, from_arrow_schema(both)), "repaired")
    whole = stored.where("place is null").select(*REPAIRED.names)
    return whole.unionByName(repair_spread(spark, stored.where("place is not null").select("conv_id", *RAW.names)))


class Reading:
    """Counts and digest of a conversation's parts, in order."""

    def __init__(self) -> None:
        self.counts = [0] * 6
        self.audit: list[str] = []
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        self.counts = [a + row[c] for a, c in zip(self.counts, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), strict=True)]
        self.audit.append(row["audit"])
        for turn in row["turns"]:
            self.sha.update(f"{chr(10) if self.begun else ''}{turn['role']}:{turn['text']}".encode())
            self.begun = True


def digests(repaired: DataFrame) -> DataFrame:
    """DIGEST of each conversation of a stored table of REPAIRED."""

    def fold(state: Reading | None, row: dict) -> Reading:
        state = state or Reading()
        state.add(row)
        return state

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return packed(by_conversation(batches, fold, lambda key, s: (key, *s.counts, "".join(s.audit), s.sha.hexdigest())), DIGEST)

    kind = from_arrow_schema(DIGEST)
    alone = repaired.where("whole").mapInArrow(read, kind)
    parts = repaired.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(read, kind)
    return alone.unionByName(parts)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults by crc32(conv_id:turn) % 20, nulls one space: 0 gone, 1 without text, 2 without marks, 3 twice, 4 of role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(space("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), copies.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return digests(materialize(spark, repair_conversations(spark, damaged(rows)), "repaired-conversations"))
