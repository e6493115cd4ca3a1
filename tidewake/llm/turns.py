"""Rows of conversations in order, spread over tasks whatever the size of a conversation.

Rows are dealt out by ranges of (conv_id, turn, role, text), so a conversation of any
size is spread over as many tasks as its share of the rows asks for. A conversation that
lies within a task, and has at most WHOLE_ROWS rows and WHOLE_BYTES of text, is whole there and
needs no other shuffle. The others, at most two a task unless they are large, are left to
a second pass over their rows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHOLE_ROWS, WHOLE_BYTES = 4096, 8 << 20
#: Characters of a text by which rows of one turn and role are ordered before a hash of the text.
PREFIX = 64


class Turn(NamedTuple):
    conv_id: int | None
    turn: int | None
    role: str | None
    text: str | None
    gone: bool


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone (false unless rows has it), by conv_id, turn, role (nulls first), then by the text's first PREFIX characters and a hash of it all.

    What is left are equal rows, dealt out by a number of their own.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), gone.alias("gone"))
    keys = {"k1": F.substring("text", 1, PREFIX), "k2": F.xxhash64("text"), "k3": F.monotonically_increasing_id()}
    order = ["conv_id", "turn", "role", *keys]
    return rows.withColumns(keys).repartitionByRange(*order).sortWithinPartitions(*order).drop(*keys)


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, int, list[Turn]]]:
    """Runs of sorted rows as (whole, place of the first row, rows): whole conversations, or pieces of others, in order.

    Places count the rows of all tasks in their order, with gaps between tasks. The first and the
    last conversation of a task may go on elsewhere, so they are never whole.
    """
    place = TaskContext.get().partitionId() << 40
    held: list[Turn] = []
    size, whole = 0, False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in Turn._fields), strict=True):
            turn = Turn(*row)
            if held and held[0].conv_id != turn.conv_id:
                yield whole, place, held
                place += len(held)
                held, size, whole = [], 0, True
            elif len(held) >= WHOLE_ROWS or size >= WHOLE_BYTES:
                yield False, place, held
                place += len(held)
                held, size, whole = [], 0, False
            held.append(turn)
            size += len(turn.text or "") + len(turn.role or "")
    if held:
        yield False, place, held


def by_conversation(batches: Iterator[pa.RecordBatch], fold: Callable[[Any, dict], Any], end: Callable[[Any, Any], Any]) -> Iterator:
    """end(conv_id, state) of each conversation of rows sorted by conv_id; fold(state, row) takes its rows one after another, state None at first."""
    key = state = None
    begun = False
    for batch in batches:
        for row in batch.to_pylist():
            if begun and row["conv_id"] != key:
                yield end(key, state)
                state = None
            key, begun = row["conv_id"], True
            state = fold(state, row)
    if begun:
        yield end(key, state)


#: Rows and about as many characters in a batch that packed() makes.
BATCH_ROWS, BATCH_CHARS = 500, 4 << 20


def packed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows, some at a time; a row is a tuple in the order of schema."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, list)))
        if len(held) >= BATCH_ROWS or size >= BATCH_CHARS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
