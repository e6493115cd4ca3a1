"""NMEA 2000 frames to samples, by a table of parameter group layouts.

Layouts are rows of a small table that is broadcast and joined by group. A payload is
an array of 64-bit words, lowest bit first, and one expression reads any bits from
it: a first bit and a width that the joined row gives. Texts of variable length
move what comes after them, and sets of values repeat; both are places that the same
expression takes as its first bit.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures
from ..functions.bits import bits_at, can_fields, can_identifier, can_payload, payload_words, signed
from . import fast_packet
from .fast_packet import reassemble
from .layouts import CELSIUS, DEG, KN, LAYOUTS, MARINE, VENDOR_GROUP, VENDOR_KEYS, VENDOR_MAKER, Code, Number, Split

FAST = tuple(sorted({p for p, layout in LAYOUTS.items() if layout.fast} | {VENDOR_GROUP}))
SINGLE = tuple(sorted(set(LAYOUTS) - set(FAST)))

PAIR = "array<struct<field:string,value:double>>"
#: The names by which angles off the bow are known, and a clock of the satellites.
OFF_THE_BOW, SATELLITES = ("apparent", "true_boat_referenced"), "gps"


def sanitized(text: Column) -> Column:
    """Lower case, other than a-z and 0-9 as single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def clean(text: str) -> str:
    return re.sub("[^a-z0-9]+", "_", text.lower()).strip("_")


SPLIT = "struct<first:int,width:int,texts:map<int,string>>"
LAYOUT = f"pgn int, base string, kind string, first int, width int, signed boolean, scale double, unit string, fold boolean, known int, second int, only string, after int, gaps array<int>, s1 {SPLIT}, s2 {SPLIT}"
SETS = "pgn int, base string, first int, width int, signed boolean, scale double, unit string, after int, gaps array<int>, start int, bits int, count int, count_width int, texts array<int>"
NO_CODE = -1


def split_rows(splits: tuple[Split, ...]) -> tuple:
    """The first two discriminators, by key."""
    rows = [(8 * s.offset + s.shift, s.width, {k: clean(t) for k, t in s.texts}) for s in sorted(splits, key=lambda s: s.key)]
    return (*rows, None, None)[:2]


def number_row(v: Number) -> tuple:
    return v.first, v.width, v.signed, v.scale, v.unit


def layout_rows() -> list[tuple]:
    """LAYOUTS as rows of LAYOUT: a row a value."""
    out = []
    for pgn, layout in LAYOUTS.items():
        tail, gaps = split_rows(layout.splits), [8 * g for g in layout.texts]
        for v in layout.values:
            if isinstance(v, Code):
                out.append((pgn, f"n2k_{v.name}_code".lower(), "code", 8 * v.offset + v.shift, v.width, False, 1.0, None, False, v.known, 0, None, 0, gaps, *tail))
            else:
                out.append((pgn, f"n2k_{v.name}".lower(), "number", *number_row(v), v.fold, NO_CODE, 0, None, v.after, gaps, *tail))
        if layout.clock:
            only = SATELLITES if layout.splits else None  # a clock whose source is not the satellites is no GPS time
            out.append((pgn, "n2k_gps_time", "clock", 8 * layout.clock[0], 16, False, 1.0, None, False, NO_CODE, 8 * layout.clock[1], only, 0, gaps, *tail))
    out.append((VENDOR_GROUP, "", "vendor", 0, 8, False, 1.0, None, False, NO_CODE, 0, None, 0, [], None, None))
    return out


def set_rows() -> list[tuple]:
    """The values that repeat, as rows of SETS."""
    out = []
    for pgn, layout in LAYOUTS.items():
        if s := layout.sets:
            for v in s.values:
                out.append((pgn, f"n2k_{v.name}".lower(), *number_row(v), v.after, [8 * g for g in layout.texts], 8 * s.start, s.bits, 8 * s.count[0], s.count[1], [8 * g for g in s.texts]))
    return out


def past_texts(start: str, gaps: str) -> str:
    """SQL of the bit behind as many texts as there are gaps, from start on; the byte a text begins with has its length, itself included. Null where the payload ends before."""
    # At least the two bytes that any text has, so that what is no text ends somewhere.
    return f"aggregate({gaps}, CAST({start} AS INT), (at, gap) -> at + gap + CAST(greatest({bits_at('_words', 'at + gap', '8')}, 2) AS INT) * 8)"


def split_text(split: str) -> str:
    """SQL of the discriminator's text; its number where it has no texts, null where all bits are ones, or for an unknown number."""
    first, width, texts = (f"{split}.{x}" for x in ("first", "width", "texts"))
    code = f"CAST(CASE WHEN {first} + {width} <= _size THEN {bits_at('_words', first, width)} END AS INT)"
    return f"CASE WHEN size({texts}) > 0 THEN try_element_at({texts}, {code}) WHEN {code} <> shiftleft(1, {width}) - 1 THEN CAST({code} AS STRING) END"


def converted(x: str) -> Column:
    """A number by the unit that it is stored in."""
    v, unit = F.col(x), F.col("unit")
    return F.when(unit == DEG, measures.rad_to_deg(v)).when(unit == KN, measures.ms_to_knots(v)).when(unit == CELSIUS, measures.kelvin_to_celsius(v)).otherwise(v)


#: Not all bits that carry the value are ones: shifted down from 64 ones, since a width of 64 needs no shift.
AVAILABLE = "_raw <> shiftrightunsigned(-1L, 64 - width + CAST(signed AS INT))"
NUMBER = f"{signed('_raw', 'width', 'signed')} * scale"


def decode_messages(messages: DataFrame) -> DataFrame:
    """messages (pgn, hex payload, other columns) to one row a value: the columns without payload, field, value.

    The vendor's group has a row of its own among the layouts, whose values come as an array.
    """
    layouts = F.broadcast(messages.sparkSession.createDataFrame(layout_rows(), LAYOUT))
    rest = [c for c in messages.columns if c not in ("payload", "field", "value")]
    rows = payload_words(messages, "payload").join(layouts, "pgn")
    rows = rows.selectExpr("*", f"CASE WHEN after > 0 THEN {past_texts('0', 'slice(gaps, 1, after)')} + first ELSE first END AS _first").where("_first + width <= _size")
    ticks = f"CASE WHEN kind = 'clock' AND second + 32 <= _size THEN {bits_at('_words', 'second', '32')} END AS _ticks"
    rows = rows.selectExpr("*", f"{bits_at('_words', '_first', 'width')} AS _raw", ticks, f"{split_text('s1')} AS _t1", f"{split_text('s2')} AS _t2")
    # What is not available goes by its raw number: a filter on the finished value would be
    # pushed through the steps below and unfold them.
    clock = "((only IS NULL OR coalesce(_t1 = only, false)) AND _raw <> 65535 AND _ticks <> 4294967295)"
    there = rows.where(f"CASE kind WHEN 'number' THEN {AVAILABLE} WHEN 'code' THEN _raw <= known WHEN 'clock' THEN {clock} ELSE true END")
    plain = there.selectExpr("*", f"CASE kind WHEN 'number' THEN {NUMBER} WHEN 'code' THEN CAST(_raw AS DOUBLE) ELSE round(_raw * 86400 + _ticks / 10000, 6) END AS _x").withColumn("_y", converted("_x"))
    bow = ", ".join(f"'{x}'" for x in OFF_THE_BOW)
    folded = f"CASE WHEN fold AND _t1 IN ({bow}) AND _y > 180 THEN _y - 360 ELSE _y END AS _value"
    named = plain.selectExpr(*rest, "kind", "concat_ws('_', base, _t1, _t2) AS _name", folded, f"explode_outer(CASE WHEN kind = 'vendor' THEN {VENDOR_VALUES} END) AS _v")
    own = "kind = 'vendor'"
    return named.where(f"NOT {own} OR _v IS NOT NULL").selectExpr(*rest, f"CASE WHEN {own} THEN _v.field ELSE _name END AS field", f"CASE WHEN {own} THEN _v.value ELSE _value END AS value")


def decode_sets(messages: DataFrame) -> DataFrame:
    """messages (pgn, hex payload, other columns) to one row a value of a set that repeats: the columns without payload, set (from 1), field, value.

    A set that the payload does not hold whole is left out, whatever the count says.
    """
    sets = F.broadcast(messages.sparkSession.createDataFrame(set_rows(), SETS))
    rest = [c for c in messages.columns if c not in ("payload", "set", "field", "value")]
    rows = payload_words(messages, "payload").join(sets, "pgn").where("count + count_width <= _size")
    begin = f"CASE WHEN size(gaps) > 0 THEN {past_texts('0', 'gaps')} ELSE 0 END + start"
    # No more sets than there are bits for.
    rows = rows.selectExpr("*", f"CAST({begin} AS INT) AS _begin", f"CAST(least({bits_at('_words', 'count', 'count_width')}, _size div bits) AS INT) AS _count").where("_count > 0")
    step = f"CAST({past_texts('element_at(places, -1)', 'texts')} + bits - aggregate(texts, 0, (a, g) -> a + g) AS INT)"
    moving = f"aggregate(sequence(1, _count), array(_begin), (places, k) -> concat(places, array({step})))"
    even = "transform(sequence(0, _count - 1), k -> _begin + k * bits)"
    rows = rows.selectExpr("*", f"posexplode(slice(CASE WHEN size(texts) > 0 THEN {moving} ELSE {even} END, 1, _count)) AS (_set, _at)")
    rows = rows.selectExpr("*", f"CASE WHEN after > 0 THEN {past_texts('_at', 'slice(texts, 1, after)')} ELSE _at END + first AS _first").where("_first + width <= _size")
    rows = rows.selectExpr("*", f"{bits_at('_words', '_first', 'width')} AS _raw").where(AVAILABLE).selectExpr("*", f"{NUMBER} AS _x")
    return rows.select(*rest, (F.col("_set") + 1).alias("set"), F.col("base").alias("field"), converted("_x").alias("value"))


def vendor_values(payload: str) -> str:
    """SQL of the entries of 12-bit key and 4-bit length after the maker's header; each known key's first two bytes, signed."""
    at = lambda place: f"CAST(conv(nullif(concat(substring({payload}, ({place}) * 2 + 3, 2), substring({payload}, ({place}) * 2 + 1, 2)), ''), 16, 10) AS INT)"
    header = at("0")
    own = f"length({payload}) >= 4 AND {header} & 2047 = {VENDOR_MAKER} AND shiftright({header}, 13) = {MARINE}"
    # Entry after entry: where the next one is, past the end once one is not whole.
    head, size = at("acc.at"), f"shiftright({at('acc.at')}, 12)"
    whole = f"length({payload}) >= (acc.at + 2) * 2 AND length({payload}) >= (acc.at + 2 + {size}) * 2"
    entry = f"named_struct('key', {head} & 4095, 'value', CASE WHEN {size} >= 2 THEN {at('acc.at + 2')} END)"
    none = "CAST(array() AS ARRAY<STRUCT<key: INT, value: INT>>)"
    step = f"named_struct('at', CASE WHEN {whole} THEN acc.at + 2 + {size} ELSE 1048576 END, 'found', CASE WHEN {whole} THEN concat(acc.found, CAST(array({entry}) AS ARRAY<STRUCT<key: INT, value: INT>>)) ELSE acc.found END)"
    entries = f"aggregate(sequence(1, greatest(1, length({payload}) div 4)), named_struct('at', 2, 'found', {none}), (acc, k) -> {step}, acc -> acc.found)"
    names = ", ".join(f"{k}, '{v}'" for k, v in VENDOR_KEYS.items())
    pairs = f"transform({entries}, e -> named_struct('field', try_element_at(map({names}), e.key), 'value', CAST(CASE WHEN e.value >= 32768 THEN e.value - 65536 ELSE e.value END AS DOUBLE)))"
    return f"CASE WHEN {own} THEN filter({pairs}, p -> p.field IS NOT NULL AND p.value IS NOT NULL) ELSE CAST(array() AS {PAIR}) END"


VENDOR_VALUES = vendor_values("payload")


def frames(records: DataFrame, groups: tuple[int, ...] | None = None) -> DataFrame:
    """Well-formed frames of this protocol, with can_id, pgn, src_addr, priority and hex payload; others are left out.

    groups: only frames of these, chosen by the identifier before the payload is looked at.
    """
    own = records.where("proto = 'n2k' AND contains(raw, '#')")
    # A generator of one row: filters on its parts stay above it, so raw, whatever it comes from, is computed once.
    cut = own.selectExpr("*", "inline(array(struct(substring_index(raw, '#', 1) AS _head, substring(raw, instr(raw, '#') + 1) AS _tail)))")
    parts = cut.where("_head RLIKE '^[0-9A-Fa-f]{1,8}$'").selectExpr("*", "CAST(conv(_head, 16, 10) AS BIGINT) AS _id")
    valued = parts.selectExpr("*", f"inline(array({can_fields('_id')}))")
    if groups is not None:
        valued = valued.where(F.col("pgn").isin(*groups))
    return valued.where("_tail RLIKE '^([0-9A-Fa-f]{2})*$'").selectExpr("*", "upper(_tail) AS payload").drop("_head", "_tail", "_id")


def malformed(records: DataFrame) -> DataFrame:
    """Records of this protocol that are no frames."""
    value = can_identifier(F.col("raw"))
    return records.where(F.col("proto") == "n2k").where(value["can_id"].isNull() | can_payload(F.col("raw")).isNull())


NAMES = ("object_key", "object_rank", "seq", "ts", "proto", "can_id", "pgn", "src_addr", "priority", "payload")


def device_keys(records: DataFrame) -> list[str]:
    return [c for c in ("device_id", "src") if c in records.columns]


def in_parts() -> Column:
    """Whether a record can be a frame of a message of several; some that are no frames at all pass."""
    identifier = "CAST(conv(substring(substring_index(raw, '#', 1), 1, 8), 16, 10) AS BIGINT)"
    return F.expr(f"coalesce(proto = 'n2k' AND {can_fields(identifier)}.pgn IN ({', '.join(map(str, FAST))}), false)")


def messages(records: DataFrame, parts: bool = True) -> DataFrame:
    """NAMES of whole messages: frames of groups that fit one frame, and those put together from several, unless it is known that there are no parts."""
    keys = device_keys(records)
    if not parts:
        return frames(records, SINGLE).select(*NAMES)
    whole = reassemble(frames(records, FAST).select(*NAMES, *keys), [*keys, "can_id"], ["object_rank", "seq"])
    return frames(records, SINGLE).select(*NAMES).unionByName(whole.select(*NAMES))


def samples_of(found: DataFrame) -> DataFrame:
    """SAMPLE rows of messages (NAMES)."""
    return decode_messages(found).select("object_key", "object_rank", "seq", "ts", "proto", "field", "value", F.col("priority").alias("prio"), "src_addr")


def decode(records: DataFrame, parts: bool = True) -> DataFrame:
    """SAMPLE rows of records (object_key, object_rank, seq, ts, proto, raw; device_id, src if there are). parts: see messages."""
    return samples_of(messages(records, parts))


def open_frames(records: DataFrame) -> DataFrame:
    """The records whose frames belong to messages that are not complete yet."""
    own = [c for c in records.columns if c not in ("pgn", "can_id", "payload")]
    fast = frames(records, FAST)
    return fast_packet.open_frames(fast, [*device_keys(records), "can_id"], ["object_rank", "seq"]).select(*own)
