"""Hex, little-endian and bit-field column expressions, all inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body of value, which is computed once however often body has it."""
    return F.get(F.transform(F.array(value), body), 0)


def hex_byte(payload: Column, offset: Column | int) -> Column:
    """The byte at an offset of a hex string as a long; null beyond its end."""
    start = (F.lit(offset) if isinstance(offset, int) else offset) * 2 + 1
    pair = F.substring(payload, start, 2)
    return F.when(F.length(pair) == 2, F.conv(pair, 16, 10).cast("bigint"))


def le_uint(payload: Column, offset: int, size: int) -> Column:
    """Unsigned little-endian integer of up to 7 bytes."""
    pairs = F.concat(*(F.substring(payload, (offset + k) * 2 + 1, 2) for k in reversed(range(size))))
    return F.when(F.length(payload) >= (offset + size) * 2, F.conv(pairs, 16, 10).cast("bigint"))


def le_int(payload: Column, offset: int, size: int) -> Column:
    """Signed little-endian integer of up to 8 bytes."""
    if size == 8:
        low, high = le_uint(payload, offset, 4), le_int(payload, offset + 4, 4)
        return F.shiftleft(high, 32).bitwiseOR(low)
    raw = le_uint(payload, offset, size)
    return F.when(raw >= 1 << (8 * size - 1), raw - (1 << (8 * size))).otherwise(raw)


def bit_field(payload: Column, offset: int, shift: int, width: int) -> Column:
    """width bits of the byte at offset, from bit shift up."""
    return F.shiftright(hex_byte(payload, offset), shift).bitwiseAND((1 << width) - 1)


def available(value: Column, size: int, signed: bool) -> Column:
    """Null where all bits that carry the value are ones: not available."""
    top = (1 << (8 * size - 1)) - 1 if signed else (1 << (8 * size)) - 1
    return F.when(value != top, value)


#: The low four bits of each byte.
NIBBLES = 0x0F0F0F0F0F0F0F0F


def payload_words(messages: DataFrame, payload: str) -> DataFrame:
    """messages with _words, the bytes of a hex payload as 64-bit words, lowest bit first, and _size, its bits."""
    # Sixteen digits, zeros beyond the end, read backwards: the bytes in order, the halves of each changed.
    digits = lambda first: f"CAST(conv(reverse(rpad(substring({payload}, {first}, 16), 16, '0')), 16, -10) AS BIGINT)"
    back = lambda x: f"(shiftleft({x} & {NIBBLES}L, 4) | (shiftrightunsigned({x}, 4) & {NIBBLES}L))"
    more = f"flatten(transform(sequence(1, greatest(1, (length({payload}) - 1) div 16)), k -> transform(array({digits('CAST(k AS INT) * 16 + 1')}), x -> {back('x')})))"
    # In steps, so that the first word, often the only one, is computed once and in compiled code.
    stepped = messages.selectExpr("*", f"{digits('1')} AS _word")
    words = f"CASE WHEN length({payload}) > 16 THEN concat(array({back('_word')}), {more}) ELSE array({back('_word')}) END AS _words"
    return stepped.selectExpr("*", words, f"length({payload}) * 4 AS _size").drop("_word")


def bits_at(words: str, first: str, width: str) -> str:
    """SQL of width bits (64 at most) from bit first on, as a long; null beyond the last word."""
    shift, word = f"(({first}) & 63)", f"shiftright({first}, 6)"
    low = f"shiftrightunsigned(get({words}, {word}), {shift})"
    high = f"shiftleft(get({words}, {word} + 1), 64 - {shift})"
    return f"((CASE WHEN {shift} + {width} > 64 THEN {low} | {high} ELSE {low} END) & shiftrightunsigned(-1L, 64 - {width}))"


def signed(value: str, width: str, is_signed: str) -> str:
    """SQL of a number of width bits, in two's complement where is_signed."""
    top = f"shiftleft(1L, {width} - 1)"
    return f"(CASE WHEN {is_signed} AND {width} < 64 THEN ({value} ^ {top}) - {top} ELSE {value} END)"


def can_identifier(raw: Column) -> Column:
    """struct(can_id, pgn, src_addr, priority) of the text before '#'; null where it is no hex identifier."""
    head = F.substring_index(raw, "#", 1)
    value = F.when(F.contains(raw, F.lit("#")) & head.rlike("^[0-9A-Fa-f]{1,8}$"), F.conv(head, 16, 10).cast("bigint"))
    return let(value, identifier_parts)


def identifier_parts(value: Column) -> Column:
    """can_fields of a column."""
    format_ = F.shiftright(value, 16).bitwiseAND(0xFF)
    specific = F.when(format_ >= 240, F.shiftright(value, 8).bitwiseAND(0xFF)).otherwise(F.lit(0))
    return F.struct(
        value.alias("can_id"),
        (F.shiftright(value, 24).bitwiseAND(0x03) * 65536 + format_ * 256 + specific).cast("int").alias("pgn"),
        value.bitwiseAND(0xFF).cast("int").alias("src_addr"),
        F.shiftright(value, 26).bitwiseAND(0x07).cast("int").alias("priority"),
    )


def can_fields(value: str) -> str:
    """SQL of the parts of a 29-bit identifier: the group number has its low byte only in the broadcast form (format 240 and up)."""
    format_ = f"(shiftright({value}, 16) & 255)"
    group = f"(shiftright({value}, 24) & 3) * 65536 + {format_} * 256 + CASE WHEN {format_} >= 240 THEN shiftright({value}, 8) & 255 ELSE 0 END"
    return f"struct({value} AS can_id, CAST({group} AS INT) AS pgn, CAST({value} & 255 AS INT) AS src_addr, CAST(shiftright({value}, 26) & 7 AS INT) AS priority)"


#: Flag bits of a captured identifier word: error frame, remote request. The extended-frame bit alone marks a data frame.
ERROR_FRAME, REMOTE_FRAME = 0x20000000, 0x40000000
FRAME_BYTES = 16


def captured_identifier(word: Column, size: Column) -> Column:
    """The 29-bit identifier of a captured word; null for error frames, remote requests and frames cut short."""
    data = (word.bitwiseAND(ERROR_FRAME | REMOTE_FRAME) == 0) & (size >= FRAME_BYTES)
    return F.when(data, word.bitwiseAND((1 << 29) - 1))


def can_payload(raw: Column) -> Column:
    """The hex text after '#', upper case; empty is legal; null where it is no whole bytes."""
    tail = F.substring(raw, F.instr(raw, "#") + 1, F.length(raw))
    return F.when(F.contains(raw, F.lit("#")) & tail.rlike("^([0-9A-Fa-f]{2})*$"), F.upper(tail))
