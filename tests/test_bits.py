"""Bits at any place of a payload, against Python's whole numbers."""

import random

from tidewake.functions import bits
from tidewake.operators import layouts, n2k


def test_bits_at_any_place(spark):
    rng = random.Random(11)
    rows = []
    for k in range(300):
        data = bytes(rng.randrange(256) for _ in range(rng.choice([1, 7, 8, 9, 16, 17, 43, 223])))
        first = rng.randrange(8 * len(data))
        width = rng.randint(1, min(64, 8 * len(data) - first))
        value = int.from_bytes(data, "little") >> first & ((1 << width) - 1)
        minus = value - (1 << width) if value >> (width - 1) else value
        plain = value - (1 << 64) if value >= 1 << 63 else value
        rows.append((k, data.hex().upper(), first, width, plain, minus))
    table = spark.createDataFrame(rows, "k int, payload string, first int, width int, plain long, minus long")
    got = bits.payload_words(table, "payload").selectExpr("k", "_size", "length(payload) * 4 AS size", f"{bits.bits_at('_words', 'first', 'width')} AS raw", "plain", "minus", "width")
    got = got.selectExpr("*", f"{bits.signed('raw', 'width', 'true')} AS signed")
    for r in got.collect():
        assert (r.raw, r.signed, r._size) == (r.plain, r.minus, r["size"]), r


def test_rows_of_layouts_lie_in_words():
    for row in n2k.layout_rows() + n2k.set_rows():
        named = dict(zip([c.split()[0] for c in (n2k.LAYOUT if len(row) == 16 else n2k.SETS).split(", ")], row, strict=False))
        assert 0 < named["width"] <= 64 and named["first"] >= 0
    assert all(len(x.splits) <= 2 for x in layouts.LAYOUTS.values())


def point(number, name, lat, lon):
    return number.to_bytes(2, "little") + bytes([len(name) + 2, 1]) + name + lat.to_bytes(4, "little", signed=True) + lon.to_bytes(4, "little", signed=True)


def test_sets_behind_texts(spark):
    """A route of way points with names of any length; the last one is cut off, and a count may be too high."""
    head = lambda n, name: bytes(2) + n.to_bytes(2, "little") + bytes(4) + b"\xf8" + bytes([len(name) + 2, 1]) + name + b"\xff"
    whole = head(3, b"Home") + point(1, b"", 10, -20) + point(2, b"Buoy", 30, 40) + point(3, b"A longer name", -50, 60)
    rows = [(1, 129285, whole.hex()), (2, 129285, whole[:-3].hex()), (3, 129285, (head(9, b"") + point(7, b"x", 1, 2)).hex()), (4, 129285, head(0, b"none").hex()), (5, 129285, ""), (6, 129285, whole[:12].hex())]
    table = spark.createDataFrame([(k, p, x.upper()) for k, p, x in rows], "k int, pgn int, payload string")
    got = sorted((r.k, r.set, r.field, round(r.value * 1e7) if "l" in r.field[4:] else r.value) for r in n2k.decode_sets(table).collect())
    first = [(1, 1, 10, -20), (2, 2, 30, 40), (3, 3, -50, 60)]
    want = [(1, n, f, v) for n, i, a, b in first for f, v in (("n2k_wpid", i), ("n2k_wplatitude", a), ("n2k_wplongitude", b))]
    want += [(2, n, f, v) for n, i, a, b in first[:2] for f, v in (("n2k_wpid", i), ("n2k_wplatitude", a), ("n2k_wplongitude", b))]
    want += [(2, 3, "n2k_wpid", 3), (2, 3, "n2k_wplatitude", -50)]
    want += [(3, 1, "n2k_wpid", 7), (3, 1, "n2k_wplatitude", 1), (3, 1, "n2k_wplongitude", 2)]
    assert got == sorted(want)
    # None of them is a column of the wide table.
    assert {r.field for r in n2k.decode_messages(table).collect()} <= {"n2k_startrps", "n2k_nitems", "n2k_databaseid", "n2k_routeid"}
