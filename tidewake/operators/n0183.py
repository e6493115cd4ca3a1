"""NMEA 0183 records to samples, by a table of sentences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures, sentences
from ..functions.bits import let
from ..functions.sentences import field_at, number
from ..schema import NO_RANK


@dataclass(frozen=True)
class Value:
    """A numeric field of a sentence; only: (place, text) that must hold; fold, scale: as named."""

    suffix: str
    place: int
    only: tuple[int, str] | None = None
    fold: bool = False
    scale: float = 1.0


#: Sentence type -> values. Positions follow the public sentence layouts.
VALUES: dict[str, tuple[Value, ...]] = {
    "MWV": (
        Value("wind_angle_r", 0, (1, "R"), fold=True),
        Value("wind_angle_t", 0, (1, "T"), fold=True),
        Value("wind_speed_r", 2, (1, "R")),
        Value("wind_speed_t", 2, (1, "T")),
    ),
    "MWD": (Value("direction_magnetic", 2),),
    "VHW": (Value("water_speed_knots", 4),),
    "VTG": (Value("true_track", 0), Value("spd_over_grnd_kts", 4)),
    "RMC": (Value("spd_over_grnd", 6), Value("true_course", 7)),
    "HDG": (Value("heading", 0),),
    "HDM": (Value("heading", 0),),
    "ROT": (Value("rate_of_turn", 0, scale=1.0 / 60.0),),
    "RSA": (Value("rsa_starboard", 0),),
    "GLL": (),
    "DBT": (Value("depth_meters", 2),),
    "MDA": (Value("water_temp", 6),),
}
#: Sentence type -> place of its validity status, which must be A.
STATUS = {"MWV": 4, "RMC": 1, "ROT": 1, "GLL": 5}
#: Sentence type -> place of the first of its four position fields.
POSITION = {"RMC": 2, "GLL": 0}
#: Transducers kept, by exact case.
TRANSDUCERS = ("BATTV", "Roll", "M5_HEEL", "Pitch", "M5_PITCH", "RAW_WIND_S", "RAW_WIND_A", "RAW_BSP")

PAIR = "array<struct<field:string,value:double>>"


def pair(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("field"), value.cast("double").alias("value"))


def text_or_null(x: str | None, kind: str) -> str:
    return f"CAST(NULL AS {kind})" if x is None else f"'{x}'" if kind == "STRING" else str(x)


def layout_map() -> Column:
    """Sentence type -> array of its values' layouts, as one constant."""
    def one(kind: str, v: Value) -> str:
        place, text = v.only or (None, None)
        return f"named_struct('field', '{kind}_{v.suffix}', 'place', {v.place}, 'only_place', {text_or_null(place, 'INT')}, 'only_text', {text_or_null(text, 'STRING')}, 'fold', {str(v.fold).lower()}, 'scale', CAST({v.scale!r} AS DOUBLE))"

    rows = ", ".join(f"'{kind.upper()}', array({', '.join(one(kind, v) for v in values)})" for kind, values in ((k.lower(), v) for k, v in VALUES.items()) if values)
    return F.expr(f"map({rows})")


def plain_values(kind: Column, fields: Column) -> Column:
    """array<struct(field, value)> of the plain numeric fields of a sentence."""
    def value(v: Column) -> Column:
        x = number(F.get(fields, v["place"]))
        x = F.when(v["fold"], measures.fold_180(x)).otherwise(x) * v["scale"]
        return F.when(v["only_place"].isNull() | (F.get(fields, v["only_place"]) == v["only_text"]), x)

    layouts = F.try_element_at(layout_map(), kind)
    return F.transform(layouts, lambda v: F.struct(v["field"].alias("field"), value(v).alias("value"))).cast(PAIR)


def position_values(kind: str, fields: Column) -> Column:
    at = sentences.position(fields, POSITION[kind])
    return F.array(pair(f"{kind}_latitude".lower(), at.lat), pair(f"{kind}_longitude".lower(), at.lon)).cast(PAIR)


def clock_values(fields: Column, ts: Column) -> Column:
    """The GPS clock, and how far the capture clock is from it."""
    gps = sentences.gps_seconds(field_at(fields, 8), field_at(fields, 0))
    of = lambda g: F.array(pair("rmc_gps_time", g), pair("rmc_clock_offset", (F.unix_micros(ts) - F.round(g * 1e6).cast("bigint")) / 1e6)).cast(PAIR)
    return F.flatten(F.transform(F.array(gps), of))


def transducer_values(fields: Column) -> Column:
    kept = F.filter(sentences.quadruplets(fields), lambda q: q["name"].isin(*TRANSDUCERS))
    return F.transform(kept, lambda q: F.struct(F.concat(F.lit("xdr_"), F.lower(q["name"])).alias("field"), number(F.when(q["value"] != "", q["value"])).alias("value")))


def values_of(s: Column, ts: Column, strict_transducers: bool = False) -> Column:
    """array<struct(field, value)> of a tokenized sentence; empty for other types, bad checksums and void status.

    Transducer sentences are taken whatever their checksum, unless strict.
    """
    return let(s, lambda x: chosen(x, ts, strict_transducers))


def chosen(s: Column, ts: Column, strict: bool) -> Column:
    none = F.array().cast(PAIR)
    kind, fields = s["sentence_type"], s["fields"]
    sound = F.coalesce(s["checksum_ok"], F.lit(True))
    status = F.create_map(*(x for k, place in STATUS.items() for x in (F.lit(k), F.lit(place))))
    place = F.try_element_at(status, kind)
    valid = sound & (place.isNull() | F.coalesce(F.get(fields, place) == "A", F.lit(False)))
    out = F.when((kind == "XDR") & (sound | F.lit(not strict)), transducer_values(fields))
    out = out.when(valid & (kind == "RMC"), F.concat(plain_values(kind, fields), position_values("RMC", fields), clock_values(fields, ts)))
    out = out.when(valid & (kind == "GLL"), position_values("GLL", fields))
    out = out.when(valid & kind.isin(*VALUES), plain_values(kind, fields))
    return F.filter(F.coalesce(out, none), lambda p: p["value"].isNotNull())


def decode(records: DataFrame) -> DataFrame:
    """SAMPLE rows of records (object_key, object_rank, seq, ts, proto, raw) of this protocol; the rest is left."""
    own = records.where((F.col("proto") == "n0183") & F.col("raw").isNotNull())
    # A generator of one row: the sentence is taken apart once, whatever is asked of its parts.
    cut = own.select("object_key", "object_rank", "seq", "ts", "proto", F.explode(F.array(sentences.sentence(F.col("raw")))).alias("_s"))
    pairs = cut.select("object_key", "object_rank", "seq", "ts", "proto", F.explode(values_of(F.col("_s"), F.col("ts"))).alias("_p"))
    rank = F.lit(NO_RANK)
    return pairs.select("object_key", "object_rank", "seq", "ts", "proto", "_p.field", "_p.value", rank.alias("prio"), rank.alias("src_addr"))
