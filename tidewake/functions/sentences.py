"""NMEA 0183 sentences as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bits import let

#: A decimal number as instruments send it.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def xor_checksum(body: Column) -> Column:
    """XOR of the characters' codes; 0 for an empty text."""
    codes = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return F.aggregate(codes, F.lit(0), lambda a, c: a.bitwiseXOR(c))


def sentence(raw: Column) -> Column:
    """struct(talker, sentence_type, fields, checksum_ok).

    A leading $ or ! goes, the text after the first * is the checksum. A tag of
    five characters is talker and type; a proprietary tag (P...) stays whole and has no
    talker. checksum_ok is null where there is no checksum, false where it is no hex.
    """
    text = F.regexp_replace(F.trim(raw), r"^[$!]+", "")

    def checksum(text: Column, body: Column) -> Column:
        sent = F.substring(text, F.instr(text, "*") + 1, 2)
        match = F.when(sent.rlike("^[0-9A-Fa-f]{2}$"), F.conv(sent, 16, 10).cast("int") == xor_checksum(body))
        return F.when(F.contains(text, F.lit("*")), F.coalesce(match, F.lit(False)))

    def parts(text: Column, body: Column, fields: Column) -> Column:
        tag = F.get(fields, 0)
        five = ~F.startswith(tag, F.lit("P")) & (F.length(tag) == 5)
        return F.struct(
            F.when(five, F.substring(tag, 1, 2)).alias("talker"),
            F.when(five, F.substring(tag, 3, 3)).otherwise(tag).alias("sentence_type"),
            F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0))).alias("fields"),
            checksum(text, body).alias("checksum_ok"),
        )

    whole = let(text, lambda x: let(F.substring_index(x, "*", 1), lambda body: let(F.split(body, ","), lambda fields: parts(x, body, fields))))
    return F.when(raw.isNotNull(), whole)


def field_at(fields: Column, k: int) -> Column:
    """The field at a place from 0; null beyond the end or where empty."""
    value = F.get(fields, k)
    return F.when(value != "", value)


def number(text: Column) -> Column:
    """A double where the text is a plain decimal number, else null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def number_at(fields: Column, k: int) -> Column:
    return number(field_at(fields, k))


def degrees_minutes(text: Column, hemisphere: Column, positive: str, negative: str, limit: int) -> Column:
    """(d)ddmm.mmm and a hemisphere letter as signed degrees; null out of form or range."""
    degrees = F.regexp_extract(text, r"^([0-9]+)([0-9]{2}\.[0-9]+)$", 1)
    minutes = F.regexp_extract(text, r"^([0-9]+)([0-9]{2}\.[0-9]+)$", 2).try_cast("double")
    value = degrees.try_cast("double") + minutes / 60
    sign = F.when(hemisphere == positive, 1).when(hemisphere == negative, -1)
    return F.when((minutes < 60) & (value <= limit), value * sign)


def position(fields: Column, first: int) -> Column:
    """struct(lat, lon) from four fields: both or neither."""
    lat = degrees_minutes(field_at(fields, first), field_at(fields, first + 1), "N", "S", 90)
    lon = degrees_minutes(field_at(fields, first + 2), field_at(fields, first + 3), "E", "W", 180)
    both = lat.isNotNull() & lon.isNotNull()
    return F.struct(F.when(both, lat).alias("lat"), F.when(both, lon).alias("lon"))


def gps_seconds(date: Column, time: Column) -> Column:
    """ddmmyy and hhmmss[.sss] as POSIX seconds to the microsecond; null unless both are in form."""
    stamp = F.try_to_timestamp(F.concat(date, F.lit(" "), F.substring(time, 1, 6)), F.lit("ddMMyy HHmmss"))
    rest = F.coalesce(F.regexp_extract(time, r"^[0-9]{6}(\.[0-9]+)$", 1).try_cast("double"), F.lit(0.0))
    good = date.rlike("^[0-9]{6}$") & time.rlike(r"^[0-9]{6}(\.[0-9]*)?$")
    return F.when(good, F.round(F.unix_seconds(stamp) + rest, 6))


def quadruplets(fields: Column) -> Column:
    """array<struct(kind, value, unit, name)> of a transducer sentence; an incomplete tail is left out."""
    starts = F.when(F.size(fields) >= 4, F.sequence(F.lit(0), F.size(fields) - 4, F.lit(4))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda k: F.struct(
        F.get(fields, k).alias("kind"), F.get(fields, k + 1).alias("value"), F.get(fields, k + 2).alias("unit"), F.get(fields, k + 3).alias("name")
    ))
