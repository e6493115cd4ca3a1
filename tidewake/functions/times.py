"""Timestamps, intervals and names derived from them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Microseconds of each unit.
UNITS = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000}


def parse_interval(text: str) -> int:
    """'250ms', '1s', '1.5m', '2h' as microseconds; no sign, no blanks, more than zero."""
    m = re.fullmatch(r"([0-9]+(?:\.[0-9]+)?)(ms|s|m|h)", text)
    step = round(float(m[1]) * UNITS[m[2]]) if m else 0
    if step <= 0:
        raise ValueError(f"not an interval: {text!r}")
    return step


def bucket_floor(ts: Column, interval: str) -> Column:
    """Start of the tumbling bucket, counted from the epoch in whole microseconds."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(parse_interval(interval))))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text with a UTC offset; null for local, naive or malformed text."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+(\+00:00|Z)$"), F.try_to_timestamp(text))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with +00:00; the fraction only where there is one. Session time zone must be UTC."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("+00:00"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / 1e6
