"""Schemas of the archive, of samples and of observations, and the rules for names."""

from __future__ import annotations

import re

# Names and order of fields, as records and entries must have them.
#: The only archive row; the same six fields in this order for every protocol.
RAW_FIELDS = ("ts", "mono", "device_id", "src", "proto", "raw")
RAW = "ts STRING, mono DOUBLE, device_id STRING, src STRING, proto STRING, raw STRING"
AUDIT_FIELDS = ("timestamp", "application", "host", "exit_code", "comment", "details")
AUDIT = "timestamp STRING, application STRING, host STRING, exit_code INT, comment STRING, details MAP<STRING, STRING>"
SAMPLE = "object_key STRING, object_rank LONG, seq LONG, ts TIMESTAMP, proto STRING, field STRING, value DOUBLE, prio INT, src_addr INT"
OBSERVATION = "object_key STRING, object_rank LONG, bucket_ts TIMESTAMP, field STRING, value DOUBLE"
LEDGER = "key STRING, ingested TIMESTAMP, first_ts TIMESTAMP, last_ts TIMESTAMP, rows INT"

#: Fixed patterns of names.
PROTO = r"^[a-z0-9][a-z0-9.]*$"
COLUMN = r"^[a-z][a-z0-9_]{0,62}$"
APPLICATION = r"^[a-z0-9][a-z0-9._-]*$"

#: Rank of samples whose protocol has no device priority: behind every real one.
NO_RANK = 1 << 30


def check_name(name: str, pattern: str = COLUMN) -> str:
    if not re.fullmatch(pattern.strip("^$"), name):
        raise ValueError(f"not a valid name: {name!r}")
    return name
