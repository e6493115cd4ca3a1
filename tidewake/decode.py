"""Decoding of single records, as column expressions: what a raw text says, without tables or state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .functions import bits, sentences


def n2k(raw: Column) -> Column:
    """struct(can_id, pgn, src_addr, priority, payload) of an identifier#payload text; payload is binary. Null where either half is out of form."""
    identifier, payload = bits.can_identifier(raw), bits.can_payload(raw)
    whole = F.struct(*(identifier[c].alias(c) for c in ("can_id", "pgn", "src_addr", "priority")), F.unhex(payload).alias("payload"))
    return F.when(identifier["can_id"].isNotNull() & payload.isNotNull(), whole)


def n0183(raw: Column) -> Column:
    """struct(talker, sentence_type, fields, checksum_ok) of a sentence."""
    return sentences.sentence(raw)


#: Protocol -> its decoder.
DECODERS = {"n2k": n2k, "n0183": n0183}
