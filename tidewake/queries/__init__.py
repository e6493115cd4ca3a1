"""Every operator applied to the test tables, with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def everything() -> tuple[dict[str, Query], dict[str, str]]:
    from . import archive, decoding, derive, metrics, streams

    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for module in (derive, metrics, decoding, archive, streams):
        queries |= module.QUERIES
        oracles |= module.ORACLES
    return queries, oracles
