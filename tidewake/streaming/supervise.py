"""Supervision of running streams: minute statistics from what they observe, and one end for all.

A stream tells what it counts by `observe`; the listener adds the counts of its batches up and logs them
once a minute. `watch` waits until any of some queries ends: the others are
stopped, and an error of one is the error of all, so that what restarts processes sees it.
"""

from __future__ import annotations

import logging
import threading
import time
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.resample import bad_clock
from .capture import candump_fields

log = logging.getLogger(__name__)
EVERY_S = 60.0


def counted_lines(lines: DataFrame, name: str = "capture") -> DataFrame:
    """A stream of capture lines (value) that observes how many came, how many are no frames, and how many have a clock that cannot be right."""
    f = candump_fields(F.col("value"))
    return lines.observe(name, F.count("*").alias("received"), F.count_if(f.isNull()).alias("refused"), F.count_if(F.coalesce(bad_clock(f["ts"]), F.lit(False))).alias("bad_clock"))


class Statistics(StreamingQueryListener):
    """Sums of the observed counts by stream, and rows and batches; logged at most once in every_s seconds."""

    def __init__(self, every_s: float = EVERY_S, clock: Callable[[], float] = time.monotonic, say: Callable[[str], None] = log.info):
        self.every_s, self.clock, self.say = every_s, clock, say
        self.totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.said, self.since = {}, clock()
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        with self.lock:
            total = self.totals[progress.name or str(progress.id)]
            total["batches"] += 1
            total["rows"] += progress.numInputRows
            for row in progress.observedMetrics.values():
                for key, value in row.asDict().items():
                    total[key] += value or 0
            if self.clock() - self.since >= self.every_s:
                self.tell()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.lock:
            self.tell()

    def settled(self, name: str, quiet_s: float = 1.0, limit_s: float = 30.0) -> dict[str, int]:
        """The totals of a stream that has ended, once no more progress of it comes in: reports come in a little after their batches."""
        end = time.monotonic() + limit_s
        while time.monotonic() < end:
            with self.lock:
                before = dict(self.totals[name])
            time.sleep(quiet_s)
            with self.lock:
                if before and before == dict(self.totals[name]):
                    break
        return defaultdict(int, self.totals[name])

    def tell(self) -> None:
        """What has come since the last time, and in all."""
        for name, total in self.totals.items():
            before = self.said.get(name, {})
            self.say(f"{name}: " + ", ".join(f"{key} {value - before.get(key, 0)} ({value})" for key, value in sorted(total.items())))
            self.said[name] = dict(total)
        self.since = self.clock()


def listening(spark: SparkSession, **options: object) -> Statistics:
    out = Statistics(**options)
    spark.streams.addListener(out)
    return out


def watch(spark: SparkSession, queries: list[StreamingQuery], poll_s: float = 0.2) -> StreamingQuery:
    """Wait until one of the queries ends; the others are stopped. Its error is raised; the query that ended is returned otherwise."""
    try:
        while True:
            for query in queries:
                if not query.isActive:
                    if query.exception() is not None:
                        raise query.exception()
                    return query
            time.sleep(poll_s)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
