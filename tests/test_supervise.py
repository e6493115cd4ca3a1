"""Statistics of streams, and one end for all of them."""

import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from test_capture import folder_of, line
from tidewake.streaming import capture, supervise


def test_counts_add_up(spark, tmp_path):
    old = "(1000000000.000000) can0 09F80102#00"
    parts = [(0, [line(0), "no frame", line(1)]), (3, [old, line(2)]), (5, ["", old, line(3), line(4)])]
    folder_of(tmp_path / "segments", parts)
    said = []
    stats = supervise.listening(spark, every_s=0.0, say=said.append)
    try:
        capture.drain(spark, f"file://{tmp_path}/segments", f"file://{tmp_path}/archive", "boat", f"file://{tmp_path}/checkpoint", max_batch_bytes=120)
        deadline = time.time() + 30
        while time.time() < deadline and stats.totals["capture boat"]["received"] < 9:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(stats)
    total = stats.totals["capture boat"]
    assert (total["received"], total["refused"], total["bad_clock"], total["rows"]) == (9, 2, 2, 9)
    assert any("received" in text and "bad_clock" in text for text in said)


def test_one_end_for_all(spark, tmp_path):
    def rate(name, value):
        return spark.readStream.format("rate").option("rowsPerSecond", 5).load().select(value.alias("x")).writeStream.format("noop").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()

    good = rate("good", F.col("value"))
    bad = rate("bad", F.when(F.col("value") >= 0, F.raise_error(F.lit("broken"))))
    with pytest.raises(StreamingQueryException):
        supervise.watch(spark, [good, bad])
    assert not good.isActive and not bad.isActive
    first, second = rate("first", F.col("value")), rate("second", F.col("value"))
    first.stop()
    assert supervise.watch(spark, [second, first]) is first and not second.isActive
