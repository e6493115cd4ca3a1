"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is two shuffles over the links. Links never reach the driver: only a
count and a checksum do, to see when nothing changes. Each round is written to
the shared folder, so a lost executor repeats at most one round. The number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import HOT_ROWS, discard, join_facts, materialize


def star(spark: SparkSession, links: DataFrame, large: bool, count: int) -> DataFrame:
    """links (u, v), u > v, count of them. Large: each larger neighbour goes to the least neighbour; small: each smaller one, and the node itself.

    A root has nearly all links of its component at one end: such nodes' least neighbours are broadcast, so their links stay where they are.
    """
    if large:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        larger = both.where("v > u")
        if count > HOT_ROWS:
            least = materialize(spark, least, "least-neighbours")
            moved = join_facts(larger, least, ["u"], "n", 2 * count)
        else:
            moved = larger.join(least, "u")
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (u, v long): component is the least node reachable. Nulls: no link."""
    directed = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(spark, directed, "links")
    mark = checksum(now)
    while True:
        after = materialize(spark, star(spark, star(spark, now, True, mark[0]), False, mark[0]), "links")
        discard(spark, now)
        now, before = after, mark
        mark = checksum(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def checksum(links: DataFrame) -> tuple:
    # Sums of 32-bit parts of a hash: cannot overflow below 2^31 links of 100 TB scale; try_sum would hide it.
    h = F.xxhash64("u", "v")
    row = links.agg(F.count("*"), F.sum(h.bitwiseAND(0x7FFFFFFF).cast("decimal(20,0)")), F.sum(F.shiftrightunsigned(h, 33).cast("decimal(20,0)"))).first()
    return tuple(row)
