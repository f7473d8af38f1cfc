"""Connected components by alternating large-star and small-star steps.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).  Neighbour sets are
never gathered: a step needs the least neighbour of a node only, an aggregate that combines before
the shuffle, and a join that deals the links of a hot node to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import dealt_join, durable, hot_keys


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.a", "l.b")


def _hang(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``links`` (a, b) with ``m`` of ``least`` (a, m, n) for their a; those of a hot node are dealt to many tasks."""
    return dealt_join(links, least.select("a", "m"), "a", hot_keys(least, "a", total))


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Each greater neighbour of a node goes to the least node in reach of one step."""
    ways = _both_ways(links)
    least = durable(ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")))
    return _hang(ways.filter("b > a"), least, total).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Each lesser neighbour of a node, and the node itself, go to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = durable(down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
    moved = _hang(down, least, total).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its least node.

    Links to itself and repeated links do not matter; no links give no rows.
    """
    links = durable(links.select("a", "b").filter("a <> b").distinct())
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = tuple(links.agg(*mark).first())
    while before[0]:
        links = durable(_small_star(_large_star(links, before[0]), before[0]))
        after = tuple(links.agg(*mark).first())
        if after == before:
            break
        before = after
    names = links.groupBy("a").agg(F.min("b").alias("b"))
    return names.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        names.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
