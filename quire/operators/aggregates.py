"""Aggregates of groups and set operations; all combine before the shuffle but the exact median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(rows: DataFrame, by: list[str], order: str, first: str) -> DataFrame:
    """(by, n, first_<order>, first_<first>): how often a key comes, where first, and what stands there."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias(f"first_{order}"), F.min_by(first, order).alias(f"first_{first}"))


def exact_median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, median): the middle value, or the mean of the two in the middle."""
    return rows.groupBy(*by).agg(F.median(value).alias("median"))


def largest_share(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, largest, total): the rows of a group's most common value, and all its rows."""
    each = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(*by).agg(F.max("n").alias("largest"), F.sum("n").alias("total"))


def tested(rows: DataFrame, by: list[str], some: dict[str, Column], every: dict[str, Column]) -> DataFrame:
    """(by, ...): whether any row passes each test of ``some``, and whether all pass each of ``every``."""
    return rows.groupBy(*by).agg(*[F.bool_or(c).alias(n) for n, c in some.items()], *[F.bool_and(c).alias(n) for n, c in every.items()])


def concatenated(rows: DataFrame, by: list[str], order: str, text: Column, *, separator: str = "\n") -> DataFrame:
    """(by, text, n): texts in order, null ones left out, and the number of rows."""
    joined = F.expr(f"listagg(__text, '{separator}') within group (order by {order})")
    return rows.withColumn("__text", text).groupBy(*by).agg(joined.alias("text"), F.count(F.lit(1)).alias("n"))


def best(rows: DataFrame, by: list[str], value: str, *order: Column) -> DataFrame:
    """(by, value) of each group's row of the greatest ``order``."""
    return rows.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias(value))


def counted_if(rows: DataFrame, by: list[str], tests: dict[str, Column]) -> DataFrame:
    """(by, ...): how many rows pass each test."""
    return rows.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in tests.items()])


def confident(rows: DataFrame, by: str, size: str, *, least: int = 2, share: tuple[int, int] = (6, 10)) -> DataFrame:
    """(by, confident): a split is trusted if it has ``least`` parts and none holds more than the share of all."""
    up, down = share
    return rows.groupBy(by).agg(((F.count(F.lit(1)) >= least) & (F.max(size) * down <= F.sum(size) * up)).alias("confident"))


def missing(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key ``known`` lacks."""
    return rows.join(known.select(key), key, "left_anti")


def difference(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows that ``other`` lacks."""
    return rows.subtract(other)


def multiset_difference(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Rows, each less as often as ``other`` has it."""
    return rows.exceptAll(other)


def ranked_union(*sides: DataFrame) -> DataFrame:
    """All rows, with the place of their side as ``rank``."""
    ranked = [side.withColumn("rank", F.lit(k)) for k, side in enumerate(sides)]
    out = ranked[0]
    for side in ranked[1:]:
        out = out.unionByName(side)
    return out


def intersection(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of both."""
    return rows.intersect(other)


def relative_width(rows: DataFrame, size: str, *, low: float = 0.2, high: float = 0.9) -> DataFrame:
    """``percent``: a size as hundredths of the median size, within bounds."""
    middle = rows.agg(F.median(size).alias("__middle"))  # one row, which the join sends to all by its size
    share = F.greatest(F.lit(low), F.least(F.lit(high), F.col(size) / F.col("__middle")))
    return rows.join(middle).withColumn("percent", F.floor(share * 100 + 0.000001).cast("long")).drop("__middle")


def flagged(rows: DataFrame, flag: Column, by: Column, order: str) -> DataFrame:
    """Flagged rows in order, without those that a person or an agent has decided."""
    return rows.filter(flag & ~by.isin("manual", "agent")).orderBy(order)
