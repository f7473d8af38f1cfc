"""Order-sensitive operators: state over rows, sequences, islands, packing and tiling."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark limits groups before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def image_tokens(references: DataFrame) -> DataFrame:
    """(doc, path, token): one token for each path, all Markdown references numbered before HTML ones."""
    first = references.groupBy("doc", "path").agg(F.min(F.struct("syntax", "nth")).alias("at"))
    number = F.row_number().over(Window.partitionBy("doc").orderBy("at"))
    return first.select("doc", "path", F.format_string("IMG_%04d", number).alias("token"))


def packed(pieces: Column, most: int, joint: int = 2) -> Column:
    """Greedy chunks of texts under a budget: an array of (pieces, chars).

    A chunk is closed when the next text would exceed the budget; every text counts ``joint``
    characters for its separator, the last one too; a text beyond the budget is a chunk of its own.
    """
    start = F.expr("struct(cast(array() as array<struct<n:bigint,chars:bigint>>) as done, 0L as n, 0L as chars, 0L as size)")

    def step(s: Column, text: Column) -> Column:
        size = F.length(text).cast("long")
        full = (s["size"] > 0) & (s["size"] + size > most)
        closed = F.array_append(s["done"], F.struct(s["n"].alias("n"), s["chars"].alias("chars")))
        return F.struct(
            F.when(full, closed).otherwise(s["done"]).alias("done"), (F.when(full, 0).otherwise(s["n"]) + 1).cast("long").alias("n"),
            (F.when(full, 0).otherwise(s["chars"]) + size).cast("long").alias("chars"), (F.when(full, 0).otherwise(s["size"]) + size + joint).cast("long").alias("size"),
        )

    return F.aggregate(pieces, start, step, lambda s: F.when(s["n"] > 0, F.array_append(s["done"], F.struct(s["n"].alias("n"), s["chars"].alias("chars")))).otherwise(s["done"]))


def packed_chunks(docs: DataFrame, most: int) -> DataFrame:
    """(doc, chunk, lines, chars): a document's lines packed in order; the whole document stays in its row."""
    chunks = docs.select("doc", F.posexplode(packed(F.split("text", "\n", -1), most)).alias("k", "c"))
    return chunks.select("doc", (F.col("k") + 1).cast("long").alias("chunk"), F.col("c.n").alias("lines"), F.col("c.chars").alias("chars"))


def tiles(docs: DataFrame, *, most: int, overlap: int) -> DataFrame:
    """(doc, first, last) of windows of at most ``most`` pages, each beginning ``overlap`` pages before the last one's end."""
    if overlap >= most:
        raise ValueError("an overlap of a whole window never advances")
    step = most - overlap
    count = F.greatest(F.ceil((F.col("total") - overlap) / F.lit(step)), F.lit(1))
    starts = docs.filter("total > 0").select("doc", "total", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("k"))
    first = (F.col("k") * step + 1).cast("long")
    return starts.select("doc", first.alias("first"), F.least(first + most - 1, F.col("total")).alias("last"))


def snapped_tiles(total: int, most: int, overlap: int, marks: list[int], *, reach: int = 10, least: int = 20) -> list[tuple[int, ...]]:
    """Tiles of one document whose ends move to the nearest contents mark, the smaller of two as near."""
    out, first = [], 1
    while first <= total:
        last = min(first + most - 1, total)
        if last < total:
            near = [m - 1 for m in sorted(marks) if abs(m - 1 - last) <= reach and least <= m - first <= most]
            last = min(near, key=lambda m: abs(m - last), default=last)
        out.append((first, last))
        if last >= total:
            break
        first = max(last - overlap + 1, first + 1)
    return out


def snapped(docs: DataFrame, *, most: int, overlap: int) -> DataFrame:
    """(doc, first, last): the snapped tiles of documents (doc, total, marks).  A tile depends on the one before, so a document's follow each other in Python, batch by batch."""

    def cut(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            out = [(doc, *tile) for doc, total, marks in batch.itertuples(index=False) for tile in snapped_tiles(total, most, overlap, list(marks))]
            yield pd.DataFrame(out, columns=["doc", "first", "last"])

    return docs.select("doc", "total", "marks").mapInPandas(cut, f"doc {docs.schema['doc'].dataType.simpleString()}, first long, last long")


def halved(docs: DataFrame, *, most: int) -> DataFrame:
    """(doc, first, last): page ranges halved until none is longer than ``most``.

    A range of n pages falls into equal halves, the longer one first, so the cuts follow from n
    alone: after k halvings the ends are at ``ceil(n * j / 2**k)``-like places, found by descent.
    """
    ranges = docs.filter("total > 0").select("doc", F.lit(1).cast("long").alias("first"), F.col("total").alias("last"))
    split = F.expr(
        f"aggregate(sequence(1, 64), array(struct(first, last)), (a, i) -> flatten(transform(a, r -> "
        f"if(r.last - r.first + 1 > {most}, array(struct(r.first as first, cast(floor((r.first + r.last) / 2) as bigint) as last), "
        f"struct(cast(floor((r.first + r.last) / 2) as bigint) + 1 as first, r.last as last)), array(r)))))"
    )
    return ranges.select("doc", F.explode(split).alias("r")).select("doc", "r.first", "r.last")


def nearest_ranks(rows: DataFrame, by: list[str]) -> DataFrame:
    """Tenth and ninetieth percentile of ``v`` by nearest rank, over groups of rows.

    Ranks come from a window and are picked by aggregation, so no group's values are gathered.
    """
    w = Window.partitionBy(*by)
    ranked = rows.withColumn("r", F.row_number().over(w.orderBy("v")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    low, high = F.floor(F.col("n") / 10), F.least(F.col("n") - 1, F.floor(F.col("n") * 9 / 10))
    return ranked.groupBy(*by).agg(F.max(F.when(F.col("r") == low, F.col("v"))).alias("low"), F.max(F.when(F.col("r") == high, F.col("v"))).alias("high"))


def dominant(rows: DataFrame, by: str, value: str, order: str, *, share: float) -> DataFrame:
    """The most common value of each group if it has the share; ties go to the one seen first."""
    counts = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("seen"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy(by)))
    best = top(counts, [by], [F.desc("n"), F.asc("seen")], 1)
    return best.filter(F.col("n") >= F.col("total") * share).select(by, value, "n", "total")


def sample_heads(docs: DataFrame, *, budget: int = 21_000, head: int = 6_000) -> DataFrame:
    """(doc, head, digest): whole texts within the budget, else their first characters."""
    taken = F.when(F.length("text") <= budget, F.col("text")).otherwise(F.substring("text", 1, head))
    return docs.select("doc", F.length(taken).cast("long").alias("head"), F.sha2(taken, 256).alias("digest"))


def slice_starts(docs: DataFrame, headings: DataFrame, *, budget: int = 21_000, head: int = 6_000, size: int = 3_000, count: int = 5) -> DataFrame:
    """(doc, nth, start) of the slices of long documents: even places after the head, each moved on to the first heading inside it."""
    long = docs.filter(F.length("text") > budget).select("doc", F.length("text").alias("n"))
    target = (F.lit(head) + F.floor((F.col("n") - head - size) * F.col("nth") / (count - 1))).cast("long")
    places = long.select("doc", "n", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("nth")).withColumn("target", target)
    met = places.join(headings.select("doc", "offset"), "doc", "left")
    inside = F.when((F.col("offset") >= F.col("target")) & (F.col("offset") < F.col("target") + size), F.col("offset"))
    return met.groupBy("doc", "nth", "target").agg(F.min(inside).alias("snapped")).select("doc", F.col("nth").cast("long").alias("nth"), F.coalesce("snapped", "target").alias("start"))


def forward_filled(rows: DataFrame, by: list[str], order: list[str], column: str, filled: str) -> DataFrame:
    """``filled``: the last value of ``column`` that is not null, up to each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(filled, F.last(column, ignorenulls=True).over(w))


def sequence_breaks(rows: DataFrame, by: list[str], order: list[str], number: str) -> DataFrame:
    """Rows whose number is not one more than the last number plus the unnumbered rows since."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    numbered = F.col(number).isNotNull()
    place = rows.withColumn("place", F.row_number().over(w))
    last = place.withColumn("last_number", F.last(number, ignorenulls=True).over(before)).withColumn("last_place", F.last(F.when(numbered, F.col("place")), ignorenulls=True).over(before))
    expected = F.col("last_number") + F.col("place") - F.col("last_place")
    return last.withColumn("expected", expected).filter(numbered & F.col("expected").isNotNull() & (F.col(number) != F.col("expected")))


def sequence_gaps(rows: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, missing): numbers from one to the greatest that a group lacks."""
    whole = rows.groupBy(*by).agg(F.max(number).alias("most"), F.collect_set(number).alias("have"))
    return whole.select(*by, F.explode(F.array_except(F.transform(F.sequence(F.lit(1), F.col("most").cast("int")), lambda x: x.cast("long")), F.transform("have", lambda x: x.cast("long")))).alias("missing"))


def duplicates(rows: DataFrame, by: list[str]) -> DataFrame:
    """Keys that more than one row has, with how many."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")


def islands(rows: DataFrame, by: list[str], order: list[str], begins: Column) -> DataFrame:
    """``island``: the number of starts up to each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("island", F.sum(begins.cast("long")).over(w))


def sections(headings: DataFrame, totals: DataFrame) -> DataFrame:
    """(doc, nth, title, first, last): from each heading's offset to before the next one's; ``totals`` has (doc, total)."""
    w = Window.partitionBy("doc").orderBy("offset")
    cut = headings.join(totals, "doc").withColumn("next", F.lead("offset").over(w)).withColumn("nth", F.row_number().over(w).cast("long"))
    return cut.select("doc", "nth", "title", F.col("offset").alias("first"), (F.coalesce("next", "total") - 1).cast("long").alias("last"))


def lookahead(rows: DataFrame, by: list[str], order: list[str], value: Column, stop: Column, ahead: int) -> DataFrame:
    """``found``: the first value within ``ahead`` following rows, unless a stop row comes before it."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1, ahead)
    following = F.collect_list(F.struct(value.alias("value"), F.coalesce(stop, F.lit(False)).alias("stop"))).over(w)
    start = F.struct(F.lit(None).cast("string").alias("value"), F.lit(False).alias("over"))

    def step(s: Column, x: Column) -> Column:
        here = ~s["over"] & ~x["stop"] & x["value"].isNotNull()
        return F.struct(F.when(here, x["value"]).otherwise(s["value"]).alias("value"), (s["over"] | x["stop"] | here).alias("over"))

    return rows.withColumn("found", F.aggregate(following, start, step, lambda s: s["value"]))


def drift(rows: DataFrame, by: list[str], order: list[str], counter: str, tag: str) -> DataFrame:
    """Rows where ``counter - tag`` is neither zero nor the previous row's drift."""
    w = Window.partitionBy(*by).orderBy(*order)
    moved = rows.filter(F.col(tag).isNotNull()).withColumn("drift", F.col(counter) - F.col(tag))
    return moved.withColumn("before", F.coalesce(F.lag("drift").over(w), F.lit(0))).filter("drift <> 0 and drift <> before")
