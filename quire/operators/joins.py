"""Joins: pairs, lookups, first match, multisets, containment, as-of, ranges and bands."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

PROVENANCE = {"manual": 0, "agent": 1}


def chunk_pairs(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source chunks with their translations on ``doc``; ``missing`` where there is none."""
    right = target.select("doc", F.col("text").alias("target"))
    return source.select("doc", F.col("text").alias("source")).join(right, "doc", "left").withColumn("missing", F.col("target").isNull())


def looked_up(rows: DataFrame, dimension: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """``value`` of the dimension by key, or the default; a small dimension is sent to all by its measured size."""
    return rows.join(dimension, key, "left").withColumn(value, F.coalesce(F.col(value), default))


def multiset_difference(left: DataFrame, right: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, lost, gained): how many more of a value either side has."""
    a = left.groupBy(*by, value).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(*by, value).agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, [*by, value], "full")
    n, m = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return both.select(*by, value, F.greatest(n - m, F.lit(0)).alias("lost"), F.greatest(m - n, F.lit(0)).alias("gained")).filter("lost > 0 or gained > 0")


def as_of(rows: DataFrame, marks: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """``value`` of the last mark at or before each row, by one window over both: no range join."""
    columns = rows.columns
    marked = marks.select(*by, order, F.col(value).alias("mark"), F.lit(0).alias("side"))
    both = rows.withColumn("mark", F.lit(None).cast(marks.schema[value].dataType)).withColumn("side", F.lit(1)).unionByName(marked, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(order, "side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("mark", ignorenulls=True).over(w)).filter("side = 1").select(*columns, value)


def first_in_range(targets: DataFrame, points: DataFrame, by: str, width: int) -> DataFrame:
    """``found``: the least point in [at, at + width) of each target (by, at).

    Both sides are keyed by the tile of ``width`` they are in, so a target meets the points of two
    tiles and not all of its group.
    """
    tile = F.floor(F.col("at") / width)
    wanted = targets.withColumn("tile", F.explode(F.array(tile, tile + 1)))
    there = points.select(by, F.col("point"), F.floor(F.col("point") / width).alias("tile"))
    inside = F.when((F.col("point") >= F.col("at")) & (F.col("point") < F.col("at") + width), F.col("point"))
    return wanted.join(there, [by, "tile"], "left").groupBy(*targets.columns).agg(F.min(inside).alias("found"))


def passages(docs: DataFrame, needles: DataFrame, *, block: int = 12) -> DataFrame:
    """(doc, item, at): the first place of a compacted needle in a compacted document, from 1.

    Documents are cut into blocks of ``block`` characters.  A needle of twice that length covers whole
    ones wherever it stands: for each of the ``block`` ways to lie over them it is cut into its whole
    blocks, all of which must be met in a row, and its ends, which the neighbours of the first and last
    one confirm.  So no text is joined, only blocks.  Shorter needles meet the windows of a document by
    their first three characters, or the first one.
    """
    compact = docs.select("doc", T.compact(F.col("text")).alias("h"))
    wanted = needles.select("item", T.compact(F.col("text")).alias("n")).filter("n <> ''")
    ways = wanted.filter(F.length("n") >= 2 * block).select("item", "n", F.explode(F.sequence(F.lit(0), F.lit(block - 1))).alias("o"))
    ways = ways.withColumn("pieces", F.floor((F.length("n") - F.col("o")) / block).cast("int"))
    pieces = ways.select("item", "n", "o", "pieces", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("j"))
    begin, end = F.col("o") + F.col("j") * block, F.col("o") + F.col("pieces") * block
    pieces = pieces.select(
        "item", "o", "pieces", "j", F.col("n").substr(begin + 1, F.lit(block)).alias("key"),
        F.when(F.col("j") == 0, F.left("n", "o")).otherwise("").alias("head"),
        F.when(F.col("j") == F.col("pieces") - 1, F.col("n").substr(end + 1, F.lit(block))).otherwise("").alias("tail"),
    )
    cut = compact.select("doc", F.regexp_extract_all("h", F.lit(f"(?s).{{{block}}}"), 0).alias("bs"), F.right("h", F.length("h") % block).alias("rest"))
    neighbours = F.transform("bs", lambda key, k: F.struct(key.alias("key"), F.coalesce(F.get("bs", k - 1), F.lit("")).alias("before"), F.coalesce(F.get("bs", k + 1), F.col("rest")).alias("after")))
    blocks = cut.select("doc", F.posexplode(neighbours).alias("b", "x")).select("doc", "b", "x.*")
    met = blocks.join(pieces, "key").filter(F.col("before").endswith(F.col("head")) & F.col("after").startswith(F.col("tail")))
    at = (F.col("b") - F.col("j")) * block - F.col("o") + 1
    whole = met.groupBy("doc", "item", "o", "pieces", at.alias("at")).agg(F.count(F.lit(1)).alias("k")).filter("k = pieces and at > 0")
    found = whole.select("doc", "item", "at")
    for size, most in ((3, 2 * block), (1, 3)):
        short = wanted.filter((F.length("n") >= size) & (F.length("n") < most)).withColumn("key", F.left("n", F.lit(size)))
        windows = compact.select("doc", F.posexplode(F.regexp_extract_all("h", F.lit(f"(?s)(?=(.{{{size},{most - 1}}}))"), 1)).alias("at", "w"))
        near = windows.withColumn("key", F.left("w", F.lit(size))).join(short, "key").filter(F.col("w").startswith(F.col("n")))
        found = found.unionByName(near.select("doc", "item", (F.col("at") + 1).alias("at")))
    return found.groupBy("doc", "item").agg(F.min("at").cast("long").alias("at"))


def sign_bits(vector: Column) -> Column:
    """The signs of up to 64 values as a long, the first as the lowest bit."""
    return F.aggregate(
        F.zip_with(vector, F.sequence(F.lit(0), F.size(vector) - 1), lambda v, i: F.when(v > 0, F.expr("1L")).otherwise(F.lit(0)) * F.when(i == 63, F.lit(-(2**63)).cast("long")).otherwise(F.pow(F.lit(2.0), i).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b),
    )


def nearest_in_band(old: DataFrame, new: DataFrame, *, window: int, most: int) -> DataFrame:
    """(old_id, new_id, distance): of the new hashes within ``window`` positions, the nearest by Hamming distance, then place."""
    tile = F.floor(F.col("pos") / window)
    left = old.select(F.col("id").alias("old_id"), F.col("pos").alias("old_pos"), F.col("hash").alias("old_hash"), F.explode(F.array(tile - 1, tile, tile + 1)).alias("tile"))
    right = new.select(F.col("id").alias("new_id"), F.col("pos").alias("new_pos"), F.col("hash").alias("new_hash"), tile.alias("tile"))
    distance = F.bit_count(F.col("old_hash").bitwiseXOR(F.col("new_hash"))).cast("long")
    near = left.join(right, "tile").filter(F.abs(F.col("old_pos") - F.col("new_pos")) <= window).withColumn("distance", distance).filter(F.col("distance") <= most)
    best = near.groupBy("old_id").agg(F.min(F.struct("distance", "new_pos", "new_id")).alias("best"))
    return best.select("old_id", "best.new_id", "best.distance")


def one_to_one(candidates: DataFrame) -> DataFrame:
    """Greedy links in reading order: each old image takes its nearest new one that none before took.

    Candidates (book, old_pos, old_id, new_pos, new_id, distance) of one book are folded together;
    a book's images bound the group.
    """

    def fold(book: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for _, rows in book.sort_values(["old_pos", "old_id"]).groupby(["old_pos", "old_id"], sort=True):
            for r in rows.sort_values(["distance", "new_pos", "new_id"]).itertuples():
                if r.new_id not in taken:
                    taken.add(r.new_id)
                    out.append((r.book, r.old_id, r.new_id, r.distance))
                    break
        return pd.DataFrame(out, columns=["book", "old_id", "new_id", "distance"])

    return candidates.groupBy("book").applyInPandas(fold, "book string, old_id long, new_id long, distance long")


def protected_merge(existing: DataFrame, computed: DataFrame, key: str, value: str) -> DataFrame:
    """Decisions by key: existing manual and agent ones stay, others give way to computed ones; ``by`` says which."""
    old = existing.select(key, F.col(value).alias("old"), F.col("by").alias("old_by"))
    new = computed.select(key, F.col(value).alias("new"), F.col("by").alias("new_by"))
    kept = F.col("old_by").isin(*PROVENANCE) | F.col("new_by").isNull()
    return old.join(new, key, "full").select(key, F.when(kept, F.col("old")).otherwise(F.col("new")).alias(value), F.when(kept, F.col("old_by")).otherwise(F.col("new_by")).alias("by"))


def best_provenance(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: manual before agent before the first."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in PROVENANCE.items() for x in p]), F.col("by")), F.lit(2))
    w = Window.partitionBy(key).orderBy(rank, "seq")
    return rows.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")


def number_gaps(rows: DataFrame, by: list[str], order: str, number: str) -> DataFrame:
    """Unnumbered rows between numbers that do not follow each other; none if no number comes after."""
    w = Window.partitionBy(*by).orderBy(order)
    before = F.last(number, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(number, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return rows.withColumn("before", before).withColumn("after", after).filter(F.col(number).isNull() & F.col("after").isNotNull() & (F.col("after") > F.coalesce("before", F.lit(0)) + 1))


def overlap_length(left: Column, right: Column, *, least: int = 40, window: int = 6_000) -> Column:
    """The longest end of one text, collapsed, that begins the other; zero under ``least``."""
    tail, head = F.right(T.collapse(left), F.lit(window)), F.left(T.collapse(right), F.lit(window))
    most = F.least(F.length(tail), F.length(head))
    sizes = F.when(most >= least, F.sequence(F.lit(least), most)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.array_max(F.filter(sizes, lambda k: F.right(tail, k) == F.left(head, k))), F.lit(0)).cast("long")


def aligned(pairs: DataFrame, *, pairing: float = 0.5) -> DataFrame:
    """Order-preserving alignment of token blocks: (doc, source_nth, target_nth, similarity in millionths).

    ``pairs`` has one row per document with arrays of blocks, ``source`` and ``target``, each block
    its tokens joined by spaces.  Equal blocks anchor, runs of equal length pair by place, others
    greedily in order by the best ratio above ``pairing``.  No built-in aligns sequences so, hence
    Python, batch by batch; a document's blocks are one row.
    """

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in source:
            out = []
            for r in batch.itertuples():
                a, b = list(r.source), list(r.target)
                for kind, i, j, k, n in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
                    if kind == "equal" or (kind == "replace" and j - i == n - k):
                        out += [(r.doc, i + d, k + d, similarity(a[i + d], b[k + d])) for d in range(j - i)]
                    elif kind == "replace":
                        at = k
                        for x in range(i, j):
                            best = max(((similarity(a[x], b[y]), -y) for y in range(at, n)), default=(0, 0))
                            if best[0] > pairing * 1_000_000:
                                out.append((r.doc, x, -best[1], best[0]))
                                at = 1 - best[1]
            yield pd.DataFrame(out, columns=["doc", "source_nth", "target_nth", "similarity"])

    return pairs.select("doc", "source", "target").mapInPandas(run, "doc string, source_nth long, target_nth long, similarity long")


#: Lists of one kind that a cell of ``similar`` pairs with another's at most.
CELL = 1_000


def similar(left: DataFrame, right: DataFrame, by: list[str], *, least: float = 0.85) -> DataFrame:
    """(by, id, other, bag) of the token lists (by, id, tokens) of two sides whose bags of tokens are alike.

    ``bag`` is twice the tokens in common over all tokens, never less than the sequence matcher's
    ratio, so a later ``similarity`` of the pairs found misses none.  Lists with the same bag are one
    kind, and only kinds are compared; each pair of them that is alike is then written out as the
    pairs of its lists, in cells of at most about ``CELL`` lists a side, so no task holds a kind whole.
    """
    members, kinds = zip(*[_kinds(side, by) for side in (left, right)], strict=True)
    pairs = _similar_kinds(*kinds, by, least)
    for k, name in ((0, "kind"), (1, "other_kind")):
        sizes = kinds[k].select(*by, F.col("id").alias(name), "cells")
        pairs = pairs.join(sizes, [*by, name]).withColumn(f"{name}_cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells")
    one = members[0].select(*by, "kind", F.col("cell").alias("kind_cell"), "id")
    other = members[1].select(*by, F.col("kind").alias("other_kind"), F.col("cell").alias("other_kind_cell"), F.col("id").alias("other"))
    found = pairs.join(one.hint("merge"), [*by, "kind", "kind_cell"]).join(other.hint("merge"), [*by, "other_kind", "other_kind_cell"])
    return found.select(*by, "id", "other", "bag")


def _kinds(side: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Lists (by, id) with their ``kind``, the least id with the same bag, and cell of it; and kinds (by, id, tokens, cells)."""
    bags = side.filter("id is not null").groupBy(*by, "id").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))
    kinds = bags.groupBy(*by, "tokens").agg(F.min("id").alias("kind"), F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    members = bags.join(kinds.hint("merge"), [*by, "tokens"]).select(*by, "kind", F.pmod(F.xxhash64("id"), "cells").cast("int").alias("cell"), "id")
    return members, kinds.withColumnRenamed("kind", "id")


def _similar_kinds(left: DataFrame, right: DataFrame, by: list[str], least: float) -> DataFrame:
    """(by, kind, other_kind, bag) of kinds (by, id, tokens) that are alike.

    A list of n tokens shares more than ``least * n / (2 - least)`` of them with any that is alike, so
    pairs meet on one of the rarest tokens beyond that number, and common tokens never bring kinds
    together.
    """

    def listed(side: DataFrame) -> DataFrame:
        one = side.select(*by, "id", F.explode("tokens").alias("token"))
        return one.groupBy(*by, "id", "token").agg(F.count(F.lit(1)).alias("n"))

    sides = [listed(left), listed(right)]
    frequency = sides[0].unionByName(sides[1]).groupBy(*by, "token").agg(F.sum("n").alias("f"))
    totals = [s.groupBy(*by, "id").agg(F.sum("n").alias("size")) for s in sides]
    heads = []
    for s, total in zip(sides, totals, strict=True):
        order = Window.partitionBy(*by, "id").orderBy("f", "token")
        ranked = s.join(frequency, [*by, "token"]).withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        kept = ranked.join(total, [*by, "id"]).filter(F.coalesce("before", F.lit(0)) <= F.col("size") * (1 - least / (2 - least)) + 1e-9)
        heads.append(kept.select(*by, "id", "token"))
    met = heads[0].join(heads[1].withColumnRenamed("id", "other"), [*by, "token"]).select(*by, "id", "other").distinct()
    a = met.join(sides[0].withColumnRenamed("n", "a"), [*by, "id"])
    common = a.join(sides[1].select(*by, F.col("id").alias("other"), "token", F.col("n").alias("b")), [*by, "other", "token"])
    shared = common.groupBy(*by, "id", "other").agg(F.sum(F.least("a", "b")).alias("common"))
    sized = shared.join(totals[0], [*by, "id"]).join(totals[1].select(*by, F.col("id").alias("other"), F.col("size").alias("other_size")), [*by, "other"])
    bag = 2 * F.col("common") / (F.col("size") + F.col("other_size"))
    return sized.select(*by, F.col("id").alias("kind"), F.col("other").alias("other_kind"), bag.alias("bag")).filter(F.col("bag") >= least)


def similarity(a: str, b: str) -> int:
    """The sequence matcher's ratio of two token strings in millionths; it depends on the order of the two."""
    return int(SequenceMatcher(None, a.split(), b.split(), autojunk=False).ratio() * 1_000_000)
