"""Mixing sources to target weights by entropy balancing (DataFrame functions).

Among all rates r >= 0 (expected copies, at most ``most``) whose words meet
each source's token target, entropy balancing takes the ones nearest to one
copy each, sum r log r - r.  The dual is convex with one multiplier per
source, and the rates are exponentially tilted: r = min(most, exp(a * size)).
Newton iterations on the dual are Spark aggregations over the histogram of
document sizes (source, size, n), which is exact since documents of one size
in one source share a rate; a bracket guards each step.

Rates become copies by running sums over the cells from large sizes to
small: a cell gets what rounding the expected copies up to it adds to
rounding those before it.  Copies are then never more than half a copy off
at any size, words by half the largest document; one cell per power of two
of the sizes, from large to small, takes what is missing or over, so a
source ends within half its smallest document of what its rates ask where
these cells have room.  Inside a cell the documents with the smallest hashes
of doc_id take the odd copies.  Sums are decimal, so the order of partial
sums changes nothing and reruns agree.

Defined results: a null text has size 0, documents of size 0 keep one copy
and take no words; a null source is a source of its own, ordered last; of
repeated rows all or none take an odd copy; a very long text is split into
words inside its row; an empty table gives an empty table; other columns pass through, but those the operator adds are replaced.
The histogram has at most one row per source and distinct size; sources are
ranked by ranges and their running sums go over blocks, so no task holds
all of either.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import handover, need, pack, small, unpack, word_array
from tablework.llm.conversation_trie import blocked
from tablework.operators.numbering import numbered

WEIGHTS = (1, 2, 3)
MOST = 3
MAX_STEPS = 60
BLOCK = 1024                # sizes whose running sums one window holds
EXACT = "decimal(38,12)"
ADDED = ["size", "source_size", "target", "copies", "taken"]


def source_key(source: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(cells: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size, target): all words shared by weight, no source
    above ``most`` times its size, the excess shared again by weight.

    Sorted by size / weight, the sources that stop are a prefix: a source
    stops if an equal share per weight of what the prefix before it leaves
    would go beyond its bound."""
    totals = handover(cells.groupBy("key").agg(F.max("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size")),
                      "mix-totals")
    ranked = numbered(totals, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    weighted = handover(ranked.withColumns({"weight": weight, "bound": F.col("source_size") * most}), "mix-weighted")
    placed = numbered(weighted, [F.col("bound") / F.col("weight"), F.col("key")], "place").withColumn("_all", F.lit(0))
    upto = blocked(placed, "_all", F.floor(F.col("place") / BLOCK), [F.col("place")],
                   {"bounds": F.col("bound"), "heads": F.col("weight")})
    whole = weighted.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(whole["size"] or 0) - F.col("bounds") + F.col("bound")               # what the sources before it leave
    heads = F.lit(whole["weight"] or 0) - F.col("heads") + F.col("weight")
    stops = handover(upto.select("key", "source_size", "weight", "bound", (F.col("bound") * heads < left * F.col("weight")).alias("stops")),
                     "mix-stops")
    rest = stops.agg(F.sum(F.when(F.col("stops"), F.col("bound")).otherwise(0)).alias("held"),
                     F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).alias("weight")).first()
    share = ((whole["size"] or 0) - (rest["held"] or 0)) / max(1, rest["weight"] or 0)
    return stops.select("key", "source_size",
                        F.when(F.col("stops"), F.col("bound").cast("double"))
                        .otherwise(F.lit(float(share)) * F.col("weight")).alias("target"))


def rate(multiplier: Column, size: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * size, F.lit(math.log(most) + 1))))


def solve(cells: DataFrame, goal: DataFrame, most: int = MOST, max_steps: int = MAX_STEPS) -> DataFrame:
    """goal plus ``a``, the multiplier of each source: Newton on
    log(words of the rates) - log(target), bisected when a step leaves the
    bracket.  Each step is one aggregation, handed over as a table."""
    x, n = F.col("size"), F.col("n")
    spread = (cells.filter("size > 0").groupBy("key")
              .agg(F.min("size").alias("least"),
                   (F.sum((x * x * n).cast("decimal(38,0)")) / F.sum((x * n).cast("decimal(38,0)")))
                   .cast("double").alias("mean")))
    gap = F.log(F.col("target") / F.col("source_size"))
    state = (goal.filter("source_size > 0").join(spread, "key")
             .withColumns({"low": F.when(gap < 0, gap / F.col("least")).otherwise(0.0),
                           "high": F.when(gap < 0, 0.0).otherwise(math.log(most) / F.col("least")),
                           "full": F.col("target") >= F.col("source_size") * most,
                           "a": gap / F.col("mean")})
             .withColumn("a", F.when(F.col("full"), F.col("high")).otherwise(F.col("a")))
             .withColumn("done", F.col("full")))
    state = handover(state, "mix-state")
    for _ in range(max_steps):
        open_ = state.filter(~F.col("done"))
        tilted = rate(F.col("a"), x, most)
        words = (cells.filter("size > 0").join(small(open_.select("key", "a"), 64), "key")
                 .groupBy("key").agg(
                     F.sum((n * x * tilted).cast("decimal(30,6)")).cast("double").alias("words"),
                     F.sum(F.when(tilted < most, n * x * x * tilted).otherwise(0.0).cast("decimal(30,6)"))
                     .cast("double").alias("slope")))
        moved = state.join(words, "key", "left")
        off = F.col("words") - F.col("target")
        near = F.abs(off) <= F.greatest(F.lit(0.01), F.col("target") * 1e-9)
        low = F.when(off <= 0, F.col("a")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("a")).otherwise(F.col("high"))
        step = F.col("a") - F.try_divide(F.log(F.col("words") / F.col("target")) * F.col("words"), F.col("slope"))
        state = handover(
            moved.withColumns({"low": F.when(F.col("done"), F.col("low")).otherwise(low),
                               "high": F.when(F.col("done"), F.col("high")).otherwise(high),
                               "_step": step})
            .withColumns({"a": F.when(F.col("done") | near, F.col("a"))
                         .when((F.col("_step") > F.col("low")) & (F.col("_step") < F.col("high")), F.col("_step"))
                         .otherwise((F.col("low") + F.col("high")) / 2),
                         "done": F.col("done") | near})
            .drop("words", "slope", "_step"), "mix-state")
        if state.filter(~F.col("done")).isEmpty():
            break
    return goal.join(state.select("key", "a"), "key", "left")




def cell_copies(cells: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """cells plus ``total``, the copies that a cell's documents share.  The
    running sums go over blocks of sizes, then over the blocks, so they cost
    in proportion to a source's distinct sizes and meet in no one task."""
    expected = (F.col("n") * rate(F.col("a"), F.col("size"), most)).cast(EXACT)
    rated = (cells.filter("size > 0").join(small(solved.select("key", "a"), 64), "key")
             .select("key", "size", "n", expected.alias("expected")))
    summed = blocked(rated, "key", -F.floor(F.col("size") / BLOCK), [F.col("size").desc()], {"upto": F.col("expected")})
    rounded = F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("expected") + 0.5)
    placed = handover(summed.withColumn("total", rounded.cast("long")), "mix-placed")
    # what is missing, and the smallest size of each power of two to take it
    missing = placed.groupBy("key").agg(F.sum(((F.col("expected") - F.col("total")) * F.col("size")).cast(EXACT)).alias("missing"))
    band = F.floor(F.log2("size")).cast("int")
    takers = (placed.groupBy("key", band.alias("band")).agg(F.min(F.struct("size", "n", "total")).alias("c"))
              .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("band", "c")), False).alias("bands")))    # at most 64

    def take(acc, b):
        size, n, total = b["c"]["size"], b["c"]["n"], b["c"]["total"]
        more = F.least(F.greatest(F.round(acc["missing"] / size).cast("long"), -total), n * most - total)
        return F.struct((acc["missing"] - more * size).cast("double").alias("missing"),
                        F.concat(acc["out"], F.array(F.struct(size.alias("_size"), more.alias("more")))).alias("out"))

    start = F.struct(F.col("missing").cast("double").alias("missing"), F.array().cast("array<struct<_size:bigint,more:bigint>>").alias("out"))
    moved = (takers.join(missing, "key").select("key", F.inline(F.aggregate("bands", start, take, lambda s: s["out"])))
             .filter("more <> 0").withColumnRenamed("key", "_key"))
    met = placed.join(moved, (F.col("key") == F.col("_key")) & (F.col("size") == F.col("_size")), "left")
    return (met.select("key", "size", "n", (F.col("total") + F.coalesce("more", F.lit(0))).alias("total"))
            .unionByName(cells.filter("size = 0").select("key", "size", "n", F.col("n").alias("total"))))


def odd_copies(slim: DataFrame, copies: DataFrame) -> DataFrame:
    """Cells with copies per document (``base``) and the last (hash, doc_id)
    that takes one more (``last_hash``, ``last_id``; null: none does).

    Documents are ranked by hash in two steps, first the counts of 256 hash
    ranges, then the rows of the one range where the odd copies run out, so
    a cell with a large share of all rows is not sorted in one task."""
    odd = copies.select("key", "size", F.floor(F.col("total") / F.col("n")).cast("long").alias("base"),
                        (F.col("total") % F.col("n")).alias("odd"))
    ranged = slim.select("key", "size", "doc_id", F.xxhash64("doc_id").alias("hash")) \
        .withColumn("part", F.shiftright("hash", 56))
    upto = F.sum("m").over(Window.partitionBy("key", "size").orderBy("part"))
    ends = (ranged.groupBy("key", "size", "part").agg(F.count("*").alias("m"))
            .withColumn("upto", upto)
            .join(small(odd.filter("odd > 0"), 96), ["key", "size"])
            .filter((F.col("upto") >= F.col("odd")) & (F.col("upto") - F.col("m") < F.col("odd")))
            .select("key", "size", "part", (F.col("odd") - F.col("upto") + F.col("m")).alias("take")))
    at = F.row_number().over(Window.partitionBy("key", "size").orderBy("hash", F.col("doc_id").asc_nulls_first()))
    last = (ranged.join(ends, ["key", "size", "part"]).withColumn("at", at).filter(F.col("at") == F.col("take"))
            .select("key", "size", F.col("hash").alias("last_hash"), F.col("doc_id").alias("last_id")))
    return odd.drop("odd").join(last, ["key", "size"], "left")


def size_of(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """docs (doc_id, text, source, ...) plus ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` = copies x size."""
    need(docs, "doc_id", "text", "source")
    sized = pack(docs, "doc_id", "text", "source").withColumns(
        {"key": source_key(F.col("source")), "size": size_of(F.col("text"))}).drop("text")
    slim = handover(sized.select("key", "source", "doc_id", "size"), "mix-sizes")
    cells = handover(slim.groupBy("key", "size").agg(F.max("source").alias("source"), F.count("*").alias("n")),
                     "mix-cells")
    goal = handover(targets(cells, weights, most), "mix-targets")
    solved = handover(solve(cells, goal, most), "mix-solved")
    copies = handover(cell_copies(cells, solved, most), "mix-copies")
    ruled = handover(odd_copies(slim, copies).join(goal, "key"), "mix-rule").withColumnsRenamed(
        {"key": "_rule_key", "size": "_rule_size"})
    hash_ = F.xxhash64("doc_id")
    one_more = (F.col("last_hash").isNotNull()
                & ((hash_ < F.col("last_hash")) | ((hash_ == F.col("last_hash")) & (
                    F.col("doc_id").isNull() | (F.col("doc_id") <= F.col("last_id"))))))
    met = sized.join(small(ruled, 160), (F.col("key") == F.col("_rule_key")) & (F.col("size") == F.col("_rule_size")))
    copies = F.col("base") + F.coalesce(one_more, F.lit(False)).cast("long")
    return unpack(met, size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"),
                  copies=copies, taken=copies * F.col("size"))


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, without the columns of ``mix``."""
    rows = pack(mixed.filter("copies > 0"), "copies")
    again = rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return unpack(again).drop(*ADDED)
