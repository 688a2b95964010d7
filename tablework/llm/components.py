"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import discard, handover


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node
    that it is connected to.

    The large-star step links a node's larger neighbours to its smallest
    neighbour, the small-star step its smaller ones; both keep what is
    connected, and repeated they end in stars.  Minima combine before the
    shuffle and the joins may be split, so a node with very many links does
    not meet in one task."""
    stars = handover(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "edges")
    state = _state(stars)
    while state[0]:
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = handover(large, "edges")
        discard(stars)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b")))
                 .filter("a <> b").distinct())
        stars = handover(small, "edges")
        discard(large)
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
