"""Sampling and splitting (M1-M3).

Hash forms select rows by a keyed draw: the same rows on 1, 2 or 1000
partitions, after a retry, and in a second engine.  Native forms
(``sample``/``randomSplit``) are faster to write but follow the layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.draws import sample_mask, unit_draw


def sample_hash(df: DataFrame, keys, fraction: float, seed: int = 42) -> DataFrame:
    """M1 + M3: Bernoulli(fraction) rows by key; fraction >= 1 is a no-op."""
    if fraction >= 1.0:
        return df
    return df.where(sample_mask(keys, seed, fraction))


def sample_native(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """M1 native: ``DataFrame.sample`` (rows depend on the layout)."""
    if fraction >= 1.0:
        return df
    return df.sample(fraction=fraction, seed=seed)


def split_column(keys, weights=(0.8, 0.2), seed: int = 42, names=None):
    """Index (or name) of the split each row falls in, from one draw; the
    splits are disjoint and cover every row with a non-null key."""
    total = float(sum(weights))
    u = unit_draw(keys, seed, "split")
    names = list(names) if names else list(range(len(weights)))
    expr = None
    edge = 0.0
    for w, name in zip(weights[:-1], names[:-1]):
        edge += w / total
        cond = u < F.lit(edge)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def split_hash(df: DataFrame, keys, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """M2: hash split; each part is a filter of the same input (no cache
    needed for consistency: the draw is deterministic)."""
    col = split_column(keys, weights, seed)
    return [df.where(col == F.lit(i)) for i in range(len(weights))]


def split_native(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """M2 native: ``randomSplit`` as the reference does it."""
    return df.randomSplit(list(weights), seed=seed)
