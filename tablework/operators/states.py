"""Mergeable profile states (G3, G8-G10): what a batch leaves behind so that
the profile and the quantiles of a whole table need not read its rows again.

A state is one row per batch and column: rows, nulls, a HyperLogLog sketch of
the values and, for numbers, a KLL quantile sketch with the extremes.  States
of batches are appended as they arrive and merged by column; their size is
the columns' number times the sketches' (some 25 KB), whatever the rows.
All columns are sketched in one aggregate, each in its own type, and every
task sends one partial row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType)

from tablework.functions.scalars import pct

STATE = ("batch string, column string, n_rows long, n_null long, values binary, "
         "n_numbers long, numbers binary, low double, high double")
#: Size of the quantile sketch: rank error of about 0.06 % at 99 %.
KLL_K = 4096
#: Rank error of a merged sketch that brackets allow for, as a share.
KLL_ERROR = 2e-3
EXACT_INT = 2**53


def log_buckets(rsd: float) -> int:
    """Buckets (as a power of two) of a HyperLogLog sketch whose relative
    standard deviation is at most ``rsd``."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def _hashed(column: Column, kind: DataType) -> Column:
    """The value's 64-bit hash, null for null; -0.0 is 0.0, as for grouping."""
    if isinstance(kind, (DoubleType, FloatType)):
        column = F.when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)
    return F.when(column.isNotNull(), F.xxhash64(column))


def _number(column: Column, kind: DataType) -> Column | None:
    """The value as a double if that is exact for the type; NaN is null.
    Longs beyond 2^53 have no quantile state."""
    if isinstance(kind, (ByteType, ShortType, IntegerType)):
        return column.cast("double")
    if isinstance(kind, LongType):
        return F.when(column.between(-EXACT_INT, EXACT_INT), column.cast("double"))
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(~F.isnan(column), column.cast("double"))
    return None


def batch_state(df: DataFrame, batch: str, rsd: float = 0.01, quantile_columns=None) -> DataFrame:
    """The state (STATE) of one batch of rows.  ``quantile_columns``: the
    numeric columns that get a quantile sketch (default: all of them)."""
    wanted = None if quantile_columns is None else {c.lower() for c in quantile_columns}
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    empty = F.lit(None).cast("binary"), F.lit(None).cast("double")
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"c{i}"), F.hll_sketch_agg(_hashed(c, f.dataType), log_buckets(rsd)).alias(f"v{i}")]
        number = _number(c, f.dataType) if wanted is None or f.name.lower() in wanted else None
        if number is not None:
            aggs += [F.count(number).alias(f"k{i}"), F.kll_sketch_agg_double(number, KLL_K).alias(f"q{i}"),
                     F.min(number).alias(f"l{i}"), F.max(number).alias(f"h{i}")]
            quantile = [F.col(f"k{i}"), F.when(F.col(f"k{i}") > 0, F.col(f"q{i}")), F.col(f"l{i}"), F.col(f"h{i}")]
        else:
            quantile = [F.lit(0).cast("long"), empty[0], empty[1], empty[1]]
        parts = [F.lit(batch), F.lit(f.name), F.col("n"), F.col("n") - F.col(f"c{i}"), F.col(f"v{i}"), *quantile]
        rows.append(F.struct(*[p.alias(x.split()[0]) for p, x in zip(parts, STATE.split(", "))]))
    if not rows:
        return df.sparkSession.createDataFrame([], STATE)
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def append_state(df: DataFrame, path: str, batch: str, rsd: float = 0.01, quantile_columns=None) -> DataFrame:
    """Add a batch's state to the states at ``path``; returns all of them.
    A batch that is already there is refused, so nothing counts twice."""
    spark = df.sparkSession
    state = batch_state(df, batch, rsd, quantile_columns)
    root = path.rstrip("/")
    # one folder per batch: a second writer of the same batch meets "errorifexists"
    state.coalesce(1).write.mode("errorifexists").parquet(f"{root}/of={batch}")
    return read_states(spark, root)


def read_states(spark, path: str) -> DataFrame:
    """All states appended at ``path``."""
    return spark.read.schema(STATE).parquet(path.rstrip("/")).select(*[x.split()[0] for x in STATE.split(", ")])


def merged(states: DataFrame) -> DataFrame:
    """One state per column of all batches.  Batches may differ in their
    columns; a column counts nulls only where it exists."""
    return states.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("values", True).alias("values"),
        F.sum("n_numbers").alias("n_numbers"), F.kll_merge_agg_double("numbers", KLL_K).alias("numbers"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def profile_of(states: DataFrame) -> DataFrame:
    """G3 from states alone: column, null_count, null_pct, distinct_count,
    most nulls first.  Null counts as one distinct value, as in
    ``profile_columns``."""
    null = F.col("n_null")
    return (merged(states).select(
                "column", null.cast("long").alias("null_count"), pct(null, F.col("n_rows")).alias("null_pct"),
                (F.hll_sketch_estimate("values") + F.when(null > 0, 1).otherwise(0)).cast("long").alias("distinct_count"))
            .orderBy(F.desc_nulls_last("null_pct"), "column"))


def brackets(states: DataFrame, column: str, ranks_of) -> tuple[int, dict]:
    """(numbers, {rank: (low, high)}) of a column: values at or below, and at
    or above, each 0-based rank that ``ranks_of(numbers)`` asks for, from the
    merged sketch and its rank error."""
    state = merged(states.where(F.col("column") == column))
    head = state.select("n_numbers", "low", "high").first()
    if head is None or not head["n_numbers"]:
        return 0, {}
    n = head["n_numbers"]
    ranks = sorted(ranks_of(n))
    shares = [min(1.0, max(0.0, k / max(1, n - 1) + d)) for k in ranks for d in (-KLL_ERROR, KLL_ERROR)]
    values = state.select(F.kll_sketch_get_quantile_double("numbers", F.array(*[F.lit(s) for s in shares])).alias("v")).first()["v"]
    found = {}
    for i, k in enumerate(ranks):
        low = head["low"] if shares[2 * i] <= 0 else values[2 * i]
        high = head["high"] if shares[2 * i + 1] >= 1 else values[2 * i + 1]
        found[k] = (low, high)
    return n, found
