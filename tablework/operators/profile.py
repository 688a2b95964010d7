"""Column profile and distribution statistics.

The reference runs 1 + 2 x columns count jobs for its profile and separate
jobs for stats and outliers.  Here: the profile is one aggregate over all
columns (then unpivoted), moments are one aggregate, and the outlier count
is one aggregate on top of the quantile bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from tablework.functions.scalars import pct
from tablework.operators.quantiles import approx_quantiles, exact_quantiles
from tablework.operators.states import batch_state, profile_of


def _as_key(df: DataFrame, name: str):
    """A column as text that is equal exactly when the values are: -0.0 folds
    into 0.0 as Spark's grouping does, and timestamps go by their instant
    (their text repeats when clocks are set back)."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        c = F.when(c == 0, F.lit(0.0)).otherwise(c)
    elif isinstance(kind, TimestampType):
        c = F.unix_micros(c)
    return c.cast("string")


def _long_form(df: DataFrame) -> DataFrame:
    """(column, value-as-text, w=1) rows from one generator, plus one
    (column, null, w=0) marker per column so every column appears even in
    an empty table.  The markers are bounded by the schema width."""
    pairs = [F.struct(F.lit(c).alias("column"), _as_key(df, c).alias("value"))
             for c in df.columns]
    rows = df.select(F.inline(F.array(*pairs))).withColumn("w", F.lit(1))
    markers = df.sparkSession.createDataFrame(
        [(c,) for c in df.columns], "column string").select(
        "column", F.lit(None).cast("string").alias("value"), F.lit(0).alias("w"))
    return rows.unionByName(markers)


def profile_columns_auto(df: DataFrame, exact_columns=(), rsd: float = 0.01) -> DataFrame:
    """G3 for very large tables: the columns that the caller names are
    counted exactly, the others by HyperLogLog; ``distinct_exact`` says
    which."""
    named = {c.lower() for c in exact_columns}
    unknown = named - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"no columns {sorted(unknown)}")
    exact = [F.col(f"`{c}`") for c in df.columns if c.lower() in named]
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in named]
    parts = []
    if exact:
        parts.append(profile_columns(df.select(*exact)).withColumn("distinct_exact", F.lit(True)))
    if rest:
        parts.append(profile_columns(df.select(*rest), approx=True, rsd=rsd).withColumn("distinct_exact", F.lit(False)))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.orderBy(F.desc_nulls_last("null_pct"), "column")


def profile_columns(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per column null_count, null_pct (2 digits), distinct_count, most
    nulls first.  Null counts as one distinct value (as ``select(c).distinct()``
    does); an empty table gives 0 nulls and a null percentage.

    The table is turned into (column, value) rows first, so the plan does
    not grow with the column count.  Exact: (column, value) pairs are
    deduplicated map-side and counted per column (a value held by a third of
    the rows is one row per map task).  ``approx=True``: one HyperLogLog
    sketch per column, all in one aggregate over the typed columns (no rows
    are multiplied, one partial row per task) - the choice for large tables;
    ``states`` keeps such sketches per batch.
    """
    if not df.columns:
        return df.sparkSession.createDataFrame(
            [], "column string, null_count bigint, null_pct double, distinct_count bigint")
    if approx:
        return profile_of(batch_state(df, "", rsd, quantile_columns=()))
    long = _long_form(df)
    is_null = F.col("value").isNull()
    pairs = long.groupBy("column", "value").agg(F.sum("w").alias("c"))
    per = pairs.groupBy("column").agg(
        F.sum("c").alias("n"),
        F.sum(F.when(is_null, F.col("c")).otherwise(0)).alias("null_count"),
        F.count("value").alias("nd"))
    null_count = F.col("null_count").cast("bigint")
    return (per.select(
                "column",
                null_count.alias("null_count"),
                pct(null_count, "n").alias("null_pct"),
                (F.col("nd") + F.when(null_count > 0, 1).otherwise(0)).cast("bigint")
                .alias("distinct_count"))
            .orderBy(F.desc_nulls_last("null_pct"), "column"))


def describe_numeric(df: DataFrame, col: str) -> DataFrame:
    """Typed ``describe``: count, mean, sample stddev, min, max."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"),
                  F.stddev(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"))


def moments(df: DataFrame, col: str, median: str = "approx",
            accuracy: int = 10_000) -> DataFrame:
    """Mean, median, sample stddev, population skewness, population
    excess kurtosis, min, max in one aggregate.

    ``median="approx"`` is ``percentile_approx`` (the reference's choice,
    one pass, bounded memory); ``"exact"`` runs the exact selection first
    (a few counting passes) and puts the value in the aggregate.
    """
    c = F.col(col)
    if median == "exact":
        med = F.lit(exact_quantiles(df, col, [0.5])[0]).cast("double")
    else:
        med = F.percentile_approx(c, F.lit(0.5), F.lit(accuracy)).cast("double")
    return df.agg(F.avg(c).alias("mean"), med.alias("median"),
                  F.stddev(c).alias("stddev"), F.skewness(c).alias("skewness"),
                  F.kurtosis(c).alias("kurtosis"), F.min(c).alias("min"),
                  F.max(c).alias("max"))


def quartiles(df: DataFrame, col: str, method: str = "exact",
              rel_error: float = 0.01) -> tuple[float | None, float | None]:
    """(Q1, Q3); ``exact`` = ``quantile_cont``, ``exact_disc`` =
    ``percentile_disc``, ``approx`` = the reference's ``approxQuantile``
    with 1 % rank error."""
    if method == "exact":
        q1, q3 = exact_quantiles(df, col, [0.25, 0.75])
    elif method == "exact_disc":
        q1, q3 = exact_quantiles(df, col, [0.25, 0.75], discrete=True)
    else:
        q1, q3 = approx_quantiles(df, col, [0.25, 0.75], rel_error)
    return q1, q3


def iqr_outliers(df: DataFrame, col: str, method: str = "exact",
                 rel_error: float = 0.01, k: float = 1.5) -> DataFrame:
    """G10 + P7: bounds ``Q1 - k*IQR``, ``Q3 + k*IQR`` and the rows outside
    them, counted in one aggregate.  An empty column gives nulls, not an
    error."""
    q1, q3 = quartiles(df, col, method, rel_error)
    c = F.col(col)
    if q1 is None:
        lo = hi = F.lit(None).cast("double")
        q1c = q3c = iqr = lo
    else:
        q1, q3 = float(q1), float(q3)
        iqr_v = 0.0 if q1 == q3 else q3 - q1
        q1c, q3c, iqr = F.lit(q1), F.lit(q3), F.lit(iqr_v)
        lo, hi = F.lit(q1 - k * iqr_v), F.lit(q3 + k * iqr_v)
    agg = df.agg(F.count_if((c < lo) | (c > hi)).alias("n_outliers"),
                 F.count(F.lit(1)).alias("n_rows"))
    return agg.select(
        q1c.cast("double").alias("q1"), q3c.cast("double").alias("q3"),
        iqr.cast("double").alias("iqr"), lo.cast("double").alias("lower"),
        hi.cast("double").alias("upper"), "n_outliers", "n_rows",
        pct("n_outliers", "n_rows").alias("outlier_pct"))


def outlier_rows(df: DataFrame, col: str, lower: float, upper: float) -> DataFrame:
    """The rows outside [lower, upper] (pushed down to the scan)."""
    c = F.col(col)
    return df.where((c < F.lit(lower)) | (c > F.lit(upper)))
