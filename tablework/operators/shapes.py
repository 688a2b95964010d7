"""Plot-ready tables (V1-V3): histogram and kernel density as DataFrames.
Drawing is left to the caller; these are the numbers behind the charts.

Nulls, NaN and infinite values have no place on the axis: both tables leave
them out, and :func:`left_out` counts them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _finite(df: DataFrame, col: str) -> DataFrame:
    x = F.col(col).cast("double")
    return df.select(x.alias("x")).where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))


def left_out(df: DataFrame, col: str) -> DataFrame:
    """Rows that histogram and density leave out, by reason."""
    x = F.col(col).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(x.isNull()).alias("n_null"),
                  F.count_if(F.isnan(x)).alias("n_nan"),
                  F.count_if((F.abs(x) == F.lit(math.inf))).alias("n_infinite"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """V1: ``bins`` equal-width bins over [min, max], one row each, empty
    ones included.

    Bounds are one scalar subquery; binning is a per-row expression and the
    count is a combinable aggregate (at most ``bins`` rows per map task).
    The max value falls in the last bin; a constant column has all its rows
    in bin 0 and bins of no width; an empty one has null bounds and zeros.
    """
    base = _finite(df, col)
    st = base.agg(F.struct(F.min("x").alias("mn"), F.max("x").alias("mx")).alias("s")).scalar()
    mn, mx = st.getField("mn"), st.getField("mx")
    width = (mx - mn) / F.lit(float(bins))
    b = F.when(mx == mn, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("x") - mn, width)).cast("int")))
    counts = base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (every.join(counts, "bin", "left")
            .select("bin", (mn + F.col("bin") * width).alias("bin_lo"),
                    (mn + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
            .orderBy("bin"))


def density_curve(df: DataFrame, col: str, points: int = 200, cut: float = 3.0,
                  grid_bins: int | None = 4096) -> DataFrame:
    """V2: Gaussian kernel density on a ``points`` grid over
    [min - cut*h, max + cut*h], Scott bandwidth ``h = sd * n^-0.2``.

    Values are snapped to the centres of ``grid_bins`` equal-width cells over
    [min, max] first, so the work is at most ``grid_bins x points`` whatever
    the number of distinct values.  A value moves by at most half a cell, d,
    which changes the density by at most d * 0.25 / h**2 (the kernel's
    steepest slope is below 0.25 / h**2).  ``grid_bins=None`` asks for the
    exact sum over distinct values, whose work grows with them.

    Partial sums combine before the shuffle.  A constant column, or one with
    fewer than two rows, has no bandwidth: its density is null.
    """
    base = _finite(df, col)
    st = base.agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.stddev("x").alias("sd"),
        F.min("x").alias("mn"), F.max("x").alias("mx")).alias("s")).scalar()
    n = st.getField("n").cast("double")
    mn, mx = st.getField("mn"), st.getField("mx")
    h = F.when(mx > mn, st.getField("sd") * F.pow(n, F.lit(-0.2)))
    lo = mn - F.lit(cut) * F.coalesce(h, F.lit(0.0))
    step = (mx + F.lit(cut) * F.coalesce(h, F.lit(0.0)) - lo) / F.lit(float(points - 1))
    value = F.col("x")
    if grid_bins:
        cell = (mx - mn) / F.lit(float(grid_bins))
        place = F.least(F.lit(grid_bins - 1), F.floor(F.try_divide(F.col("x") - mn, cell)))
        value = F.when(mx == mn, mn).otherwise(mn + (place + F.lit(0.5)) * cell)
    counts = base.groupBy(value.alias("x")).agg(F.count(F.lit(1)).alias("c"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("g")
    gx = lo + F.col("g") * step
    z = F.try_divide(gx - F.col("x"), h)
    norm = F.try_divide(F.lit(1.0 / math.sqrt(2 * math.pi)), n * h)
    return (counts.select("x", "c", grid).groupBy("g")
                  .agg(F.sum(F.col("c") * F.exp(F.lit(-0.5) * z * z)).alias("__s"))
                  .select(F.col("g").alias("point"), gx.alias("x"),
                          (F.col("__s") * norm).alias("density"))
                  .orderBy("point"))
