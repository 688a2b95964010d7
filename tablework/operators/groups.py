"""Grouped reports, shares, rankings.

Every aggregate here is algebraic (count, sum, avg, stddev, min/max), so
Spark combines map-side before the shuffle: a route holding a third of all
rows still sends one partial row per map task.  Distinct counts use Spark's
two-level plan (dedup on (group, value) first), so a hot group is spread over
its values, not sent to one task.  Orderings always end with the key so ties
have a defined order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_volume(df: DataFrame, group: str = "route_short_name",
                 trip: str = "trip_id") -> DataFrame:
    """G2 + T1: stop events and distinct trips per group, most events first."""
    return (df.groupBy(group)
              .agg(F.count(F.lit(1)).alias("num_stop_events"),
                   F.count_distinct(trip).alias("num_trips"))
              .orderBy(F.desc("num_stop_events"), F.asc_nulls_last(group)))


def group_stats(df: DataFrame, group: str = "route_short_name",
                value: str = "delay_minutes", flag: str = "is_disrupted") -> DataFrame:
    """Count, mean, sample stddev and flagged count per group, highest
    mean first (nulls last)."""
    return (df.groupBy(group)
              .agg(F.count(F.lit(1)).alias("num_records"),
                   F.avg(value).alias("avg_delay"),
                   F.stddev(value).alias("stddev_delay"),
                   F.sum(F.col(flag).cast("int")).cast("bigint").alias("num_disrupted"))
              .orderBy(F.desc_nulls_last("avg_delay"), F.asc_nulls_last(group)))


def topk_groups(df: DataFrame, group: str = "route_short_name",
                value: str = "delay_minutes", k: int = 10,
                min_count: int = 100) -> DataFrame:
    """The ``k`` groups with the highest mean among groups with more
    than ``min_count`` rows (``TakeOrderedAndProject``: a bounded top-k)."""
    return (df.groupBy(group)
              .agg(F.avg(value).alias("avg_delay"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > F.lit(min_count))
              .orderBy(F.desc_nulls_last("avg_delay"), F.asc_nulls_last(group))
              .limit(k))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Share of each value (``value_counts(normalize=True)``).

    The total is a non-correlated scalar subquery over the grouped counts
    (one value inlined, no join); its plan repeats the grouping's shuffle,
    which Spark reuses, so the table is scanned once.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (counts.withColumn("share", F.try_divide(F.col("n").cast("double"), total))
                  .orderBy(F.desc("n"), F.asc_nulls_last(col)))


def distinct_keys(df: DataFrame, cols) -> DataFrame:
    """Distinct rows of a projection."""
    return df.select(*cols).distinct()


def best_row(df: DataFrame, metric: str, lowest: bool = True) -> DataFrame:
    """T5: the row with the best metric (``idxmin``) as one aggregate."""
    pick = F.min_by if lowest else F.max_by
    cols = df.columns
    return (df.agg(pick(F.struct(*cols), F.col(metric)).alias("best"))
              .select("best.*"))
