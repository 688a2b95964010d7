"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt round-robin to this many partitions (none: as they are).

    For inputs of few splits and CPU-heavy or iterative work; the number is
    the caller's, since results that follow the layout (forest bootstraps,
    increasing ids) follow it."""
    return df.repartition(partitions) if partitions else df
