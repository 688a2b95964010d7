"""Consecutive numbers over a defined order, without one task for all rows.

A ``row_number`` over the whole table sends every row to one task.  Here the
rows are dealt by ranges of the order and sorted inside them; each row keeps
its range and its place there (``monotonically_increasing_id`` holds both),
and the written table is numbered by adding, per range, the rows of the
ranges before.  What is gathered is one count per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tablework.session import shared_scratch

#: ``monotonically_increasing_id`` keeps the row's place in its lower bits.
PLACE_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str, start: int = 0,
             partitions: int | None = None) -> DataFrame:
    """df and ``name``: start, start + 1, ... in the given order, the same for
    any number of partitions if the order leaves no ties between unlike rows.

    The order should end in columns that tell rows apart, so that a value
    held by many rows can be split over ranges.  The rows are written once
    (ranges are sampled, so df should be cheap to read twice or written
    itself); a lost executor costs tasks of the reading."""
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    path = shared_scratch(spark, "numbered")
    dealt.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    schema = StructType([*df.schema.fields, StructField("__at", LongType())])
    placed = (spark.read.schema(schema).parquet(path)
              .withColumns({"__range": F.shiftright("__at", PLACE_BITS),
                            "__place": F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}))
    counts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    offsets = counts.select("__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    return (placed.join(F.broadcast(offsets), "__range")                            # bounded by the number of ranges
            .withColumn(name, F.col("__before") + F.col("__place") + F.lit(start))
            .drop("__range", "__place", "__before", "__at"))
