"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablework.session import shared_scratch

# The white space of the contracts, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Largest side that is ever broadcast, in bytes (counted rows x row width).
BROADCAST_BYTES = 32 << 20


def need(df: DataFrame, *columns: str) -> None:
    """Raise when a column that the operator reads is missing."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def without(df: DataFrame, *columns: str) -> DataFrame:
    """df without columns that an operator is about to add under these names."""
    return df.drop(*[c for c in df.columns if c.lower() in {x.lower() for x in columns}])


def pack(df: DataFrame, *columns: str) -> DataFrame:
    """(row, columns): df's rows as one struct beside the columns that an
    operator reads, so its own columns cannot clash with others of df."""
    need(df, *columns)
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[F.col(c).alias(c) for c in columns])


def unpack(df: DataFrame, **outputs: Column) -> DataFrame:
    """The columns of the packed rows and the outputs, which replace columns
    of their names."""
    names = {c.lower() for c in outputs}
    fields = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in names]
    return df.select(*[F.col("row").getField(c).alias(c) for c in fields],
                     *[value.alias(name) for name, value in outputs.items()])


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; null: none."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACES))


def let(value: Column, body) -> Column:
    """body(x) with x bound to value, which is then worked out once per row
    (inside higher-order functions a plain expression is worked out again
    for each element)."""
    return F.get(F.transform(F.array(value), body), 0)


def handover(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under the shared checkpoint folder and read
    again: cuts the lineage and survives lost executors."""
    spark: SparkSession = df.sparkSession
    path = shared_scratch(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._handed_over_at = path
    return table


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, for ``mapInArrow``; then the memory that pyarrow keeps for later
    goes back, since a worker stays, idle, beside the steps that follow."""
    def then(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return then


def discard(*tables: DataFrame) -> None:
    """Remove hand-overs whose readers are written.  Only tables that
    ``handover`` returned are removed, through the file system of their path."""
    for table in tables:
        path = getattr(table, "_handed_over_at", None)
        if path is None:
            raise ValueError("not a hand-over")
        spark = table.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, row_bytes: int, bound: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its counted size is within the bound, else
    df itself, and Spark shuffles it.  The size is ``row_bytes`` a row, for
    the columns of fixed width, and the counted bytes of its texts.  df
    should be a written table."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    row = df.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(f"t{i}") for i, t in enumerate(texts)]).first()
    return F.broadcast(df) if row["n"] * row_bytes + sum(row[1:]) <= bound else df
