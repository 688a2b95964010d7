"""Scans and sinks (CSV feeds, Parquet tables, star outputs, metrics CSV).

CSV feeds are read with every column as text *by header name* and then
projected/cast to the declared schema with ``try_cast``: a reordered header
binds by name, ids keep leading zeros, and a malformed value becomes null
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, IntegralType, LongType,
                               StringType, StructField, StructType)

#: Column that carries the cells of a row that its types refuse.
REJECTS = "_rejects"


def typed_projection(df: DataFrame, schema: StructType,
                     keep_extra: bool = True, rejects: Column | None = None) -> DataFrame:
    """Bind text columns to ``schema`` by name.

    Declared columns come first in declared order, cast with ``try_cast``
    (null on bad input, surrounding blanks trimmed for numbers); a declared
    column missing from the input is left out, so later steps see which
    columns exist; undeclared input columns pass through as text when
    ``keep_extra``.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f"`{f.name}`")
            cols.append((c if isinstance(f.dataType, StringType)
                         else c.try_cast(f.dataType)).alias(f.name))
    if keep_extra:
        declared = {f.name for f in schema.fields}
        cols += [F.col(f"`{c}`") for c in df.columns if c not in declared]
    if rejects is not None:
        cols.append(_refused_cells([f for f in schema.fields if f.name in present], rejects).alias(REJECTS))
    return df.select(*cols)


def _refused_cells(fields: list[StructField], source: Column) -> Column:
    """Cells with a text that their type refuses, in the declared order."""
    cells = []
    for f in fields:
        if isinstance(f.dataType, StringType):
            continue
        raw = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        reason = F.lit(f"not {kind}")
        if isinstance(f.dataType, IntegralType):
            reason = F.when(raw.rlike(r"^\s*[+-]?\d+\s*$"), F.lit(f"out of range of {kind}")).otherwise(reason)
        cell = F.struct(source.alias("file"), F.lit(f.name).alias("column"), raw.alias("raw"), reason.alias("reason"))
        cells.append(F.when(raw.isNotNull() & (F.btrim(raw) != "") & raw.try_cast(f.dataType).isNull(), cell))
    empty = F.array().cast("array<struct<file:string,column:string,raw:string,reason:string>>")
    return F.filter(F.array(*cells), lambda c: c.isNotNull()) if cells else empty


# ------------------------------------------------------------- inference

#: Inferred types from the narrowest to the widest, with the texts they take.
#: A leading zero makes a text (``001`` is an id), as do more digits than a long holds.
LATTICE = [(IntegerType(), r"[+-]?(0|[1-9][0-9]*)"), (LongType(), r"[+-]?(0|[1-9][0-9]*)"),
           (DoubleType(), r"[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"),
           (BooleanType(), r"(?i)true|false")]


def infer_schema(raw: DataFrame) -> StructType:
    """The narrowest type of the lattice that takes every non-blank cell
    of a text column (text if none does, or if there are no cells); all
    columns are folded in one aggregate, so the files are read once."""
    tests = []
    for i, c in enumerate(raw.columns):
        cell = F.when(F.btrim(F.col(f"`{c}`")) != "", F.btrim(F.col(f"`{c}`")))
        for k, (kind, pattern) in enumerate(LATTICE):
            fits = cell.rlike(f"^({pattern})$")
            if isinstance(kind, IntegralType):
                fits = fits & cell.try_cast(kind).isNotNull()
            elif isinstance(kind, DoubleType):
                digits = F.length(F.regexp_replace(F.regexp_extract(cell, r"^[+-]?([0-9.]*)", 1), r"\.", ""))
                fits = fits & ~(cell.rlike(r"^[+-]?[0-9]+$") & cell.try_cast("bigint").isNull()) & (digits <= 17)
            tests.append(F.bool_and(fits).alias(f"t{i}_{k}"))
    found = raw.agg(*tests).first() if tests else None
    fields = []
    for i, c in enumerate(raw.columns):
        kind = next((kind for k, (kind, _) in enumerate(LATTICE) if found[f"t{i}_{k}"]), StringType())
        fields.append(StructField(c, kind, True))
    return StructType(fields)


def read_feed(spark: SparkSession, path: str, schema: StructType | None = None,
              infer: bool | str = False, keep_extra: bool = True, rejects: bool = False) -> DataFrame:
    """CSV with a header.

    ``schema`` given: columns bound by header name and cast (S1).  No schema
    and ``infer=True``: types by :func:`infer_schema`, which keeps ids like
    ``001`` as text; ``infer="spark"``: Spark's ``inferSchema`` (S2 as the
    reference does it; it turns id ``001`` into 1).  No schema, no inference:
    all text.  ``rejects``: adds ``_rejects`` (see :func:`write_feed`).
    """
    # enforceSchema=false: in a folder of several files, each file's header
    # is checked against the column names instead of binding by position.
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("enforceSchema", False))
    if schema is None and infer == "spark":
        return reader.option("inferSchema", True).csv(path)
    raw = reader.csv(path)  # all StringType, names from the header
    if schema is None and infer:
        schema = infer_schema(raw)
    if schema is None:
        return raw
    return typed_projection(raw, schema, keep_extra=keep_extra,
                            rejects=F.col("_metadata.file_name") if rejects else None)


def write_feed(df: DataFrame, path: str, min_rows: int = 100_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1 + S5 + S8 in one pass over the feed: (table, rejects, gate).

    ``df`` comes from ``read_feed(rejects=True)``.  The typed rows are written
    with their refused cells beside them; the table is that without the cells,
    the rejects (file, column, raw, reason) are those cells, read from the
    written column alone, and the gate's count is taken while writing."""
    rows, gate = gated(df, min_rows)
    write_table(rows, path)
    whole = read_table(df.sparkSession, path)
    return whole.drop(REJECTS), whole.select(F.inline(REJECTS)), gate()


def read_feed_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five timetable files of a feed folder (``stop_times.txt``,
    ``trips.txt``, ``routes.txt``, ``stops.txt``, ``calendar.txt``), each
    bound to its declared schema by header name.  A missing file is an error
    that names it."""
    from tablework.sources.schemas import FEED_SCHEMAS
    out = {}
    for name, schema in FEED_SCHEMAS.items():
        path = f"{folder.rstrip('/')}/{name}.txt"
        try:
            df = read_feed(spark, path, schema)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
            raise FileNotFoundError(f"{path} not found: the feed needs it") from e
        out[name] = df
    return out


def read_table(spark: SparkSession, path: str, step: str | None = None,
               schema: StructType | None = None) -> DataFrame:
    """S3 + S9: Parquet scan; a missing input names the step that makes it.

    Partition columns come from folder names, whose types Spark guesses
    (``001`` becomes 1); pass the written ``schema`` to keep them as they
    were."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            hint = f" - run the '{step}' step first" if step else ""
            raise FileNotFoundError(f"{path} not found{hint}") from e
        raise


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, mode: str = "overwrite",
                rebalance: bool = True) -> str:
    """Parquet sink written by executors.

    ``partition_by`` gives directory pruning for low-cardinality keys.
    Written as is, every task would open one file per key value it holds
    (tasks x values small files); with ``rebalance`` the rows are first
    grouped by the partition columns with AQE's rebalance, which also
    splits a value holding a large share of the rows over several tasks.
    ``sort_by`` clusters rows inside each file so Parquet min/max statistics
    prune row groups for lookups on those columns (no extra shuffle: the
    sort is within the partitions the plan already has).
    """
    out = df
    if partition_by and rebalance:
        out = out.hint("rebalance", *partition_by)
    out = out.sortWithinPartitions(*sort_by) if sort_by else out
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_star(star: dict[str, DataFrame], target: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every table of a star (routes / trips / delay_events) as
    Parquet under ``target``; each table is written by executors."""
    paths = {}
    for name, df in star.items():
        paths[name] = write_table(df, f"{target.rstrip('/')}/{name}", mode=mode)
    return paths


PUBLISHED = "_published"


def publish_star(star: dict[str, DataFrame], target: str) -> dict[str, str]:
    """S6, staged: the tables go to a folder of their own under ``target``,
    and one small table written last (``_published/version=n``) names it.
    Readers take the newest name, so they see the old star whole until the
    new one is whole; a run that fails in between changes nothing for them.
    Two writers of one version cannot both succeed."""
    spark, root = next(iter(star.values())).sparkSession, target.rstrip("/")
    folder = f"star-{uuid.uuid4().hex[:12]}"
    paths = write_star(star, f"{root}/{folder}")
    found = _published(spark, root)
    version = found[0] + 1 if found else 1
    name = spark.createDataFrame([(folder, sorted(paths))], "folder string, tables array<string>")
    name.coalesce(1).write.mode("errorifexists").parquet(f"{root}/{PUBLISHED}/version={version}")
    return paths


def _published(spark: SparkSession, root: str):
    """(version, folder, tables) of the newest published star, if any."""
    try:
        rows = spark.read.schema("folder string, tables array<string>, version long").parquet(f"{root}/{PUBLISHED}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    row = rows.orderBy(F.desc("version")).first()
    return (row["version"], row["folder"], row["tables"]) if row else None


def read_star(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The newest star that :func:`publish_star` finished under ``target``."""
    root = target.rstrip("/")
    found = _published(spark, root)
    if found is None:
        raise FileNotFoundError(f"no star is published at {target} - run the 'star' step first")
    return {name: read_table(spark, f"{root}/{found[1]}/{name}", step="star") for name in found[2]}


# Bucket key per star table: trips and events share trip_id buckets, so the
# event-trip join of the reports reads co-partitioned tables without a shuffle.
STAR_BUCKET_KEYS = {"routes": "route_id", "trips": "trip_id", "delay_events": "trip_id"}


def write_star_catalog(star: dict[str, DataFrame], database: str, buckets: int = 64,
                       mode: str = "overwrite") -> dict[str, str]:
    """S6, catalog form: each table saved with ``bucketBy(buckets, key)`` and
    sorted by the key.  Size ``buckets`` so one bucket file is ~128-512 MB
    at the target scale; both sides of a join must use the same count."""
    spark = next(iter(star.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = {}
    for name, df in star.items():
        key = STAR_BUCKET_KEYS.get(name)
        full = f"`{database}`.`{name}`"
        w = df.write.mode(mode).format("parquet")
        if key and key in df.columns:
            w = w.bucketBy(buckets, key).sortBy(key)
        w.saveAsTable(full)
        names[name] = full
    return names


def drop_star_catalog(spark: SparkSession, database: str) -> None:
    """Remove a star written by :func:`write_star_catalog`, tables included."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def write_star_jdbc(star: dict[str, DataFrame], url: str, properties: dict,
                    num_partitions: int = 8, mode: str = "overwrite") -> dict[str, str]:
    """S6, relational-store form (the reference names JDBC as the scalable
    way): executors insert in at most ``num_partitions`` connections (the
    writer's option; the stage before it keeps its own parallelism)."""
    for name, df in star.items():
        df.write.option("numPartitions", num_partitions).jdbc(url, name, mode=mode, properties=properties)
    return {name: name for name in star}


def write_metrics(df: DataFrame, path: str) -> str:
    """The model table as one CSV file with a header, no index.  The
    table has one row per model, so a single output file is bounded."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def _gate(df: DataFrame, min_rows: int) -> DataFrame:
    return df.select("n_rows", F.lit(min_rows).cast("bigint").alias("threshold"),
                     (F.col("n_rows") >= F.lit(min_rows)).alias("ok"))


def row_gate(df: DataFrame, min_rows: int = 100_000) -> DataFrame:
    """Count rows and compare with a threshold; a report, never a stop."""
    return _gate(df.agg(F.count(F.lit(1)).alias("n_rows")), min_rows)


def gated(df: DataFrame, min_rows: int = 100_000):
    """S8/G1 without a scan: df with a row counter, and a function that gives
    the gate's row once an action has run over df (such as the write that
    needs the rows anyway)."""
    spark, seen = df.sparkSession, Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))

    def gate() -> DataFrame:
        n = seen.get.get("n_rows", 0)
        return _gate(spark.createDataFrame([(n,)], "n_rows bigint"), min_rows)

    return counted, gate
