"""Line dedup with levelled sorted runs of line hashes (DataFrame functions).

State is a set of runs: Parquet tables of ``(h1, h2, n, top)`` -- a 128-bit
hash of a line key, the documents of the batch that hold it, the largest
doc_id among them -- bucketed and sorted by hash.  A key is in one run only.
A new batch is shuffled once into the runs' buckets and merge-anti-joined
with each run: what is left is a new run of level 0; keys that a run already
has go to the log of repeats.  When ``fanout`` runs stand at a level, they
are merged into one run of the next level, so a batch meets at most
``fanout x levels`` runs.

The runs live in a folder with a manifest, a small table per batch that is
written last and names the runs and logs that count.  ``LineRuns(spark,
path)`` opens it again for later batches; a batch that failed half-way left
no manifest, so it counts for nothing and can be added again.

Defined results: a null text is one empty line; an empty table gives an
empty table; each row counts as a document of its own, so repeated rows
count repeatedly and the line stays in every row with the largest doc_id; a
null doc_id is smaller than all others.  Extra columns pass through.  A very
long text is one row, whose lines are an array in one task.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.common import SPACE, handover, lower_ascii, need, pack, small, unpack
from tablework.session import shared_scratch

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 6                 # more than the fan-out, so batches meet a compacted run
FANOUT = 4
HASHES = ["h1", "h2"]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def document_keys(text: Column, min_chars: int) -> Column:
    """The hashes of a document's keys, each once."""
    keys = F.filter(F.transform(split_lines(text), line_key), lambda k: F.char_length(k) >= min_chars)
    return F.transform(F.array_distinct(keys), lambda k: F.struct(*key_hash(k)))


RUN = "h1 bigint, h2 bigint, n bigint, top bigint"


class LineRuns:
    """Levelled sorted runs in ``path``, a folder that all executors share
    (default: a new one under the checkpoint folder).  A path that holds
    runs is opened with its newest manifest, and with its buckets."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None, path: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.path = (path or shared_scratch(spark, "lineruns")).rstrip("/")
        self.tag = "lineruns_" + uuid.uuid4().hex[:12]
        self.version, self.tables = 0, 0
        self.runs: list[tuple[int, str, str]] = []           # (level, table, folder)
        self.repeats: list[str] = []                         # folders
        found = self._manifest() if path else None
        self.buckets = found["buckets"] if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if found:
            self.version, self.repeats = found["version"], list(found["repeats"])
            self.runs = [(r["level"], self._register(r["folder"]), r["folder"]) for r in found["runs"]]

    def _manifest(self):
        schema = "buckets int, runs array<struct<level:int,folder:string>>, repeats array<string>, version long"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/manifest").orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _commit(self) -> None:
        """The state after a batch, as one small table written last."""
        self.version += 1
        runs = [F.struct(F.lit(level).alias("level"), F.lit(folder).alias("folder")) for level, _, folder in self.runs]
        (self.spark.range(0, 1, 1, 1)                         # literals: a local row would start Python workers on each executor
         .select(F.lit(self.buckets).alias("buckets"),
                 F.array(*runs).cast("array<struct<level:int,folder:string>>").alias("runs"),
                 F.array(*map(F.lit, self.repeats)).cast("array<string>").alias("repeats"))
         .write.mode("errorifexists").parquet(f"{self.path}/manifest/version={self.version}"))

    def _name(self) -> str:
        self.tables += 1
        return f"{self.tag}_{self.tables}"

    def _register(self, folder: str) -> str:
        """A catalog entry for a run's files, which says how they are bucketed."""
        name, place = self._name(), f"{self.path}/{folder}".replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({RUN}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{place}'")
        return name

    def _write(self, entries: DataFrame, level: int) -> None:
        name, folder = self._name(), "run-" + uuid.uuid4().hex[:12]
        (entries.repartition(self.buckets, *HASHES).write
         .bucketBy(self.buckets, *HASHES).sortBy(*HASHES)
         .option("path", f"{self.path}/{folder}").saveAsTable(name))
        self.runs.append((level, name, folder))

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join a batch of distinct keys (h1, h2, n, top) with the
        runs; new keys become a run, known keys go to the log of repeats."""
        fresh = known = batch
        for _, name, _ in self.runs:
            run = self.spark.table(name).select(*HASHES).hint("merge")
            fresh = fresh.join(run, HASHES, "left_anti")
        if self.runs:
            seen = [known.join(self.spark.table(name).select(*HASHES).hint("merge"), HASHES, "left_semi")
                    for _, name, _ in self.runs]
            repeats = seen[0]
            for more in seen[1:]:                  # runs share no key, so neither do these
                repeats = repeats.unionAll(more)
            folder = "repeats-" + uuid.uuid4().hex[:12]
            repeats.write.parquet(f"{self.path}/{folder}")
            self.repeats.append(folder)
        self._write(fresh, 0)
        level = 0
        while len(at := [t for lv, t, _ in self.runs if lv == level]) >= self.fanout:
            self.compact(at, level + 1)
            level += 1
        self._commit()

    def compact(self, tables: list[str], level: int) -> None:
        """Merge runs into one; their keys are disjoint, so rows only move."""
        merged = self.spark.table(tables[0])
        for name in tables[1:]:
            merged = merged.unionAll(self.spark.table(name))
        self._write(merged, level)
        self.runs = [r for r in self.runs if r[1] not in tables]

    def common_keys(self, min_docs: int) -> DataFrame:
        """(h1, h2, top) of keys that at least min_docs documents hold."""
        log = None
        for folder in self.repeats:
            r = self.spark.read.schema(RUN).parquet(f"{self.path}/{folder}")
            log = r if log is None else log.unionAll(r)
        out = None
        if log is not None:
            log = log.groupBy(*HASHES).agg(F.sum("n").alias("more"), F.max("top").alias("high"))
        for _, name, _ in self.runs:
            run = self.spark.table(name)
            if log is None:
                run = run.withColumns({"more": F.lit(0), "high": F.lit(None).cast("long")})
            else:
                run = run.join(log, HASHES, "left")
            run = (run.filter(F.col("n") + F.coalesce("more", F.lit(0)) >= min_docs)
                   .select(*HASHES, F.greatest("top", "high").alias("top")))
            out = run if out is None else out.unionAll(run)
        return out

    def close(self) -> None:
        """Forget the catalog entries; the files stay and can be opened again."""
        for i in range(1, self.tables + 1):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tag}_{i}")

    def __enter__(self) -> "LineRuns":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def drop_common_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """docs with ``text`` rebuilt from the lines that stay, plus ``n_lines``
    (before) and ``n_dropped``.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z
    lower-cased.  Keys of min_chars code points or more that min_docs
    documents or more hold lose all their lines but those in the largest
    doc_id."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    held = (docs.select(F.col("doc_id").cast("long").alias("id"),
                        F.explode(document_keys(F.col("text"), min_chars)).alias("k"))
            .groupBy(F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"),
                     F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"))
            .agg(F.count("*").alias("n"), F.max("id").alias("top")))
    held = handover(held, "line-keys")
    with LineRuns(spark, fanout) as runs:
        for b in range(batches):
            runs.add(held.filter(F.col("batch") == b).select(*HASHES, "n", "top"))
        common = handover(runs.common_keys(min_docs), "common-lines")
    return without_lines(docs, common, min_chars)


def without_lines(docs: DataFrame, common: DataFrame, min_chars: int) -> DataFrame:
    """docs without the lines whose key is in common (h1, h2, top), except in
    the document top.  Only hashes and positions meet the common keys; the
    text itself moves once, to the positions to drop."""
    identity = [F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash")]
    key = F.col("_key")
    lines = (docs.select(*identity, F.posexplode(F.transform(split_lines(F.col("text")), line_key))
                         .alias("_pos", "_key"))
             .filter(F.char_length(key) >= min_chars)
             .select("_id", "_hash", "_pos", *key_hash(key)))
    gone = (lines.join(small(common, 64), HASHES)
            .filter(~F.col("_id").eqNullSafe(F.col("top")))
            .groupBy("_id", "_hash").agg(F.collect_set("_pos").alias("_drop"))
            .withColumnsRenamed({"_id": "_gid", "_hash": "_ghash"}))
    kept_positions = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    text = F.col("row.text")                       # the text moves once, inside its row
    kept = F.when(F.col("_drop").isNull(), F.coalesce(text, F.lit(""))).otherwise(let_lines(kept_positions))
    met = (pack(docs, "doc_id", "text").select("row", *identity)
           .join(gone.hint("shuffle_hash"),
                 F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_hash") == F.col("_ghash")), "left")
           .withColumn("_lines", split_lines(text)))
    return unpack(met, text=kept, n_lines=F.size("_lines").cast("long"),
                  n_dropped=F.coalesce(F.size("_drop"), F.lit(0)).cast("long"))


def let_lines(positions: Column) -> Column:
    """The lines at these positions joined by newlines."""
    chosen = F.get(F.transform(F.array(F.struct(F.col("_lines").alias("l"), positions.alias("p"))),
                               lambda s: F.transform(s["p"], lambda i: F.get(s["l"], i))), 0)
    return F.array_join(chosen, "\n")
