"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes every stage's result as Parquet under the shared
checkpoint folder and reads it again for the next, so a lost executor costs
tasks of one stage.  All but the last return the columns of ``documents``.
Stages accept what the operators accept (null, empty and very long texts,
repeated rows, empty tables, further columns) with the results that the
operators define.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import bpe, line_dedup, ngram_join, quality_rules, source_mix
from tablework.llm.common import handover
from tablework.llm.queries import vocabulary_path


def aside(docs: DataFrame, *own: str) -> DataFrame:
    """docs with all columns but ``own`` in one struct, so that no column
    that an operator adds can replace one of them."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    return docs.select(F.struct(*rest, F.lit(0).alias("aside")).alias("aside"), *own)


def back(result: DataFrame, docs: DataFrame, *own: str, **new: Column) -> DataFrame:
    """The columns of docs from a result on ``aside``; ``new`` ones replace
    those of their names."""
    return result.select(*[(new[c] if c in new else F.col(c) if c.lower() in own else F.col("aside").getField(c)).alias(c)
                           for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their stratum's proven cutoffs
    reject go.  Labelled documents are counted first, for the cutoffs; the
    verdicts follow in one pass without a shuffle of texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = quality_rules.with_labels(docs.select("doc_id", "source", "text"), labels)
    levels = handover(quality_rules.calibrate(quality_rules.features(labelled)), "quality-levels")
    own = "doc_id", "source", "text"
    judged = quality_rules.judge(quality_rules.features(aside(docs, *own)), levels)
    return back(judged.filter("kept"), docs, *own)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one of them only;
    ``n_chars`` follows the text."""
    own = "doc_id", "text"
    kept = line_dedup.drop_common_lines(aside(docs, *own))
    chars = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return back(kept, docs, *own, **chars)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles,
    similarity 0.8 or more."""
    return ngram_join.keep_one(docs, 5, 80, 100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not at all, up to three
    times)."""
    own = "doc_id", "text", "source"
    return back(source_mix.repeat_copies(source_mix.mix(aside(docs, *own))), docs, *own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): token ids of each
    row, and whether they decode to its text.  The ids are handed over, so
    the workers that encode them decode them too; in one pass each task would
    hold two workers with a vocabulary each."""
    path = vocabulary_path()
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text", digest.alias("digest")), path).drop("text")
    checked = bpe.decode(handover(coded, "pipeline-ids"), path, keep=True)
    return checked.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_copies),
          ("source_mix", mix), ("byte_bpe", encode)]

#: Components, Newton steps and merges have no SQL twin; the tests compare
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = handover(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
