"""Quality rules with risk-controlled cutoffs (DataFrame functions).

Base counts come from one pass over each whole text.  The method then judges
four shares by cutoffs: a policy level holds one cutoff for each share, and
levels go from mild to strict.  Per stratum (source) the strictest level is
chosen whose false rejection rate is limited with confidence: over labelled
documents that are good and pass the base rules, the exact binomial test
P(X <= rejected | n, max_false_reject) <= error / strata, which is a
Clopper-Pearson upper bound below max_false_reject.  Levels are nested and
tested from mild to strict until one fails, a fixed sequence, whose first
wrong step alone can err: the levels of a stratum share its whole error, and
the strata are corrected for each other (Bonferroni).  A stratum whose
labels prove no level keeps every document that passes the base rules.

Defined results: a null or empty text has no words and fails the base rules;
a null source is a stratum of its own; labels with a null doc_id or quality
are left out, a document with contrary labels is not good; repeated rows are
judged, and counted, one by one; an empty table gives an empty table; other
columns pass through, but those the operator adds are replaced; a very long text is one row, whose words and
windows are arrays in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import SPACE, handover, let, need, pack, small, unpack, word_array

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_FALSE_REJECT = 0.01
ERROR = 0.05
SHARES = ["symbol_share", "dup_line_share", "repeat_share", "mean_word_chars"]
#: One cutoff per share and level; a document above any of them is rejected.
LEVELS = [(0.50, 0.95, 0.300, 24.0), (0.40, 0.90, 0.275, 20.0), (0.30, 0.85, 0.250, 16.0),
          (0.20, 0.80, 0.225, 13.0), (0.15, 0.70, 0.200, 11.0), (0.10, 0.60, 0.175, 9.5),
          (0.05, 0.55, 0.150, 8.5), (0.02, 0.50, 0.125, 8.0)]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def window_hashes(words: Column, width: int) -> Column:
    """One 64-bit hash per run of ``width`` words (words bound by ``let``)."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = let(hashes, lambda hs: F.transform(F.sequence(F.lit(1), F.size(hs) - width + 1),
                                              lambda i: F.xxhash64(F.slice(hs, i, width))))
    return F.when(F.size(words) >= width, runs).otherwise(F.array().cast("array<bigint>"))


def covered(starts: Column, width: int) -> Column:
    """Words inside windows of ``width`` at these sorted starts."""
    steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)),
                       lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
    return F.aggregate(steps, F.lit(0), lambda s, x: s + x)


def repeated_words(hashes: Column, width: int) -> Column:
    """Words in windows whose hash occurs twice or more (hashes bound)."""
    def starts(s):
        pairs = F.zip_with(s, F.slice(s, 2, F.size(s)),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = let(ordered, lambda s: let(starts(s), lambda q: covered(q, width)))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs plus the counts, ``base_failed`` and ``fails_from`` (the mildest
    level that rejects the document; one past the last if none does)."""
    raw = F.coalesce(F.col(text), F.lit(""))
    words = let(word_array(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        let(window_hashes(w, WINDOW), lambda h: repeated_words(h, WINDOW)).cast("long").alias("n_repeat_words")))
    lines = let(F.filter(F.split(raw, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != ""), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.char_length(raw) - F.char_length(F.regexp_replace(raw, r"[#*$%&|<>]", ""))
    counted = (pack(docs, text)
               .select("row", words.alias("of_words"), lines.alias("of_lines"), symbols.cast("long").alias("n_symbols"))
               .select("row", "of_words.*", "of_lines.*", "n_symbols"))
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return unpack(counted, **{c: F.col(c) for c in (*COUNTS, "n_lines")}, base_failed=failed, fails_from=fails_from())


def fails_from() -> Column:
    def share(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    values = [share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"),
              share("n_repeat_words", "n_words"), share("word_chars", "n_words")]
    out = F.lit(len(LEVELS) + 1)
    for number, cutoffs in reversed(list(enumerate(LEVELS, 1))):
        above = F.lit(False)
        for value, cutoff in zip(values, cutoffs):
            above = above | (value > cutoff)
        out = F.when(above, number).otherwise(out)
    return out


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed exactly term by term on a log
    scale; 1 where k >= n * p, which no test accepts."""
    odds = F.lit(math.log(p / (1 - p)))
    first = n * F.lit(math.log1p(-p))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(acc["total"], term)
        low = F.least(acc["total"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    summed = F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), step,
                         lambda acc: F.exp(acc["total"]))
    return F.when((k >= n * p) | (n <= 0), F.lit(1.0)).otherwise(summed)


def calibrate(labelled: DataFrame, stratum: str = "source", max_false_reject: float = MAX_FALSE_REJECT,
              error: float = ERROR) -> DataFrame:
    """(stratum, level): the strictest proven level of each stratum that has
    one.  ``labelled`` has features and a boolean ``good``; the good rows
    that pass the base rules are the holdout (cutoffs are fixed beforehand,
    so none of them is spent on fitting)."""
    good = (labelled.filter(F.col("good") & ~F.col("base_failed"))
            .groupBy(F.col(stratum).alias("stratum"), "fails_from").agg(F.count("*").alias("n")))
    sums = (good.groupBy("stratum").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.when(F.col("fails_from") <= level, F.col("n")).otherwise(0))
                  for level in range(1, len(LEVELS) + 1)]).alias("rejected")))
    sums = handover(sums, "quality-sums")
    strata = max(1, sums.count())
    tested = sums.select("stratum", "n", F.posexplode("rejected").alias("at", "k"))
    failed = binomial_tail(F.col("k"), F.col("n"), max_false_reject) > F.lit(error / strata)
    first = F.coalesce(F.min(F.when(failed, F.col("at"))), F.lit(len(LEVELS)))      # levels below it are proven
    return tested.groupBy("stratum").agg(first.alias("level")).filter("level > 0")


def good_labels(labels: DataFrame) -> DataFrame:
    """(label_id, good), one row per labelled document."""
    need(labels, "doc_id", "quality")
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").alias("label_id")).agg((F.min("quality") == 1).alias("good")))


def judge(counted: DataFrame, levels: DataFrame, stratum: str = "source") -> DataFrame:
    """counted (from ``features``) plus ``level`` and ``kept``; ``levels``
    should be a written table (it is counted before it is broadcast)."""
    rows = pack(counted, stratum, "base_failed", "fails_from").withColumnRenamed(stratum, "own_stratum")
    met = rows.join(small(levels, 64), F.col("own_stratum").eqNullSafe(F.col("stratum")), "left")
    return unpack(met, level=F.col("level"),
                  kept=~F.col("base_failed") & (F.col("fails_from") > F.coalesce("level", F.lit(0))))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose doc_id is labelled, plus ``good``."""
    met = pack(rows, "doc_id").join(small(handover(good_labels(labels), "quality-labels"), 32), F.col("doc_id") == F.col("label_id"))
    return unpack(met, good=F.col("good"))
