"""Language identification by multilingual mixture inference.

A model is the distribution of hashed character trigrams in each language,
counted by Spark over all training texts.  A text's trigrams are drawn from
a mixture of languages; expectation-maximisation estimates the proportions,
and the set of languages is the one of best penalised likelihood (BIC):
languages enter in the order of their proportion under the full mixture
while the log-likelihood gains more than half the logarithm of the number of
trigrams each.  The text's language is the one with the largest proportion
within that set, its score this proportion.

Trigrams: the lower-cased text with every run of other characters than
letters as one space, and a space at both ends.

Defined results: a null text, or one without a letter, is ``und`` with score
0 and no shares, and so is every text under a model without languages; of
equal proportions the smaller language name wins; training leaves out rows
with a null text or language; repeated rows count repeatedly; other columns
pass through, but those the operator adds are replaced.  The model is
languages x buckets numbers: the driver holds it and broadcasts it, and
``train`` raises beyond ``MODEL_BYTES`` (some 1,000 languages).  A very long
text is one array of trigrams in a worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.llm.common import need, without

BUCKETS = 1 << 14
MODEL_BYTES = 64 << 20
ROUNDS = 25
ADDED = ["lang_pred", "score", "shares"]
SHARES = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Mask of the code points that are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def trigrams(text: str) -> np.ndarray:
    """Bucket of each trigram of a text; none if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    spaced = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                            # one space for a run of other characters
    codes = np.concatenate([[32], spaced[keep], [32]]).astype(np.uint64)
    if not letter[-1]:
        codes = codes[:-1]
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA77) + codes[2:]
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n): a task sends one row per language and bucket."""
    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                counts[name] += np.bincount(trigrams(t), minlength=BUCKETS)
        for name, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "bucket", "n"])

    return (docs.select(F.col(text).cast("string"), F.col(lang).cast("string"))
            .filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
            .mapInArrow(run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class Model:
    """Trigram probabilities, buckets x languages."""

    def __init__(self, names: list[str], probabilities: np.ndarray):
        self.names, self.probabilities = names, probabilities

    def mixture(self, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """(proportions, log-likelihood) of the columns of p by EM."""
        share = np.full(p.shape[1], 1 / p.shape[1])
        if p.shape[1] == 1:
            return share, float(counts @ np.log(p[:, 0]))
        total = counts.sum()
        for _ in range(ROUNDS):
            new = share * (p.T @ (counts / (p @ share))) / total
            moved = np.abs(new - share).max()
            share = new
            if moved < 1e-3:
                break
        return share, float(counts @ np.log(p @ share))

    def shares(self, text: str | None) -> list[tuple[str, float]]:
        """(language, proportion) of the chosen set, largest first."""
        buckets = trigrams(text or "")
        if not len(buckets) or not self.names:
            return []
        counted = np.bincount(buckets, minlength=BUCKETS)
        at = np.flatnonzero(counted)
        counts = counted[at].astype(np.float64)
        p = self.probabilities[at]
        full, _ = self.mixture(p, counts)
        order = np.argsort(-full, kind="stable")
        penalty = 0.5 * np.log(counts.sum() + 1)
        chosen, (share, best) = order[:1], self.mixture(p[:, order[:1]], counts)
        for k in range(2, len(order) + 1):
            more, likelihood = self.mixture(p[:, order[:k]], counts)
            if likelihood - best <= penalty:
                break
            chosen, share, best = order[:k], more, likelihood
        ranked = sorted(zip(share.tolist(), (self.names[i] for i in chosen)), key=lambda x: (-x[0], x[1]))
        return [(name, min(1.0, s)) for s, name in ranked]


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fit on all rows of docs with a text and a language."""
    need(docs, text, lang)
    counted = count_trigrams(docs, text, lang)
    counted = counted.groupBy("lang").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    names, columns = [], []
    for row in counted.toLocalIterator():              # at most BUCKETS numbers per language
        column = np.zeros(BUCKETS)
        column[row["at"]] = row["n"]
        names.append(row["lang"])
        columns.append(((column + 0.5) / (column.sum() + 0.5 * BUCKETS)).astype(np.float32))
        if len(names) * BUCKETS * 4 > MODEL_BYTES:
            raise ValueError(f"more than {MODEL_BYTES >> 20} MB of model: {len(names)} languages or more")
    order = np.argsort(names)
    table = np.stack([columns[i] for i in order], 1) if names else np.zeros((BUCKETS, 0), np.float32)
    return Model([names[i] for i in order], table.astype(np.float64))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs plus ``lang_pred``, ``score`` and ``shares`` (language, share)."""
    need(docs, text)
    docs = without(docs, *ADDED)
    shared = docs.sparkSession.sparkContext.broadcast((model.names, model.probabilities.astype(np.float32)))
    struct = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        local = Model(names, table.astype(np.float64))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [local.shares(t) for t in texts]
            added = [pa.array([f[0][0] if f else "und" for f in found], pa.string()),
                     pa.array([f[0][1] if f else 0.0 for f in found], pa.float64()),
                     pa.array([[{"lang": a, "share": b} for a, b in f] for f in found], struct)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *ADDED])

    fields = [*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
              T.StructField("score", T.DoubleType()), T.StructField("shares", SHARES)]
    return docs.mapInArrow(run, T.StructType(fields))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32(doc_id as text) mod folds is the fold; null: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
