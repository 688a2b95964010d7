"""Ranked lexical search over posting lists in geometric blocks.

Documents are dealt to shards of bounded size.  In a shard every posting list
is clustered by the similarity of its documents (their impacts over hashed
coordinates, nearest of evenly drawn centres) into blocks, and each block
stores its summary: per coordinate the largest impact of any of its
documents, rounded up to a byte.  The impact of a term in a document is
``(10^9 * tf) div (1000 * tf + 8 * m)``, its part of a score without the
term's weight, and lies below 10^6.

A search takes the item's terms from the heaviest to the lightest.  For the
blocks of a term's list the weights of this and the lighter terms times the
block's summary bound the score of every document that no list before has
brought up; blocks are scored in order of their bounds, and one is skipped
only when its bound is below the score of the worst of the k documents held
(equal bounds are read, for ties).  Scores are exact 64-bit integers, so the
k best of every shard hold the k best of all.

Terms are compared by 64-bit hashes.  With ``vocabulary`` only postings of
these terms are kept, as an item can use no others; the hashes go to the
workers while they fit BROADCAST_BYTES, and beyond that all terms are kept.

Defined results: a null or empty text, or one without terms, has none and is
never found; rows count one by one in N, L and df, repeated ones too; a row
with a null doc_id can be found, after others of its score; rows of benchmark
with one item_id make one item with all their terms; an item without terms,
or whose terms no document holds, has no rows; an empty table gives an empty
table; other columns are not read; a text is read whole, in steps of
STEP_BYTES or itself, if it is longer.  Every item is searched in every shard,
so work grows with items x shards; answers are k rows for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.bpe import spans
from tablework.llm.chat_format import byte_column
from tablework.llm.common import BROADCAST_BYTES, handover, need

# The score's formula.
LEVEL, SLOPE = 100, 90                      # m = LEVEL - SLOPE + (SLOPE * n * N) div L
SCALE, TF_PART, LENGTH_PART = 10**9, 1000, 8

STEP_BYTES = 1 << 21        # text bytes per step in a worker
SHARD_DOCS = 8192           # documents of a shard
BLOCK_DOCS = 32             # documents of a block, at most
COORDINATES = 256           # hashed coordinates of a summary
QUANTUM = 4096              # impacts per unit of a summary byte
ITEM_BLOCK = 4096           # items that one task searches
TERMS = "doc_id long, n long, terms array<long>, tfs array<int>"
INDEX = "shard int, term long, docs array<int>, impacts array<int>, cuts array<int>, summary binary, ids array<long>"


# ---------------------------------------------------------------- terms

def byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased byte, is it of a term) per byte; all bytes of code points
    beyond ASCII are of terms."""
    low = np.arange(256, dtype=np.uint8)
    low[ord("A"):ord("Z") + 1] += 32
    inside = np.zeros(256, bool)
    inside[ord("0"):ord("9") + 1] = inside[ord("a"):ord("z") + 1] = inside[128:] = True
    return low, inside[low]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


LOWER, INSIDE = byte_classes()
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
BASE = np.uint64(0x9E3779B97F4A7C15)


def term_hashes(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, its text) of texts given as bytes end to end: a
    polynomial of mixed byte values."""
    inside = INSIDE[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.flatnonzero(inside)
    first = np.flatnonzero(start[place])
    lengths = np.diff(np.append(first, len(place)))
    powers = np.full(int(lengths.max()), BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    value = BYTE_VALUES[LOWER[b[place]]] * powers[np.arange(len(place)) - np.repeat(first, lengths)]
    h = mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))
    return h.view(np.int64), np.searchsorted(offsets, at, "right") - 1


def text_steps(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) in steps of bounded bytes."""
    b, offsets = byte_column(batch.column(name))
    a = 0
    while a < len(batch):
        k = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP_BYTES, "right")) - 1)
        yield a, k, b[offsets[a]:offsets[k]], offsets[a:k + 1] - offsets[a]
        a = k


def term_counts(rows: DataFrame, id_: str, text: str = "text", vocabulary: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n, terms, tfs) per row: the number of terms with repeats, and
    the distinct ones (of the sorted vocabulary, if given) with their counts."""
    def run(batches):
        for batch in batches:
            for a, k, b, offsets in text_steps(batch, "text"):
                h, owner = term_hashes(b, offsets)
                n = np.bincount(owner, minlength=k - a)
                if vocabulary is not None:
                    at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
                    known = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
                    h, owner = h[known], owner[known]
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                cut = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=k - a))]).astype(np.int32)
                tf = np.diff(np.append(first, len(h))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, k - a), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(h[first])),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(tf))], names=["doc_id", "n", "terms", "tfs"])

    return (rows.select(F.col(id_).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInArrow(run, TERMS))


# ---------------------------------------------------------------- index

def coordinates(terms: np.ndarray) -> np.ndarray:
    return ((terms.view(np.uint64) * BASE) >> np.uint64(56)).astype(np.int64) % COORDINATES


def rounded_up(impacts: np.ndarray) -> np.ndarray:
    return (-(-impacts // QUANTUM)).astype(np.uint8)


def geometric_blocks(members: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the members, block starts): members go to the nearest of
    evenly drawn centres; a cluster is cut at every BLOCK_DOCS members."""
    n = len(members)
    if n <= BLOCK_DOCS:
        return np.arange(n), np.zeros(1, np.int64)
    centres = vectors[members[:: BLOCK_DOCS]]
    near = np.empty(n, np.int64)
    for a in range(0, n, 1024):
        near[a:a + 1024] = np.argmax(vectors[members[a:a + 1024]] @ centres.T, axis=1)
    order = np.argsort(near, kind="stable")
    near = near[order]
    head = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
    within = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
    return order, np.flatnonzero(within % BLOCK_DOCS == 0)


def build_shard(table: pa.Table, n_docs: int, n_terms: int) -> Iterator[tuple]:
    """Rows of INDEX of one shard: its documents in order of doc_id, then a
    row per posting list."""
    ids = table.column("doc_id").combine_chunks()
    order = pa.compute.array_sort_indices(ids, null_placement="at_end")
    table = table.take(order)
    ids, n = table.column("doc_id").combine_chunks(), table.column("n").to_numpy()
    lists = table.column("terms").combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    terms = lists.flatten().to_numpy()
    tfs = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(ids)), sizes)
    m = LEVEL - SLOPE + SLOPE * n * n_docs // max(1, n_terms)
    impacts = SCALE * tfs // (TF_PART * tfs + LENGTH_PART * m[owner])
    dense = np.zeros((len(ids), COORDINATES), np.uint8)
    np.maximum.at(dense, (owner, coordinates(terms)), rounded_up(impacts))
    unit = dense.astype(np.float32)
    unit /= np.maximum(1, np.linalg.norm(unit, axis=1))[:, None]
    shard = table.column("shard")[0].as_py()
    yield shard, None, None, None, None, None, ids.to_pylist()
    by_term = np.argsort(terms, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(terms[by_term]) != 0])) if len(terms) else []
    for a, b in zip(cuts, [*cuts[1:], len(terms)]):
        of = by_term[a:b]
        order, starts = geometric_blocks(owner[of], unit)
        members = owner[of][order]
        summary = np.maximum.reduceat(dense[members], starts, axis=0)
        yield (shard, int(terms[of[0]]), members.astype(np.int32), impacts[of][order].astype(np.int32),
               starts.astype(np.int32), summary.tobytes(), None)


def record(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64())]
    names = [x.split()[0] for x in INDEX.split(", ")]
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def statistics(counted: DataFrame) -> tuple[int, int]:
    """(N, L): documents with a term, and all terms with repeats."""
    row = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    return row["n"], row["l"]


def build_index(counted: DataFrame, n_docs: int, n_terms: int, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Written table INDEX over ``term_counts`` (a written table) with the
    statistics N and L."""
    found = counted.filter(F.size("terms") > 0)
    shards = max(1, math.ceil(found.count() / shard_docs))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "n", F.lit(7)), F.lit(shards)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        return record(list(build_shard(table, n_docs, n_terms)))

    return handover(dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(build, INDEX), "search-index")


def weights(counted: DataFrame, items: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, terms, weights) of items (item_id, term): the terms that
    occur with their weights."""
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1)))
    return (items.join(df, "term").withColumn("weight", weight)
            .groupBy("item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms")))


# --------------------------------------------------------------- search

class Shard:
    """The posting lists of one shard."""

    def __init__(self, rows: pa.Table):
        self.lists: dict[int, tuple] = {}
        self.ids: list = []
        columns = [rows.column(c).combine_chunks() for c in ("term", "docs", "impacts", "cuts", "summary", "ids")]
        for i in range(len(rows)):
            term, docs, impacts, cuts, summary, ids = (c[i] for c in columns)
            if not term.is_valid:
                self.ids = ids.as_py()
                continue
            docs, impacts = docs.values.to_numpy(), impacts.values.to_numpy().astype(np.int64)
            order = np.argsort(docs)
            self.lists[term.as_py()] = (docs, np.append(cuts.values.to_numpy(), len(docs)),
                                        np.frombuffer(summary.as_py(), np.uint8).reshape(-1, COORDINATES),
                                        docs[order], impacts[order])

    def scores(self, docs: np.ndarray, terms: list[int], weight: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for t, w in zip(terms, weight):
            _, _, _, held, impacts = self.lists[t]
            at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
            out += np.where(held[at] == docs, impacts[at], 0) * w
        return out

    def search(self, terms: list[int], weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, blocks scored) of the k best with a score above
        0, best first, ties to the smaller document."""
        known = [i for i in np.argsort(-weight, kind="stable") if terms[i] in self.lists]
        terms, weight = [terms[i] for i in known], weight[known]
        at = coordinates(np.array(terms, np.int64))
        seen = np.zeros(len(self.ids), bool)
        best, score, read = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for i, t in enumerate(terms):
            docs, cuts, summary, _, _ = self.lists[t]
            bounds = summary[:, at[i:]].astype(np.int64) @ (weight[i:] * QUANTUM)
            order, done, step = np.argsort(-bounds, kind="stable"), 0, 4
            while done < len(order):
                worst = score[-1] if len(score) == k else 1
                some = order[done:done + step]
                some = some[bounds[some] >= worst]
                if not len(some):
                    break                               # bounds only fall from here
                done, step, read = done + len(some), step * 2, read + len(some)
                new = docs[spans(cuts[some].astype(np.int64), np.diff(cuts)[some].astype(np.int64))]
                new = new[~seen[new]]
                seen[new] = True
                best = np.concatenate([best, new])
                score = np.concatenate([score, self.scores(new, terms[i:], weight[i:])])
                keep = np.lexsort((best, -score))[:k]
                keep = keep[score[keep] > 0]
                best, score = best[keep], score[keep]
        return best, score, read


def search_index(index: DataFrame, items: DataFrame, k: int = 10, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(item_id, doc_id, score): the k best of each shard per item (item_id,
    terms); a task holds one shard and one block of items."""
    items = handover(items, "search-items")
    blocks = max(1, math.ceil(items.count() / item_block))
    last = index.agg(F.coalesce(F.max("shard"), F.lit(0)).alias("last")).first()["last"]
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = items.select(F.explode(F.sequence(F.lit(0), F.lit(last))).alias("to_shard"),
                         F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("to_block"), "item_id", "terms")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        shard = Shard(left) if len(left) and len(right) else None
        for item, terms in zip(right.column("item_id").to_pylist(), right.column("terms").to_pylist()):
            if shard is not None:
                best, score, _ = shard.search([t["term"] for t in terms], np.array([t["weight"] for t in terms], np.int64), k)
                out += [(item, shard.ids[d], s) for d, s in zip(best.tolist(), score.tolist())]
        return pa.table([pa.array(list(c), pa.int64()) for c in (zip(*out) if out else ([], [], []))],
                        names=["item_id", "doc_id", "score"])

    return (held.groupBy("shard", "block").cogroup(asked.groupBy("to_shard", "to_block"))
            .applyInArrow(search, "item_id long, doc_id long, score long"))


def rank(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of docs (doc_id, text)
    with the highest scores above 0 for each item of items (item_id, text)."""
    need(docs, "doc_id", text)
    need(items, "item_id", text)
    asked = handover(term_counts(items, "item_id", text).select(F.col("doc_id").alias("item_id"), F.explode("terms").alias("term"))
                     .distinct(), "search-terms")
    known = asked.select("term").distinct()
    vocabulary = None
    if known.count() * 8 <= BROADCAST_BYTES:
        vocabulary = np.sort(np.array([r["term"] for r in known.collect()], np.int64))
    counted = handover(term_counts(docs, "doc_id", text, vocabulary), "search-counted")
    n_docs, n_terms = statistics(counted)
    index = build_index(counted, n_docs, n_terms, shard_docs)
    found = search_index(index, weights(counted, asked, n_docs), k)
    at = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return (found.withColumn("rank", at.cast("int")).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
