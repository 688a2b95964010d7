"""Approximate nearest neighbours: one HNSW graph per shard, merged results.

Vectors are dealt by hash to shards of at most about ``SHARD_ROWS``; a task
builds the shard's hierarchical navigable small-world graph and writes it as
one row per node with its flat neighbour arrays.  Queries are grouped in
blocks; a task searches one block in one shard, and the shards' best are
merged by score.  Equal vectors are one node (a vector that a third of all
rows share would otherwise fill every neighbour list); of each the k + 1
smallest ids are kept, enough for any answer.

Nearness is the cosine in double precision of the original vectors.

Defined results: vectors that are null, empty, zero, or hold a null or
non-finite component, and rows with a null id, take no part; vectors of
another dimension are not neighbours; repeated rows of one id and vector
count once; ties go to the smaller id; a query with fewer than k candidates
gets all; an empty table gives no rows; other columns are not read.  Every
query is searched in every shard, so that work grows with queries x shards;
what is gathered of it is k + 1 rows for each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablework.llm.common import handover, need

SHARD_ROWS = 8192
QUERY_BLOCK = 16384
LINKS = 16                # neighbours per node above level 0, twice as many on it
BUILD_WIDTH = 80          # beam when a node is linked
SEARCH_WIDTH = 160        # beam when a query is answered
STEP = 256                # nodes or queries handled at once
INDEX = "shard int, pos int, node long, level int, vector array<double>, links array<array<int>>"


# ----------------------------------------------------------------- graph

def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int,
         expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of the best found per query, best first, padded
    with -1; each step follows the links of the best nodes not yet followed."""
    b = len(queries)
    rows = np.arange(b)[:, None]
    seen = np.zeros((b, len(x) + 1), bool)              # the last column takes the padding
    seen[:, -1] = True
    ids = np.full((b, width), -1)
    sims = np.full((b, width), -np.inf, np.float32)
    n = min(entries.shape[1], width)
    ids[:, :n] = entries[:, :n]
    sims[:, :n] = np.where(ids[:, :n] >= 0, np.einsum("bd,bkd->bk", queries, x[ids[:, :n]]), -np.inf)
    seen[rows, ids] = True
    followed = ids < 0
    while True:
        open_ = np.where(followed, -np.inf, sims)
        best = np.argpartition(-open_, min(expand, width - 1), axis=1)[:, :expand]
        live = np.take_along_axis(open_, best, 1) > -np.inf
        if not live.any():
            break
        np.put_along_axis(followed, best, True, 1)
        chosen = np.where(live, np.take_along_axis(ids, best, 1), -1)
        near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(b, -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[rows, near]] = -1
        seen[rows, near] = True
        keep = (near >= 0).any(axis=0)
        near = near[:, keep]
        if not near.shape[1]:
            continue
        found = np.where(near >= 0, np.einsum("bd,bkd->bk", queries, x[near]), -np.inf).astype(np.float32)
        ids = np.concatenate([ids, near], 1)
        sims = np.concatenate([sims, found], 1)
        followed = np.concatenate([followed, near < 0], 1)
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        ids, sims, followed = (np.take_along_axis(a, top, 1) for a in (ids, sims, followed))
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(np.where(sims > -np.inf, ids, -1), order, 1), np.take_along_axis(sims, order, 1)


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the candidates (best first, -1 for none) per row: a
    candidate is linked if it is nearer to the node than to those already
    linked; free places go to the best of the others."""
    near = x[ids]
    between = np.matmul(near, near.transpose(0, 2, 1))
    linked = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        closest = np.where(linked, between[:, j, :], -np.inf).max(axis=1)
        linked[:, j] = (ids[:, j] >= 0) & (sims[:, j] > closest) & (linked.sum(axis=1) < most)
    rank = np.where(ids < 0, 2, np.where(linked, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Add the new nodes to the lists of the nodes that they link to; lists
    that overflow are chosen anew."""
    most = links.shape[1]
    target, source = links[new].ravel(), np.repeat(new, most)
    target, source = target[target >= 0], source[target >= 0]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, begin, extra = np.unique(target, return_index=True, return_counts=True)
    wide = np.full((len(nodes), most + int(extra.max(initial=0))), -1)
    wide[:, :most] = links[nodes]
    wide[np.repeat(np.arange(len(nodes)), extra), most + np.arange(len(target)) - np.repeat(begin, extra)] = source
    for k in range(0, len(nodes), STEP):
        part, some = nodes[k:k + STEP], wide[k:k + STEP]
        sims = np.where(some >= 0, np.einsum("bd,bkd->bk", x[part], x[some]), -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :2 * most]
        links[part] = diverse(x, np.take_along_axis(some, order, 1), np.take_along_axis(sims, order, 1), most)


class Graph:
    """Nodes in order of falling level, so each level is a prefix of them;
    ``links[l]`` is the neighbour array of level l."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray]):
        self.x, self.links = x, links

    @staticmethod
    def levels(n: int, seed: int) -> np.ndarray:
        draw = np.random.default_rng(seed).random(n)
        return np.sort(np.floor(-np.log1p(-draw) / math.log(LINKS)).astype(int))[::-1]

    @classmethod
    def build(cls, x: np.ndarray, level: np.ndarray) -> Graph:
        graph = cls(x, [])
        for at in range(int(level.max(initial=0)), -1, -1):
            graph.links.insert(0, graph.link_level(int((level >= at).sum()), 2 * LINKS if at == 0 else LINKS))
        return graph

    def link_level(self, n: int, most: int) -> np.ndarray:
        links = np.full((n, most), -1)
        begin = 0
        while begin < n:
            new = np.arange(begin, min(n, begin + max(1, min(STEP, begin))))
            q = self.x[new]
            ids = np.zeros((len(new), 0), int)
            if begin:
                ids, _ = beam(self.x[:begin], links[:begin], q, self.entry(q, begin), BUILD_WIDTH)
            ids = np.concatenate([ids, np.where(new[None, :] < new[:, None], new[None, :], -1)], 1)
            sims = np.where(ids >= 0, np.einsum("bd,bkd->bk", q, self.x[ids]), -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_WIDTH]
            links[new] = diverse(self.x, np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1), most)
            link_back(self.x, links, new)
            begin += len(new)
        return links

    def entry(self, q: np.ndarray, n: int) -> np.ndarray:
        """Entry nodes among the first n from the levels linked so far."""
        found = np.zeros((len(q), 1), int)
        for links in reversed(self.links):
            found, _ = beam(self.x[:len(links)], links, q, found, 8)
        return np.where(found < n, found, 0)

    def search(self, q: np.ndarray, k: int) -> np.ndarray:
        """The k nearest nodes found per query, -1 where there are fewer."""
        found = np.zeros((len(q), 1), int)
        for links in reversed(self.links[1:]):
            found, _ = beam(self.x[:len(links)], links, q, found, 8)
        ids, _ = beam(self.x, self.links[0], q, found, max(k, SEARCH_WIDTH))
        return ids[:, :k]


# ------------------------------------------------------------ DataFrames

def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda v: v != 0)


def prepare(df: DataFrame, id_: str, vector: str) -> DataFrame:
    """(vec_id, vector, node) of the rows that take part, each once."""
    need(df, id_, vector)
    return (df.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))
            .withColumn("node", F.xxhash64("vector")).dropDuplicates(["vec_id", "node"]))


def smallest(rows: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """The first ``most`` rows per group; Spark cuts groups before the
    shuffle too, so a large group costs ``most`` rows per task."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", at).filter(F.col("rank") <= most)


def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Written table INDEX of (node, vector): a graph per shard.  Shards are
    kept apart by dimension."""
    n = nodes.count()
    shards = max(1, math.ceil(n / shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node", F.lit(3)), F.lit(shards)).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        raw = np.stack(pdf["vector"].to_numpy())
        level = Graph.levels(len(pdf), int(pdf["shard"].iloc[0]))
        graph = Graph.build(unit(raw).astype(np.float32), level)
        links = [[graph.links[at][i].astype(np.int32) for at in range(level[i] + 1)] for i in range(len(pdf))]
        return pd.DataFrame({"shard": pdf["shard"], "pos": np.arange(len(pdf), dtype=np.int32), "node": pdf["node"],
                             "level": level.astype(np.int32), "vector": pdf["vector"], "links": links})

    # asked for by number: by bytes, Spark would put several shards, whose cost is linking, into one task
    sized = dealt.withColumn("dim", F.size("vector")).repartition(shards, "shard", "dim")
    return handover(sized.groupBy("shard", "dim").applyInPandas(build, INDEX), "hnsw-index")


def search_index(index: DataFrame, queries: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(query, node, score): each query's k best nodes of each shard.
    queries: distinct (query, vector).  A task holds one shard and one block
    of queries."""
    blocks = max(1, math.ceil(queries.count() / block))
    shards = index.select(F.col("shard").alias("to_shard"), F.size("vector").alias("to_dim")).distinct()
    numbered = queries.withColumns({"to_block": F.pmod(F.xxhash64("query", F.lit(5)), F.lit(blocks)).cast("int"),
                                    "to_dim": F.size("vector")})
    asked = numbered.join(shards, "to_dim").select("to_shard", "to_dim", "to_block", "query", "vector")
    held = index.withColumns({"dim": F.size("vector"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        left = left.sort_values("pos", ignore_index=True)
        raw = unit(np.stack(left["vector"].to_numpy()))
        level = left["level"].to_numpy()
        links = [np.stack([rows[at] for rows in left["links"][:int((level >= at).sum())]]).astype(int)
                 for at in range(int(level.max()) + 1)]
        graph = Graph(raw.astype(np.float32), links)
        asked_for = unit(np.stack(right["vector"].to_numpy()))
        out = []
        for a in range(0, len(right), STEP):
            q = asked_for[a:a + STEP]
            ids = graph.search(q.astype(np.float32), min(k, len(left)))
            score = np.einsum("bd,bkd->bk", q, raw[ids])
            ok = ids >= 0
            who = np.repeat(right["query"].to_numpy()[a:a + STEP], ids.shape[1]).reshape(ids.shape)
            out.append(pd.DataFrame({"query": who[ok], "node": left["node"].to_numpy()[ids[ok]], "score": score[ok]}))
        return pd.concat(out)

    return (held.groupBy("shard", "dim", "block").cogroup(asked.groupBy("to_shard", "to_dim", "to_block"))
            .applyInPandas(search, "query long, node long, score double"))


def nearest(df: DataFrame, queries: Column, k: int = 5, id_: str = "vec_id", vector: str = "embedding",
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of df for which
    ``queries`` (a condition on vec_id) holds, its k nearest other rows."""
    rows = handover(prepare(df, id_, vector), "hnsw-rows")
    members = handover(smallest(rows, ["node"], [F.col("vec_id")], k + 1), "hnsw-nodes")
    index = build_index(members.filter("rank = 1").select("node", "vector"), shard_rows)
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"), "vector")
    one = asked.groupBy("query").agg(F.first("vector").alias("vector"))
    per_shard = search_index(index, handover(one, "hnsw-queries"), k + 1)
    heads = members.filter("rank = 1").select("node", F.col("vec_id").alias("least"))
    best = smallest(per_shard.join(heads, "node"), ["query"], [F.col("score").desc(), F.col("least")], k + 1)
    found = best.select("query", "node", "score").join(members.select("node", "vec_id"), "node")
    found = handover(smallest(found, ["query"], [F.col("score").desc(), F.col("vec_id")], k + 1)
                     .select("query", "vec_id", "score"), "hnsw-found")
    answers = asked.select("query_id", "query").join(found, "query").filter("query_id <> vec_id")
    return (smallest(answers, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
