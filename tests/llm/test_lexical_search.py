import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from edge import EDGE, LONG, UP
from tablework.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UP))


def brute(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in asked.items():
        found = []
        for d, w in bags:
            m = 10 + (90 * len(w) * n_docs) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m))
                        for t in ts if t in w)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in S.rank(d, i, **kw).collect()), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{x}" for x in range(150)]
    topics = [rnd.sample(words, 25) for _ in range(6)]
    return [(i, " ".join(rnd.choices(rnd.choice(topics), k=rnd.randint(5, 40)))) for i in range(n)]


ITEMS = [(0, "w1 W2, w3 w4 w5 w6"), (1, "w7 w7 w8"), (1, "w9"), (2, "nowhere"), (3, None), (4, ""), (None, "w10 w11"), (5, "É日本 state 12")]


def test_equals_all_scores(spark):
    docs = corpus(1, 600) + [(i, t) for i, t, _ in EDGE if t is not LONG] + [(None, "w1 w2 w3 w4 w5 w6")] * 2
    assert ranked(spark, docs, ITEMS, shard_docs=100) == brute(docs, ITEMS)
    assert ranked(spark, docs, ITEMS, k=3) == brute(docs, ITEMS, 3)


def test_hot_term_copies_and_ties(spark):
    """A third of the documents are one text; ties go to the smaller doc_id."""
    docs = [(i, "w1 w2 common") for i in range(300)] + corpus(2, 300)
    docs += [(1000 + i, f"common w{i % 7}") for i in range(300)]
    assert ranked(spark, docs, [(0, "common w1 w2"), (1, "common")], shard_docs=64) == brute(docs, [(0, "common w1 w2"), (1, "common")])


def test_long_text_empty_tables_and_other_columns(spark):
    docs = [(1, LONG * 20), (2, "w5 short"), (3, "x" * 3_000_000 + " w5")]
    assert ranked(spark, docs, [(0, "w5 w5x5 w976x976")]) == brute(docs, [(0, "w5 w5x5 w976x976")])
    assert ranked(spark, [], ITEMS) == [] and ranked(spark, docs, []) == [] and ranked(spark, [(1, None)], ITEMS) == []
    d = spark.createDataFrame(docs[:2], "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("n", "terms", "shard", "score", "rank")])
    i = spark.createDataFrame([(0, "w5")], "item_id long, text string").withColumn("term", F.lit(1))
    assert sorted(tuple(r) for r in S.rank(d, i).collect()) == brute(docs[:2], [(0, "w5")])


def test_without_a_vocabulary_all_terms_are_kept(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    docs = corpus(3, 200)
    assert ranked(spark, docs, ITEMS, shard_docs=50) == brute(docs, ITEMS)


def shard(docs):
    batch = pa.record_batch([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])], names=["doc_id", "text"])
    rows = []
    for a, k, b, offsets in S.text_steps(batch, "text"):
        h, owner = S.term_hashes(b, offsets)
        for d in range(a, k):
            some, tf = np.unique(h[owner == d - a], return_counts=True)
            rows.append((docs[d][0], int(tf.sum()), some.tolist(), tf.tolist(), 0))
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32()))],
                     names=["doc_id", "n", "terms", "tfs", "shard"])
    return list(S.build_shard(table, len(docs), sum(len(terms(t)) for _, t in docs)))


def test_summaries_bound_every_document_of_their_block():
    docs = corpus(5, 400)
    rows = shard(docs)
    held = {}
    for _, term, members, impacts, *_ in rows[1:]:
        for d, x in zip(members, impacts):
            held.setdefault(int(d), {})[term] = int(x)
    for _, term, members, impacts, starts, summary, _ in rows[1:]:
        top = np.frombuffer(summary, np.uint8).reshape(-1, S.COORDINATES)
        for block, (a, b) in enumerate(zip(starts, [*starts[1:], len(members)])):
            assert b - a <= S.BLOCK_DOCS
            for d in members[a:b]:
                for t, x in held[int(d)].items():
                    assert int(top[block][S.coordinates(np.array([t], np.int64))[0]]) * S.QUANTUM >= x


def test_blocks_are_skipped_and_like_documents_meet():
    """With topics, a search reads few of the blocks of its lists."""
    rnd = random.Random(9)
    topics = [[f"t{k}x{j}" for j in range(12)] for k in range(40)]
    docs = [(i, " ".join(["common"] + rnd.choices(topics[i % 40], k=20))) for i in range(4000)]
    s = S.Shard(S.record(shard(docs)))
    h, _ = S.term_hashes(np.frombuffer(b"common t3x1 t3x2 t3x3", np.uint8), np.array([0, 21]))
    weight = np.array([1, 3500, 3500, 3500], np.int64)
    best, score, read = s.search(h.tolist(), weight, 10)
    everything = s.scores(np.arange(4000), h.tolist(), weight)
    assert sorted(score.tolist(), reverse=True) == sorted(everything.tolist(), reverse=True)[:10]
    blocks = sum(len(s.lists[t][1]) - 1 for t in h.tolist())
    assert read < blocks / 3


def test_term_hashes_follow_the_pattern():
    texts = ["", "a", "A b-c", "É日本,x y", "ab", "a", "zz\x00q~1", "b"]
    b = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, owner = S.term_hashes(np.frombuffer(b, np.uint8), offsets)
    want = [(i, t) for i, x in enumerate(texts) for t in terms(x)]
    assert owner.tolist() == [i for i, _ in want]
    names = {}
    for x, (_, t) in zip(h.tolist(), want):
        assert names.setdefault(x, t) == t
    assert len(names) == len({t for _, t in want})
