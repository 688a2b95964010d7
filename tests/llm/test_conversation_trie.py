import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tablework.llm import conversation_trie as T
from tablework.llm.common import handover

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes by writing out every rebuilt conversation."""
    conv = {}
    for c, t, role, text in rows:
        if c is not None:
            conv.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    conv = {c: [x[2:] for x in sorted(v)] for c, v in conv.items()}
    whole = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(conv.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
    members, below = {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for s in members:
        if s:
            below.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        kids = below.get(s, [])
        leaves[s] = sum(leaves[x] for x in kids) if kids else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        saved[s] = (len(members[s]) - 1) * words + sum(saved[x] for x in kids)
        ends = ",".join(str(c) for c in sorted(members[s]) if len(whole[c]) == len(s))
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(kids),
                    leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, **kw):
    return sorted((tuple(r) for r in T.trie(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)


def random_rows(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice([None, 0, 1, 2, 3, 20, 21, 22, -20, -21, -3, 5, 7, 40, 47]), rnd.choice([None, 0, 1, 2, 3, 4]),
             rnd.choice([None, "user", "a"]), rnd.choice([None, "", "a b", "é  日本\tx", "c " * 3000])) for _ in range(n)]


def test_equals_written_out_conversations_with_blocks(spark, monkeypatch):
    """Nulls, ties, repeated rows, absent bases; blocks of two positions, so
    running sums go over several blocks."""
    monkeypatch.setattr(T, "BLOCK", 2)
    rows = random_rows(3, 70)
    assert nodes(spark, rows + rows[:5]) == brute(rows + rows[:5])


def test_a_clash_is_found_and_worked_out_again(spark):
    """Residues modulo 2 make fingerprints of different turns equal."""
    rows = random_rows(4, 60)
    turns = handover(T.positions(spark.createDataFrame(rows, SCHEMA)), "trie-turns")
    original = handover(T.prefixes(turns, 0, 2), "trie-prefixes")
    assert T.clashes(handover(T.rebuilt(original, 0), "trie-paths"), turns) > 0
    assert nodes(spark, rows, prime=2) == brute(rows)


def test_long_conversation_and_turnless_ones(spark):
    rows = [(c, t, "user", f"t{t}") for c in (0, 1) for t in range(40)] + [(23, 0, "user", "x"), (31, 0, "user", "y")]
    assert nodes(spark, rows) == brute(rows)


def test_power_and_head_length(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 5, 4095, 4096, 123456789)], "n long")
    for n, p, h in df.select("n", T.power(48271, F.col("n")), T.head_length(-F.col("n"))).collect():
        assert p == pow(48271, n, T.PRIME) and h == zlib.crc32(str(-n).encode()) % 4


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")]])
def test_no_conversations(spark, rows):
    assert nodes(spark, rows) == []


def test_other_columns_with_clashing_names(spark):
    rows = random_rows(5, 30)
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("conv", "pos", "depth", "f1", "words", "_key")])
    assert sorted((tuple(r) for r in T.trie(df).collect()), key=str) == brute(rows)
