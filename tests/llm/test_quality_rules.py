import math
import random
from collections import Counter

import edge
import pytest
from pyspark.sql import functions as F

from tablework.llm import quality_rules as Q


def counts(text):
    w = edge.words(text)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(runs)
    inside = {i + j for i, r in enumerate(runs) if often[r] > 1 for j in range(8)}
    lines = [ln for ln in (text or "").split("\n") if edge.words(ln)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


def test_counts_equal_brute_force(spark):
    random.seed(4)
    rows = edge.EDGE + [(100 + i, " ".join(random.choice(["a", "b", "c#", "d|", "\n", "e\n"]) for _ in range(random.randint(0, 120))), "r")
                        for i in range(40)]
    got = Q.features(edge.documents(spark, rows, extra=True)).collect()
    assert sorted((str(r.doc_id), *(r[c] for c in Q.COUNTS), r.base_failed) for r in got) == sorted(
        (str(i), *(c := counts(t)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for i, t, _ in rows)


def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                        + (n - i) * math.log1p(-p)) for i in range(k + 1))


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10), (0, 5000), (3, 1000), (40, 6000), (1, 1), (9, 1000), (10, 1000), (0, 0), (900, 100000)]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", Q.binomial_tail(F.col("k"), F.col("n"), 0.01))
    for r in df.collect():
        want = tail(r.k, r.n, 0.01) if 0 < r.n and r.k < r.n * 0.01 else 1.0
        assert r.p == pytest.approx(want, rel=1e-9, abs=1e-300)


def labelled(spark, good, stratum="s", level=3):
    """``good`` labelled rows, of which some would fail from a level on."""
    rows = [(stratum, level if bad else 9, True, False) for bad in good]
    return spark.createDataFrame(rows, "source string, fails_from int, good boolean, base_failed boolean")


def test_strictest_proven_level(spark):
    # without errors, the chain of one stratum needs n with 0.99 ** n <= 0.05
    need = math.ceil(math.log(0.05) / math.log(0.99))
    assert Q.calibrate(labelled(spark, [False] * (need - 1))).collect() == []
    assert [tuple(r) for r in Q.calibrate(labelled(spark, [False] * need)).collect()] == [("s", 8)]
    # errors from level 3 on leave levels 1 and 2
    assert [tuple(r) for r in Q.calibrate(labelled(spark, [True] * 30 + [False] * need)).collect()] == [("s", 2)]


def test_strata_share_the_error(spark):
    need = math.ceil(math.log(0.05 / 2) / math.log(0.99))
    two = labelled(spark, [False] * need, "a").unionAll(labelled(spark, [False] * (need - 1), None))
    assert [tuple(r) for r in Q.calibrate(two).collect()] == [("a", 8)]


def test_judge_by_stratum(spark):
    """Rows that pass the base rules; only one stratum has a proven level."""
    plain = " ".join(f"word{j}" for j in range(40))
    rows = [(i, plain if i < 2 else plain.replace("word", "w#$"), None if i % 2 else "s") for i in range(4)]
    counted = Q.features(edge.documents(spark, rows, extra=True))
    levels = spark.createDataFrame([(None, 8)], "stratum string, level int")
    got = Q.judge(counted, levels).collect()
    assert {r.base_failed for r in got} == {False} and {r.stratum for r in got} == {"x14"}
    assert {r.doc_id: (r.kept, r.level) for r in got} == {0: (True, None), 1: (True, 8), 2: (True, None), 3: (False, 8)}


def test_proven_cutoffs_reject_rows_as_the_sql_does(spark, tmp_path):
    """Enough labels that one stratum proves all levels, one only mild ones
    and one none; the query and its SQL on these tables agree."""
    import duckdb
    from tablework.llm import queries
    plain = " ".join(f"word{j}" for j in range(30))
    noisy = " ".join(f"w{j}#*" if j % 2 else f"word{j}" for j in range(30))      # rejected from level 5 or so on
    rows, labels = [], []
    for source, n, bad in (("a", 700, 0), ("b", 700, 30), (None, 100, 0)):
        for i in range(n):
            rows.append((len(rows), noisy if i < bad else plain + f" x{i}", source))
            labels.append((len(labels), 1))
        rows += [(len(rows) + k, noisy, source) for k in range(10)]
        labels += [(len(labels) + k, 0) for k in range(10)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(tuple(r) for r in queries.op4_quality_rules(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(con.execute(queries.OP4_SQL).fetchall())
    gone = [rows[i][2] for i, *_, failed, kept in got if not kept]
    assert not any(failed for *_, failed, _ in got)
    assert gone == ["a"] * 10                            # b and the null source keep theirs


def test_labels_and_empty(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None), (2, 1)], "doc_id long, quality int")
    assert sorted(tuple(r) for r in Q.good_labels(labels).collect()) == [(1, False), (2, True)]
    none = Q.features(edge.documents(spark, []))
    levels = Q.calibrate(Q.with_labels(none, labels))
    assert levels.collect() == [] and Q.judge(none, levels).collect() == []
