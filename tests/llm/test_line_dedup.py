import edge
from pyspark.sql import functions as F

from tablework.llm import line_dedup


def brute(rows, min_chars=20, min_docs=3):
    lines = [(i, (t or "").split("\n")) for i, t, _ in rows]
    held = {}
    for n, (i, ls) in enumerate(lines):
        for key in {ln.strip(edge.SPACE).translate(edge.UP) for ln in ls}:
            if len(key) >= min_chars:
                held.setdefault(key, []).append(i)
    common = {k: max([i for i in ids if i is not None], default=None) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, ls in lines:
        keep = [ln for ln in ls if (k := ln.strip(edge.SPACE).translate(edge.UP)) not in common or common[k] == i]
        out.append((i, len(ls), len(ls) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def test_edges_equal_brute_force(spark):
    for extra in (False, True):
        got = line_dedup.drop_common_lines(edge.documents(spark, extra=extra))
        rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str)
        assert rows == brute(edge.EDGE)
        if extra:
            assert set(edge.EXTRA) <= set(got.columns) and {r["_id"] for r in got.collect()} == {"x12"}


def test_batches_and_compaction_change_nothing(spark):
    rows = [(i, "\n".join(f"line number {i % k:>20} of many" for k in (2, 3, 5, 7, 50)), "s") for i in range(60)]
    want = brute(rows)
    for batches, fanout in ((1, 4), (7, 2), (5, 9)):
        got = line_dedup.drop_common_lines(edge.documents(spark, rows), batches=batches, fanout=fanout)
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == want
    assert [t for t in spark.catalog.listTables() if t.name.startswith("lineruns")] == []


def test_empty_table(spark):
    assert line_dedup.drop_common_lines(edge.documents(spark, [])).collect() == []


def test_runs_stay_disjoint(spark):
    runs = line_dedup.LineRuns(spark, fanout=3, buckets=2)
    for b in range(5):
        runs.add(spark.range(10 * b, 10 * b + 20).select(F.col("id").alias("h1"), F.col("id").alias("h2"),
                                                         F.lit(1).cast("long").alias("n"), (F.lit(b) * 1).cast("long").alias("top")))
    keys = [r.h1 for _, t, _ in runs.runs for r in spark.table(t).collect()]
    assert sorted(keys) == list(range(60))
    assert len(runs.runs) < 5
    common = {(r.h1, r.top) for r in runs.common_keys(2).collect()}
    assert common == {(k, k // 10) for k in range(10, 50)}
    runs.close()


def batch(spark, b):
    return spark.range(10 * b, 10 * b + 20).select(F.col("id").alias("h1"), F.col("id").alias("h2"),
                                                   F.lit(1).cast("long").alias("n"), F.lit(b).cast("long").alias("top"))


def test_runs_opened_again_equal_one_run(spark):
    """Five batches in one session of runs, and in three that open the same
    folder; later ones meet a compacted run."""
    with line_dedup.LineRuns(spark, fanout=2, buckets=3) as whole:
        for b in range(5):
            whole.add(batch(spark, b))
        want = sorted(tuple(r) for r in whole.common_keys(2).collect())
        path = None
        for some in ([0, 1], [2], [3, 4]):
            with line_dedup.LineRuns(spark, fanout=2, buckets=99 if path else 3, path=path) as runs:
                assert runs.buckets == 3
                for b in some:
                    runs.add(batch(spark, b))
                path = runs.path
        with line_dedup.LineRuns(spark, fanout=2, path=path) as runs:
            assert sorted(tuple(r) for r in runs.common_keys(2).collect()) == want and max(lv for lv, *_ in runs.runs) == 2
            plan = batch(spark, 1).join(spark.table(runs.runs[0][1]).hint("merge"), ["h1", "h2"], "left_anti")
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange") == 1               # the run's side is read in its buckets, sorted
    assert [t for t in spark.catalog.listTables() if t.name.startswith("lineruns")] == []


def test_a_failed_batch_counts_for_nothing(spark):
    import pytest
    with line_dedup.LineRuns(spark, fanout=2, buckets=2) as runs:
        runs.add(batch(spark, 0))
        broken = batch(spark, 1).withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
        with pytest.raises(Exception, match="lost"):
            runs.add(broken)
        path = runs.path
    with line_dedup.LineRuns(spark, fanout=2, path=path) as again:
        assert len(again.runs) == 1 and again.repeats == []
        again.add(batch(spark, 1))
        assert sorted(r.h1 for r in again.common_keys(2).collect()) == list(range(10, 20))


def test_manifest_starts_no_python_workers(spark, monkeypatch):
    """Rows of the driver would go through workers of another kind, which
    stay beside those of the later operators."""
    docs = edge.documents(spark, extra=True)

    def local(*_, **__):
        raise AssertionError("a local row")

    monkeypatch.setattr(type(spark), "createDataFrame", local)
    assert line_dedup.drop_common_lines(docs).count() == len(edge.EDGE)
