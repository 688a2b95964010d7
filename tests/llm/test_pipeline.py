import os

import edge
import public_tokenizers  # noqa: F401  (the vocabulary's package)
from conftest import SF001
from test_bpe import TIK
from test_line_dedup import brute
from test_quality_rules import counts

import corpus_pipeline as P
from tablework.llm.common import handover


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "source_mix", "byte_bpe"]
    assert P.ORACLE_SQL is None


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    before = [r.asDict() for r in docs.collect()]
    results = {}
    for name, stage in P.STAGES:
        docs = handover(stage(spark, docs, SF001), f"test-{name}")
        results[name] = [r.asDict() for r in docs.collect()]
        if name != "byte_bpe":
            assert docs.columns == columns
    base = [d for d in before if not ((c := counts(d["text"]))[0] < 20 or 100 * c[4] > 30 * c[0])]
    kept = results["quality_rules"]
    # too few labels here to prove a cutoff: what passes the base rules stays
    assert sorted(d["doc_id"] for d in kept) == sorted(d["doc_id"] for d in base)
    lined = {i: t for i, _, _, t in brute([(d["doc_id"], d["text"], None) for d in kept])}
    assert {d["doc_id"]: d["text"] for d in results["line_dedup"]} == lined
    assert all(d["n_chars"] == len(d["text"]) for d in results["line_dedup"])
    named = edge.groups(lined.items(), 5, 80, 100)
    assert sorted(d["doc_id"] for d in results["ngram_join"]) == sorted(i for i, (_, top) in named.items() if i == top)
    alone = {d["doc_id"]: d for d in results["ngram_join"]}
    assert all(alone[d["doc_id"]] == d for d in results["source_mix"])
    times = [sum(d["doc_id"] == i for d in results["source_mix"]) for i in alone]
    assert max(times) <= 3
    last = sorted((d["doc_id"], d["ids"]) for d in results["byte_bpe"])
    assert last == sorted((d["doc_id"], TIK.encode_ordinary(d["text"])) for d in results["source_mix"])
    assert all(d["round_trip"] for d in results["byte_bpe"])


def test_one_worker_per_task_encodes_and_decodes(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = P.encode(spark, docs, SF001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_hard_rows_pass_all_stages(spark, tmp_path):
    more = [(20 + i, f"{edge.SHARED}\n" + " ".join(f"tok{i}x{j}" for j in range(30)), "d") for i in range(4)]
    docs = edge.documents(spark, edge.EDGE + more, extra=True).selectExpr("*", "'en' AS lang", "cast(1 as bigint) AS n_chars")
    spark.createDataFrame([(5, 1), (None, 0), (20, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert out and all(r.round_trip for r in out)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    os.rename(f"{tmp_path}/labels.parquet", f"{tmp_path}/none/labels.parquet")
    assert P.run(spark, f"{tmp_path}/none").collect() == []
