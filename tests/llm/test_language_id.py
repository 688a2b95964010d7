import random
import zlib

import edge
from conftest import SF001
from pyspark.sql import functions as F

from tablework.llm import language_id as L
from tablework.llm import queries

VOCABULARY = {"xx": "kra zul mog tarn gruk plosh".split(), "yy": "elia aniro ouie soleane luia miora".split(),
              "zz": "tsch pfent wischt krapf schnitz zwat".split()}


def text(lang, n, seed):
    random.seed(seed)
    return " ".join(random.choice(VOCABULARY[lang]) for _ in range(n))


def model(spark):
    rows = [(text(lang, 40, i), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 20)] + [(None, "xx"), ("no", None)]
    return L.train(spark.createDataFrame(rows, "text string, lang string"))


def test_single_and_mixed_languages(spark):
    m = model(spark)
    assert m.names == ["xx", "yy", "zz"]
    for lang in VOCABULARY:
        assert m.shares(text(lang, 30, 99))[0][0] == lang and len(m.shares(text(lang, 30, 99))) == 1
    mixed = m.shares(text("xx", 60, 1) + " " + text("yy", 30, 2))
    assert [name for name, _ in mixed] == ["xx", "yy"] and 0.5 < mixed[0][1] < 0.8
    assert abs(sum(s for _, s in mixed) - 1) < 0.01


def test_edges(spark):
    rows = edge.EDGE + [(50, "123 !? 456", "a")]
    got = L.identify(edge.documents(spark, rows, extra=True), model(spark)).collect()
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 50):
        assert (by[i].lang_pred, by[i].score, by[i].shares) == ("und", 0.0, [])
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    assert L.identify(edge.documents(spark, []), model(spark)).collect() == []


def test_no_training_rows(spark):
    empty = L.train(spark.createDataFrame([], "text string, lang string"))
    got = L.identify(edge.documents(spark), empty).collect()
    assert {r.lang_pred for r in got} == {"und"}


def plain_shares(m, text):
    """EM and the penalised choice of languages in plain Python."""
    import math
    from collections import Counter
    counts = Counter(L.trigrams(text).tolist())
    total = sum(counts.values())

    def em(langs):
        share = {i: 1 / len(langs) for i in langs}
        if len(langs) > 1:
            for _ in range(L.ROUNDS):
                new = dict.fromkeys(langs, 0.0)
                for b, n in counts.items():
                    all_ = sum(share[i] * m.probabilities[b, i] for i in langs)
                    for i in langs:
                        new[i] += n * share[i] * m.probabilities[b, i] / all_ / total
                moved = max(abs(new[i] - share[i]) for i in langs)
                share = new
                if moved < 1e-3:
                    break
        return share, sum(n * math.log(sum(share[i] * m.probabilities[b, i] for i in langs)) for b, n in counts.items())

    full, _ = em(range(len(m.names)))
    order = sorted(full, key=lambda i: (-full[i], i))
    share, best = em(order[:1])
    for k in range(2, len(order) + 1):
        more, likelihood = em(order[:k])
        if likelihood - best <= 0.5 * math.log(total + 1):
            break
        share, best = more, likelihood
    return sorted(((m.names[i], s) for i, s in share.items()), key=lambda x: (-x[1], x[0]))


def test_equals_plain_em_and_choice(spark):
    m = model(spark)
    random.seed(12)
    texts = [" ".join(text(lang, random.randint(0, 12), random.random()) for lang in random.choices(["xx", "yy", "zz"], k=3))
             for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts) if t.strip()]
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string"), m).collect()
    assert len({len(r.shares) for r in got}) > 1
    for r in got:
        want = plain_shares(m, r.text)
        assert [s.lang for s in r.shares] == [name for name, _ in want]
        assert all(abs(s.share - w) < 1e-4 for s, (_, w) in zip(r.shares, want))
        assert (r.lang_pred, r.score) == (r.shares[0].lang, r.shares[0].share)


def test_held_out_accuracy(spark):
    got = queries.op10_language_id(spark, SF001)
    truth = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert spark.range(1).select(L.held_out(F.lit(None).cast("long")).alias("h")).first().h is False
