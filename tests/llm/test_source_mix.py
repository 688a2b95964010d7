import edge
import pytest

from tablework.llm import source_mix


def water_fill(sizes, weights, most=3):
    """Targets by sharing the excess again until no source is above."""
    total, out, stopped = float(sum(sizes)), [0.0] * len(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in stopped)
        heads = sum(w for i, w in enumerate(weights) if i not in stopped)
        for i, w in enumerate(weights):
            out[i] = most * sizes[i] if i in stopped else rest * w / heads
        over = {i for i in range(len(sizes)) if i not in stopped and out[i] > most * sizes[i]}
        if not over:
            return out
        stopped |= over


def check(spark, rows):
    got = source_mix.mix(edge.documents(spark, rows, extra=True)).collect()
    assert len(got) == len(rows)
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s))
    sizes = [sum(len(edge.words(t)) for _, t, s in rows if s == n) for n in names]
    want = dict(zip(names, water_fill(sizes, [1 + i % 3 for i in range(len(names))])))
    for n, size in zip(names, sizes):
        mine = [r for r in got if r.source == n]
        assert all(r.source_size == size and abs(r.target - want[n]) < 1e-6 for r in mine)
        assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in mine)
        least = min([r.size for r in mine if r.size] or [0])
        assert abs(sum(r.taken for r in mine) - want[n]) <= max(1, 3 * least)
    return got


def test_targets_and_words_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), "abcdefg"[i % 7] if i % 7 else None) for i in range(200)]
    rows += [(1000 + i, "only three words", "tiny") for i in range(2)] + [(2000, "", "zz"), (2001, None, "zz")]
    got = check(spark, rows)
    again = source_mix.mix(edge.documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_one_hot_cell_is_split_exactly(spark):
    rows = [(i, "four words of text", "hot") for i in range(5000)] + [(9000 + i, "a b c", "cold") for i in range(9000)]
    got = check(spark, rows)
    assert {r.copies for r in got if r.source == "hot"} <= {0, 1, 2, 3}


def test_edges(spark):
    got = source_mix.mix(edge.documents(spark, extra=True))
    assert got.count() == len(edge.EDGE)
    assert {"row", "key", "_id"} <= set(got.columns)
    copies = sum(r.copies for r in got.collect())
    assert source_mix.repeat_copies(got).count() == copies


def brute_copies(cells, a, most=3):
    """Copies per (size, n) cell of one source, step by step."""
    import math
    upto, total = 0.0, {}
    for size, n in sorted(cells, reverse=True):
        before = math.floor(upto + 0.5)
        upto += round(n * min(most, math.exp(a * size)), 12)
        total[size] = math.floor(upto + 0.5) - before
    missing = sum((round(n * min(most, math.exp(a * size)), 12) - total[size]) * size for size, n in cells)
    bands = {}
    for size, n in cells:
        k = int(math.log2(size))
        bands[k] = min(bands.get(k, (size, n)), (size, n))
    for k in sorted(bands, reverse=True):
        size, n = bands[k]
        more = max(-total[size], min(n * most - total[size], math.floor(abs(missing / size) + 0.5) * (1 if missing > 0 else -1)))
        total[size] += more
        missing -= more * size
    return total, missing


def test_copies_equal_a_plain_loop(spark, monkeypatch):
    """Running sums over blocks of 8 sizes."""
    import random
    monkeypatch.setattr(source_mix, "BLOCK", 8)
    rnd = random.Random(6)
    kinds = {"=a": (-0.011, 300), "=b": (0.004, 40), "": (0.0, 3)}
    cells = [(key, size, None, rnd.randint(1, 9)) for key, (_, m) in kinds.items() for size in rnd.sample(range(1, 900), m)]
    df = spark.createDataFrame(cells + [("=a", 0, None, 5)], "key string, size long, source string, n long")
    solved = spark.createDataFrame([(k, a) for k, (a, _) in kinds.items()], "key string, a double")
    got = {}
    for r in source_mix.cell_copies(df, solved).collect():
        got.setdefault(r.key, {})[r.size] = r.total
    assert got["=a"].pop(0) == 5
    for key, (a, _) in kinds.items():
        want, missing = brute_copies([(s, n) for k, s, _, n in cells if k == key], a)
        assert got[key] == want
        assert abs(missing) <= max(1, min(s for k, s, _, _ in cells if k == key))


def test_two_hundred_thousand_sizes_of_one_source(spark):
    """The cost is in proportion to the sizes: seconds, not their square."""
    import time
    from pyspark.sql import functions as F
    cells = spark.range(1, 200001).select(F.lit("=a").alias("key"), F.col("id").alias("size"), F.lit("a").alias("source"),
                                          (F.col("id") % 3 + 1).alias("n"))
    solved = spark.createDataFrame([("=a", -1e-5)], "key string, a double")
    start = time.time()
    total = source_mix.cell_copies(cells, solved)
    words = total.agg(F.sum(F.col("total") * F.col("size"))).first()[0]
    assert time.time() - start < 60
    want = cells.agg(F.sum(F.col("n") * F.col("size") * F.exp(F.col("size") * -1e-5))).first()[0]
    assert abs(words - want) < 2


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_nothing_to_mix(spark, rows):
    got = source_mix.mix(edge.documents(spark, rows)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * len(rows)


def test_rates_are_exponentially_tilted(spark):
    """The solved multipliers meet the targets: sum of size * exp(a * size)."""
    import math
    rows = [(i, " ".join(["w"] * (5 + i % 40)), "ab"[i % 2]) for i in range(400)]
    cells = spark.createDataFrame([("=" + s, n, s, c) for (s, n), c in
                                   __import__("collections").Counter((r[2], len(edge.words(r[1]))) for r in rows).items()],
                                  "key string, size long, source string, n long")
    goal = source_mix.targets(cells)
    for r in source_mix.solve(cells, goal).collect():
        words = sum(c.n * c.size * min(3.0, math.exp(r.a * c.size)) for c in cells.filter(cells.key == r.key).collect())
        assert abs(words - r.target) < 0.1
