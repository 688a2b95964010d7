"""Property tests: random inputs, one DataFrame per example."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablework.functions import scalars
from tablework.operators import quantiles, sampling

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.tuples(st.integers(0, 47), st.integers(0, 59)), min_size=1, max_size=60))
def test_hour_of_day_and_peak(spark, times):
    rows = [(f"{h:02d}:{m:02d}:00", h) for h, m in times]
    df = spark.createDataFrame(rows, "t string, h int")
    got = df.select("h", scalars.hour_of_day("t").alias("hm"),
                    scalars.peak_flag(scalars.hour_of_day("t")).alias("p")).collect()
    for r in got:
        assert r.hm == r.h % 24
        assert r.p == int(7 <= r.h % 24 <= 9 or 16 <= r.h % 24 <= 18)


@SLOW
@given(st.lists(st.one_of(st.floats(-50, 50, allow_nan=False), st.sampled_from([0.0, 1.5, -2.25])),
                min_size=1, max_size=300),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_match_sorting(spark, vals, probs):
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    got = quantiles.exact_quantiles(df, "x", probs)
    s = sorted(vals)
    for p, g in zip(probs, got):
        pos = p * (len(s) - 1)
        f, c = math.floor(pos), math.ceil(pos)
        want = s[f] + (s[c] - s[f]) * (pos - f)
        assert math.isclose(g, want, rel_tol=1e-9, abs_tol=1e-9)
    disc = quantiles.exact_quantiles(df, "x", probs, discrete=True)
    assert disc == [s[max(math.ceil(p * len(s)) - 1, 0)] for p in probs]


@SLOW
@given(st.lists(st.text(min_size=1, max_size=8), min_size=1, max_size=200, unique=True),
       st.integers(1, 6))
def test_split_is_complete_disjoint_and_layout_free(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    one = {r.k: r.s for r in df.select("k", sampling.split_column(["k"], (0.7, 0.3), 5).alias("s")).collect()}
    many = {r.k: r.s for r in df.repartition(parts)
            .select("k", sampling.split_column(["k"], (0.7, 0.3), 5).alias("s")).collect()}
    assert one == many and set(one) == set(keys) and set(one.values()) <= {0, 1}
