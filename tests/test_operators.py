"""Operator semantics on small fixtures and invariants (FIXTURES §C, SURVEY §5)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablework.functions import scalars
from tablework.operators import (augment, features, groups, profile, quantiles, sampling,
                                 shapes, star)
from tablework.plans import reports


def test_feed_hours_and_peak(spark):
    df = spark.createDataFrame([("25:10:00",), ("",), (None,), (" 7:05:00",)], "t string")
    out = features.add_time_features(df, "t").collect()
    assert [r.arrival_hour_mod for r in out] == [1, None, None, 7]
    assert [r.is_peak for r in out] == [0, 0, 0, 1]


def test_peak_window_edges(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r.p for r in df.select(scalars.peak_flag("h").alias("p")).collect()]
    assert got == [0, 1, 1, 0, 0, 1, 1, 0]


def test_service_days_null_and_assembler_skip(spark):
    df = spark.createDataFrame([(1, 1, 0, None), (2, 1, 1, 1)], "id int, a int, b int, c int")
    out = df.withColumn("n", scalars.service_days(["a", "b", "c"]))
    assert [r.n for r in out.orderBy("id").collect()] == [None, 3]
    assembled = features.assemble(out, ["a", "n"])
    assert [r.id for r in assembled.collect()] == [2]
    sk = features.skipped_rows(out, ["a", "n"]).collect()[0]
    assert (sk.n_rows, sk.n_skipped) == (2, 1)


def test_clip_null_gives_upper_bound(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (3.0,), (9.0,)], "x double")
    got = [r.c for r in df.select(scalars.clip("x", -1.0, 5.99).alias("c")).collect()]
    assert got == [5.99, -1.0, 3.0, 5.99]


VALUES = [1.0, 2.0, 2.0, 5.0, 40.0, None]


def test_moments_and_profile_fixture(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double")
    m = profile.moments(df, "v", median="exact").collect()[0]
    assert m.skewness == pytest.approx(1.4710235706, abs=1e-9)
    assert m.kurtosis == pytest.approx(0.2092000037, abs=1e-9)
    assert m.median == 2.0 and m.min == 1.0 and m.max == 40.0
    q1, q3 = profile.quartiles(df, "v", "exact")
    assert (q1, q3) == (2.0, 5.0)
    p = profile.profile_columns(df).collect()[0]
    assert (p.column, p.null_count, p.distinct_count) == ("v", 1, 5)
    assert p.null_pct == pytest.approx(16.67)
    pa = profile.profile_columns(df, approx=True).collect()[0]
    assert pa.distinct_count == 5 and pa.null_count == 1


def test_empty_table_gives_nulls(spark):
    df = spark.createDataFrame([], "v double, f boolean")
    p = {r.column: r for r in profile.profile_columns(df).collect()}
    assert p["v"].null_pct is None and p["v"].null_count == 0
    o = profile.iqr_outliers(df, "v").collect()[0]
    assert o.q1 is None and o.outlier_pct is None and o.n_rows == 0
    assert augment.on_time_rate(df, "f").collect()[0].pct_on_time is None
    assert groups.value_share(df, "f").collect() == []
    assert quantiles.exact_quantiles(df, "v", [0.5]) == [None]


def _numpy_like_quantile(vals, p):
    s = sorted(vals)
    pos = p * (len(s) - 1)
    f, c = math.floor(pos), math.ceil(pos)
    return s[f] + (s[c] - s[f]) * (pos - f)


@pytest.mark.parametrize("leaf_rows", [5, 100_000])
def test_exact_quantiles_with_a_hot_value(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(quantiles, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(quantiles, "SKETCH_ERROR", 0.01)
    rnd = random.Random(7)
    vals = [rnd.expovariate(0.3) for _ in range(3000)] + [4.25] * 1500  # a third is one value
    rnd.shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, "x", probs)
    for p, g in zip(probs, got):
        assert g == pytest.approx(_numpy_like_quantile(vals, p), rel=1e-12, abs=1e-12)
    disc = quantiles.exact_quantiles(df, "x", probs, discrete=True)
    s = sorted(vals)
    assert disc == [s[max(math.ceil(p * len(s)) - 1, 0)] for p in probs]


def test_category_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "route_id string")
    out = features.index_categories(df, ["route_id"]).collect()
    got = {r.route_id: r.route_id_idx for r in out}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}


def test_injection_string_is_a_value(spark):
    ev = spark.createDataFrame([(1, "T1", "S", 1, "08:00:00", 7.0, 1, "Road closure")],
                               "event_id long, trip_id string, stop_id string, stop_sequence int, "
                               "arrival_time string, delay_minutes double, is_disrupted int, "
                               "disruption_reason string")
    tr = spark.createDataFrame([("T1", "R1", "C", "h", 0)],
                               "trip_id string, route_id string, service_id string, "
                               "trip_headsign string, direction_id int")
    s = {"delay_events": ev, "trips": tr}
    assert reports.disrupted_events_for_route(spark, s, "x' OR 1=1 --").count() == 0
    assert reports.disrupted_events_for_route(spark, s, "R1").count() == 1


def _delays(spark, n=4000, parts=1):
    base = spark.range(n).repartition(parts).select(
        F.col("id").cast("string").alias("trip_id"), F.lit(1).alias("stop_sequence"),
        (F.col("id") % 3).cast("string").alias("stop_id"),
        (F.col("id") % 17).cast("string").alias("route_id"))
    return augment.augment_delays(base)


def test_draws_do_not_depend_on_layout(spark):
    cols = ["trip_id", "p_on_time", "is_disrupted", "delay_minutes", "disruption_reason"]
    ref = sorted(tuple(r) for r in _delays(spark, parts=1).select(*cols).collect())
    for parts in (2, 8):
        assert sorted(tuple(r) for r in _delays(spark, parts=parts).select(*cols).collect()) == ref


def test_delay_invariants(spark):
    rows = _delays(spark).collect()
    for r in rows:
        assert 0.755 <= r.p_on_time < 0.845
        assert r.is_disrupted == (r.delay_minutes >= 6)
        if not r.is_disrupted:
            assert -1.0 <= r.delay_minutes <= 5.99
        assert (r.disruption_reason is not None) == r.is_disrupted
        if r.disruption_reason is not None:
            assert r.disruption_reason in augment.DISRUPTION_REASONS
    per_route = {}
    for r in rows:
        per_route.setdefault(r.route_id, set()).add(r.p_on_time)
    assert all(len(v) == 1 for v in per_route.values())
    share = sum(not r.is_disrupted for r in rows) / len(rows)
    assert 0.76 < share < 0.84


def test_hash_split_and_sample(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    a, b = sampling.split_hash(df, ["k"], (0.8, 0.2), 42)
    ia, ib = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert not (ia & ib) and len(ia | ib) == 20000
    n = sampling.sample_hash(df, ["k"], 0.05, 42).count()
    sd = math.sqrt(20000 * 0.05 * 0.95)
    assert abs(n - 1000) < 4 * sd
    assert sampling.sample_hash(df, ["k"], 1.0) is df
    again = {r.id for r in sampling.sample_hash(df.repartition(7), ["k"], 0.05, 42).collect()}
    assert again == {r.id for r in sampling.sample_hash(df, ["k"], 0.05, 42).collect()}


def test_histogram_counts_all_non_null(spark):
    df = spark.createDataFrame([(float(v),) for v in range(100)] + [(None,)], "x double")
    h = shapes.histogram(df, "x", 10).collect()
    assert sum(r.n for r in h) == 100 and len(h) == 10
    d = shapes.density_curve(df, "x", 50).collect()
    xs = [r.x for r in d]
    step = xs[1] - xs[0]
    assert sum(r.density for r in d) * step == pytest.approx(1.0, abs=0.02)


def test_star_first_per_key_and_orphans(spark):
    df = spark.createDataFrame(
        [("R1", "b", "A", 3, "T1", "S", "x", 0, "ST", 1, "08:00:00", 1.0, False, None),
         ("R1", "a", "A", 3, "T2", "S", "x", 0, "ST", 2, "08:00:00", 7.0, True, "Road closure")],
        "route_id string, route_short_name string, agency_id string, route_type int, "
        "trip_id string, service_id string, trip_headsign string, direction_id int, stop_id string, "
        "stop_sequence int, arrival_time string, delay_minutes double, is_disrupted boolean, "
        "disruption_reason string")
    s = star.build_star(df)
    assert [tuple(r) for r in s["routes"].collect()] == [("R1", "a", "A", 3)]
    ev = s["delay_events"].collect()
    assert len({r.event_id for r in ev}) == 2 and {r.is_disrupted for r in ev} == {0, 1}
    o = star.orphan_counts(s).collect()[0]
    assert (o.orphan_events, o.orphan_trips) == (0, 0)
    s["trips"] = s["trips"].where(F.col("trip_id") == "T1")
    assert star.orphan_counts(s).collect()[0].orphan_events == 1


def test_bucketed_star_join_needs_no_shuffle(spark, tmp_dir):
    from tablework.sources import write_star_catalog
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = spark.range(2000).select(F.col("id").alias("event_id"),
                                      (F.col("id") % 97).cast("string").alias("trip_id"),
                                      (F.col("id") % 7).cast("double").alias("delay_minutes"))
        tr = spark.range(97).select(F.col("id").cast("string").alias("trip_id"),
                                    (F.col("id") % 5).cast("string").alias("route_id"))
        names = write_star_catalog({"delay_events": ev, "trips": tr}, "tw_test_star", buckets=4)
        j = spark.table(names["delay_events"]).join(spark.table(names["trips"]), "trip_id")
        assert len(j.collect()) == 2000
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(trip_id" not in plan  # co-bucketed: no shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_stages_fit_transform(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", None)],
                               "route_id string, agency_id string, v double")
    model = features.feature_stages(["route_id", "agency_id"], ["route_id_idx", "agency_id_idx", "v"]).fit(df)
    out = model.transform(df).collect()
    assert len(out) == 2  # the null feature row is skipped
    assert {tuple(r.features.toArray()[:2]) for r in out} == {(0.0, 0.0), (0.0, 1.0)}


def _hot(spark, n=30000):
    # one route / trip holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 101).cast("string"))
        .alias("trip_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 7).cast("string"))
        .alias("route_short_name"),
        (F.col("id") % 13).cast("double").alias("delay_minutes"),
        (F.col("id") % 5 == 0).alias("is_disrupted"),
        F.col("id").cast("int").alias("stop_sequence"))


def test_hot_key_results_stay_whole(spark):
    df = _hot(spark)
    stats = {r.route_short_name: r for r in groups.group_stats(df).collect()}
    assert stats["HOT"].num_records == 10000
    assert sum(r.num_records for r in stats.values()) == 30000
    vol = {r.route_short_name: r for r in groups.group_volume(df).collect()}
    assert vol["HOT"].num_trips == 1 and vol["HOT"].num_stop_events == 10000
    first = star.first_per_key(df, "trip_id", ["trip_id", "stop_sequence"]).collect()
    assert {r.trip_id: r.stop_sequence for r in first}["HOT"] == 0


def test_clustering_splits_a_hot_key(spark):
    df = _hot(spark)
    def hot_parts(lay):
        return (lay.where(F.col("trip_id") == "HOT")
                   .select(F.spark_partition_id().alias("p")).distinct().count())
    salted = star.clustered(df, ["trip_id"], partitions=8)
    assert hot_parts(salted) >= 2  # the salt lets the range partitioner split the hot trip
    assert salted.count() == 30000
    plain = star.clustered(df, ["trip_id"], partitions=8, salt_rows=None)
    assert hot_parts(plain) == 1 and plain.count() == 30000


def test_binned_density_is_close_to_exact(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(5000)], "x double")
    exact = [r.density for r in shapes.density_curve(df, "x", 100, grid_bins=None).collect()]
    binned = [r.density for r in shapes.density_curve(df, "x", 100).collect()]
    assert max(abs(a - b) for a, b in zip(exact, binned)) < 1e-3


def test_profile_counts_the_named_columns_exactly(spark):
    df = spark.range(5000).select(F.col("id").alias("big"), (F.col("id") % 7).alias("small"),
                                  F.when(F.col("id") % 2 == 0, F.lit("x")).alias("half_null"))
    got = {r.column: r for r in profile.profile_columns_auto(df, ["small", "half_null"]).collect()}
    assert got["small"].distinct_exact and got["small"].distinct_count == 7
    assert got["half_null"].distinct_exact and got["half_null"].distinct_count == 2
    assert got["half_null"].null_count == 2500
    assert not got["big"].distinct_exact
    assert abs(got["big"].distinct_count - 5000) < 5000 * 0.05


def test_shapes_on_an_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    h = shapes.histogram(df, "x").collect()
    assert len(h) == 50 and {(r.n, r.bin_lo) for r in h} == {(0, None)}
    assert all(r.density is None for r in shapes.density_curve(df, "x").collect())
    one = spark.createDataFrame([(2.5,), (2.5,)], "x double")
    h = shapes.histogram(one, "x").collect()
    assert [r.n for r in h] == [2] + [0] * 49 and {r.bin_lo for r in h} == {2.5}
    for grid in (None, 4096):
        d = shapes.density_curve(one, "x", grid_bins=grid).collect()
        assert len(d) == 200 and all(r.density is None for r in d)


def test_shapes_leave_infinite_values_out(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float(v),) for v in range(10)] + [(inf,), (-inf,), (None,), (float("nan"),)], "x double")
    h = shapes.histogram(df, "x", 5).collect()
    assert sum(r.n for r in h) == 10 and h[0].bin_lo == 0.0 and h[-1].bin_hi == 9.0
    assert all(r.density > 0 for r in shapes.density_curve(df, "x", 20).collect())
    assert tuple(shapes.left_out(df, "x").first()) == (14, 1, 1, 2)


@pytest.mark.parametrize("extra", [float("inf"), 1.7e308])
def test_exact_quantiles_end_on_infinite_and_huge_ranges(spark, monkeypatch, extra):
    monkeypatch.setattr(quantiles, "LEAF_ROWS", 3)
    monkeypatch.setattr(quantiles, "SKETCH_ERROR", 0.05)
    vals = [float(v) for v in range(200)] + [extra, -extra, extra]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    stats = {}
    got = quantiles.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0], stats=stats)
    assert got[0] == -extra and got[-1] == extra and got[2] == 100.0
    assert got[1] == _numpy_like_quantile(vals, 0.25) and got[3] == _numpy_like_quantile(vals, 0.9)
    assert stats["passes"] <= 7
    assert quantiles.exact_quantiles(df, "x", [0.5], discrete=True) == [100.0]


def test_exact_quantiles_keep_integers_and_decimals(spark):
    from decimal import Decimal
    big = 2 ** 53
    df = spark.createDataFrame([(big + i, Decimal(f"1.00000000000000000{i}")) for i in range(9)],
                               "k bigint, d decimal(20,18)")
    assert quantiles.exact_quantiles(df, "k", [0.5, 0.25], discrete=True) == [big + 4, big + 2]
    assert quantiles.exact_quantiles(df, "d", [0.5], discrete=True) == [Decimal("1.000000000000000004")]


def test_exact_quantiles_on_wide_magnitudes_take_few_passes(spark):
    df = spark.range(60000).select(F.pow(F.lit(10.0), (F.col("id") % 600) - 300).alias("x"))
    stats = {}
    quantiles.exact_quantiles(df, "x", [0.25, 0.5, 0.75], stats=stats)
    assert stats["passes"] <= 4


def test_a_sample_splits_near_the_weights(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    s = sampling.sample_hash(df, ["k"], 0.25, 42)
    train, test = sampling.split_hash(s, ["k"], (0.8, 0.2), 42)
    n = s.count()
    assert train.count() + test.count() == n
    assert abs(test.count() - 0.2 * n) < 4 * math.sqrt(n * 0.16)


def test_profile_tells_repeated_hours_apart(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(2).select(F.timestamp_micros(F.lit(1730611800000000) + F.col("id") * 3600000000).alias("t"))
        assert profile.profile_columns(df).first().distinct_count == df.distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_category_mode_is_the_callers_choice(spark):
    from tablework.operators import models
    df = spark.range(400).select(
        F.col("id").cast("string").alias("trip_id"), F.lit(1).alias("stop_sequence"), F.lit("s").alias("stop_id"),
        F.lit("08:00:00").alias("arrival_time"), (F.col("id") % 50).cast("string").alias("route_id"),
        (F.col("id") % 7).cast("double").alias("delay_minutes"))
    for mode, bins in (("nominal", 51), ("ordinal", 32)):
        train, _, names = features.model_tables(df, category_mode=mode)
        assert models.max_bins_for(train) == bins
        assert models.feature_names(train) == names
    with pytest.raises(ValueError):
        features.model_tables(df, category_mode="auto")


def test_event_ids_are_unique_when_keys_repeat(spark):
    row = ("T", "S", 1, "08:00:00", 1.0, True, None)
    df = spark.createDataFrame([row, row, ("T", "S", 1, "09:00:00", 1.0, True, None)],
                               "trip_id string, stop_id string, stop_sequence int, arrival_time string, "
                               "delay_minutes double, is_disrupted boolean, disruption_reason string")
    ids = [r.event_id for r in star.fact_events(df, id_mode="hash").collect()]
    assert len(set(ids)) == 3
    assert sorted(ids) == sorted(r.event_id for r in star.fact_events(df.repartition(3), id_mode="hash").collect())


def test_exact_quantiles_on_values_a_few_ulps_apart(spark):
    import sys
    tiny = sys.float_info.min * 1e-10  # subnormal spacing
    vals = [0.0] * 50 + [tiny] * 30 + [2 * tiny] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quantiles.exact_quantiles(df, "x", [0.5, 0.9])
    s = sorted(vals)
    assert got[0] == s[49] + (s[50] - s[49]) * 0.5
    pos = 0.9 * 99
    assert got[1] == s[89] + (s[90] - s[89]) * (pos - 89)
    assert quantiles.exact_quantiles(df, "x", [0.9], discrete=True) == \
        [s[max(math.ceil(0.9 * len(s)) - 1, 0)]]


def test_exact_quantiles_ignore_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (2.0,)], "x double")
    assert quantiles.exact_quantiles(df, "x", [0.0, 0.5, 1.0]) == [1.0, 2.0, 3.0]


def test_shapes_ignore_nan(spark):
    df = spark.createDataFrame([(float(v),) for v in range(10)] + [(float("nan"),)], "x double")
    h = shapes.histogram(df, "x", 5).collect()
    assert sum(r.n for r in h) == 10 and h[-1].bin_hi == 9.0
    assert len(shapes.density_curve(df, "x", 20).collect()) == 20
