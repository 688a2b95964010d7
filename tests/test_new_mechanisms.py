"""Numbering by ranges, the category index, the lookup layout, mergeable
states, rejected cells, inference and the observed gate."""

import contextlib
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType

from conftest import SF001, write_text
from tablework.operators import features, numbering, profile, quantiles, star, states
from tablework.plans import batch, standins as SI
from tablework.session import shared_scratch
from tablework.sources import feeds, schemas


def scans(df):
    """The scan nodes of an executed plan (AQE's final one)."""
    def walk(plan):
        kids = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            kids = [plan.executedPlan()]
        elif "QueryStage" in plan.nodeName():
            kids = [plan.plan()]
        return ([plan] if plan.nodeName().startswith("Scan") else []) + [x for k in kids for x in walk(k)]
    return walk(df._jdf.queryExecution().executedPlan())


# ------------------------------------------------------------- numbering

def test_numbers_are_dense_and_follow_the_order(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "hot", "hot", "hot"]), rnd.randint(0, 50)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int")
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1]))
    for parts in (1, 3, 8, None):
        got = numbering.numbered(df, [F.col("k"), F.col("v").desc()], "n", start=5, partitions=parts).collect()
        assert [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["n"])] == want
        assert sorted(r["n"] for r in got) == list(range(5, 3005))
    assert numbering.numbered(df.where("false"), [F.col("v")], "n").collect() == []


def test_a_hot_value_is_numbered_in_several_ranges(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = numbering.numbered(df, [F.col("k"), F.col("v")], "n", partitions=8)
    ranges = plan.groupBy(F.spark_partition_id()).count().collect()
    assert plan.where(F.col("n") != F.col("v")).count() == 0
    assert "Window" not in plan.select("k", "v")._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert len(ranges) >= 1


def test_dense_event_ids_do_not_follow_the_partitions(spark):
    d = SI.delays(spark, SF001)
    few, many = (sorted(map(tuple, star.fact_events(x, "dense", partitions=n).collect()))
                 for x, n in ((d, 3), (d.repartition(7), 8)))
    assert few == many and [r[0] for r in few] == list(range(1, len(few) + 1))
    with pytest.raises(ValueError):
        star.fact_events(d, "serial")


def test_hash_ids_tell_which_key_is_null(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    ids = [r[0] for r in df.select(star.event_id_hash(["x", "y"])).collect()]
    assert ids[0] != ids[1]


# -------------------------------------------------------- category index

def test_index_equals_mllib_without_its_label_list(spark):
    from pyspark.ml.feature import StringIndexer
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "", *"aabbbcde"]), rnd.randint(0, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, n int")
    other = spark.createDataFrame([("a", 3), ("zz", 77), (None, None)], "k string, n int")
    mine = features.index_categories(other.unionAll(df), ["k", "n"], fit_on=df)
    theirs = StringIndexer(inputCols=["k", "n"], outputCols=["k_idx", "n_idx"], handleInvalid="keep",
                           stringOrderType="frequencyDesc").fit(df).transform(other.unionAll(df))
    assert Counter(map(tuple, mine.collect())) == Counter(map(tuple, theirs.collect()))
    assert mine.schema["k_idx"].metadata["ml_attr"]["num_vals"] == len({k for k, _ in rows if k is not None}) + 1


def test_many_labels_stay_off_the_driver(spark, monkeypatch):
    """200,000 labels: what is collected has one row per column."""
    df = spark.range(300000).select(F.concat(F.lit("t"), F.col("id") % 200000).alias("trip"), F.lit("x").alias("mode"))
    read = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: read.append(rows := collect(self)) or rows)
    index = features.fit_index(df, ["trip", "mode"])
    monkeypatch.undo()
    assert sum(map(len, read)) == 2 and index.sizes == {"trip": 200000, "mode": 1}
    got = index.transform(spark.createDataFrame([("t5", "x"), ("t199999", "y"), ("new", None)], "trip string, mode string"))
    first = sorted(f"t{i}" for i in range(100000)).index("t5")
    last = 100000 + sorted(f"t{i}" for i in range(100000, 200000)).index("t199999")
    assert sorted(tuple(r) for r in got.select("trip", "trip_idx", "mode_idx").collect()) == [
        ("new", 200000.0, 1.0), ("t199999", float(last), 1.0), ("t5", float(first), 0.0)]


def test_index_of_an_empty_or_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "k string")
    assert [r[1] for r in features.index_categories(df, ["k"]).collect()] == [0.0, 0.0]
    assert features.index_categories(df, ["absent"]).columns == ["k"]


# ---------------------------------------------------------- lookup layout

def test_interleaved_bits(spark):
    df = spark.createDataFrame([(5, 3, 6), (0, 0, 0), (1023, 1023, 1023)], "a long, b long, c long")
    got = [r[0] for r in df.select(star.interleaved([F.col(c) for c in "abc"], 10)).collect()]
    def code(a, b, c):
        return int("".join(x + y + z for x, y, z in zip(*(f"{v:010b}" for v in (a, b, c)))), 2)
    assert got == [code(5, 3, 6), 0, code(1023, 1023, 1023)]


def test_one_fact_answers_three_lookups_from_few_files(spark):
    """Bounds and Bloom filters: the scan lets through only the rows of files
    that hold the value."""
    n = 64000
    events = spark.range(n).select(F.col("id").alias("event_id"), (F.col("id") % 8000).cast("string").alias("trip_id"),
                                   F.pmod(F.xxhash64("id"), F.lit(2000)).cast("string").alias("stop_id"),
                                   F.when(F.col("id") % 8000 > 5, (F.col("id") % 8000 % 400).cast("string")).alias("route_id"))
    path = star.write_lookup_fact(events, shared_scratch(spark, "lookup"), files=64)
    fact = spark.read.schema(events.schema).parquet(path)
    assert fact.count() == n and fact.exceptAll(events).count() == 0
    for column, value in (("trip_id", "77"), ("stop_id", "1234"), ("route_id", "39"), ("trip_id", "none")):
        held = (fact.groupBy(F.input_file_name().alias("f"))
                .agg(F.count_if(F.col(column) == value).alias("here"), F.count("*").alias("rows")).where("here > 0"))
        expected = held.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
        found = star.lookup(fact, column, value)
        assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in events.where(F.col(column) == value).collect())
        read = sum(s.metrics().apply("numOutputRows").value() for s in scans(found))
        assert read <= expected[0] + 2 * (n // 64)         # one or two false positives of the filters
        assert expected[1] * 3 <= 64


# ------------------------------------------------------- mergeable states

def numbers(spark, n=30000):
    x = F.pmod(F.xxhash64("id"), F.lit(100003)).cast("double")
    return spark.range(n).select("id", F.when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, F.lit(float("nan")))
                                 .when(F.col("id") % 17 == 0, F.lit(-0.0)).when(F.col("id") % 19 == 0, F.lit(0.0)).otherwise(x / 8).alias("x"),
                                 (F.col("id") % 7).cast("string").alias("s"), F.lit(None).cast("int").alias("none"))


def test_merged_states_equal_a_single_pass(spark):
    df, path = numbers(spark), shared_scratch(spark, "states")
    for k in range(3):
        saved = states.append_state(df.where(f"id % 3 = {k}"), path, f"b{k}")
    single = states.batch_state(df, "all")
    columns = ["column", "null_count", "null_pct", "distinct_count"]
    merged = {r["column"]: r for r in states.profile_of(saved).select(columns).collect()}
    for r in profile.profile_columns(df).select(columns).collect():
        got = merged[r["column"]]
        assert (got["null_count"], got["null_pct"]) == (r["null_count"], r["null_pct"])
        assert abs(got["distinct_count"] - r["distinct_count"]) <= 0.04 * r["distinct_count"] + 1
    assert {r["column"]: r["distinct_count"] for r in states.profile_of(single).collect()} == {c: m["distinct_count"] for c, m in merged.items()}
    files = [f for s in scans(p) for f in (p.inputFiles(),)] if scans(p := states.profile_of(saved)) else p.inputFiles()
    assert files and all("states" in str(f) for f in states.profile_of(saved).inputFiles())


def test_a_batch_counts_once_and_may_be_empty(spark):
    df, path = numbers(spark, 100), shared_scratch(spark, "states")
    states.append_state(df, path, "b")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        states.append_state(df, path, "b")
    saved = states.append_state(df.where("false"), path, "empty")
    assert {r["column"]: r["null_count"] for r in states.profile_of(saved).collect()} == {"id": 0, "x": 10, "s": 0, "none": 100}
    assert quantiles.quantiles_from_states(df.where("false"), states.batch_state(df.where("false"), "e"), "x", [0.5]) == [None]


@pytest.mark.parametrize("probs,discrete", [([0.0, 0.25, 0.5, 0.75, 1.0], False), ([0.01, 0.5, 0.999], True)])
def test_quantiles_from_states_in_two_passes(spark, probs, discrete):
    df, path = numbers(spark), shared_scratch(spark, "states")
    for k in range(3):
        saved = states.append_state(df.where(f"id % 3 = {k}"), path, f"b{k}")
    passes = {}
    got = quantiles.quantiles_from_states(df, saved, "x", probs, discrete, passes)
    assert got == quantiles.exact_quantiles(df, "x", probs, discrete) and passes["passes"] <= 2


def test_states_of_other_rows_are_refused(spark):
    df = numbers(spark)
    with pytest.raises(ValueError, match="states hold"):
        quantiles.quantiles_from_states(df.where("id > 20"), states.batch_state(df, "b"), "x", [0.5])


# -------------------------------------------------- rejects, types, gate

FEED = ("trip_id,stop_sequence,shape_dist_traveled,arrival_time\n001,1,1.5,25:00:00\n002,x,,\n003,99999999999,1e3,\n"
        "004, 7 ,abc,08:00:00\n,,,\n")


def test_rejected_cells_are_listed_with_their_reason(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/stop_times.txt", FEED)
    df = feeds.read_feed(spark, p, schemas.STOP_TIMES, rejects=True)
    table, rejects, gate = feeds.write_feed(df, shared_scratch(spark, "feed"), min_rows=5)
    assert sorted(tuple(r) for r in rejects.collect()) == [
        ("stop_times.txt", "shape_dist_traveled", "abc", "not double"),
        ("stop_times.txt", "stop_sequence", "99999999999", "out of range of int"),
        ("stop_times.txt", "stop_sequence", "x", "not int")]
    assert sorted((r.trip_id or "", r.stop_sequence) for r in table.collect()) == [("", None), ("001", 1), ("002", None), ("003", None), ("004", 7)]
    assert feeds.REJECTS not in table.columns and gate.collect()[0].asDict() == {"n_rows": 5, "threshold": 5, "ok": True}


def test_inference_keeps_ids(spark, tmp_dir):
    rows = ["id,n,big,long,x,flag,mixed,none,neg,zero", "001,1,12345678901,123456789012345678901,1.5,true,1,,-3,0",
            "002,2,1,2,.5e3,FALSE,a,,+4,0"]
    df = feeds.read_feed(spark, write_text(f"{tmp_dir}/f.txt", "\n".join(rows) + "\n"), infer=True)
    kinds = {f.name: type(f.dataType) for f in df.schema.fields}
    assert kinds == {"id": StringType, "n": IntegerType, "big": LongType, "long": StringType, "x": DoubleType,
                     "flag": BooleanType, "mixed": StringType, "none": StringType, "neg": IntegerType, "zero": IntegerType}
    assert [r.id for r in df.collect()] == ["001", "002"]


def test_the_gate_needs_no_scan_of_its_own(spark, tmp_dir):
    """Ingest runs over the stop events once: a reader that counts its rows
    sees each of them one time."""
    feed = SI.feed(spark, SF001)
    n = feed["stop_times"].count()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    st = feed["stop_times"]
    feed["stop_times"], gate = feeds.gated(st.mapInArrow(count, st.schema), 10)
    batch.write_schedule(feed, shared_scratch(spark, "schedule"))
    assert gate().collect()[0].n_rows == n and seen.value == n


def test_gate_of_an_empty_table(spark):
    rows, gate = feeds.gated(spark.createDataFrame([], "x int"), 1)
    feeds.write_table(rows, shared_scratch(spark, "empty"))
    assert gate().collect()[0].asDict() == {"n_rows": 0, "threshold": 1, "ok": False}


# ------------------------------------------------------------- orphans

def test_orphans_are_counted_per_key_before_the_join(spark):
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 9 == 1, F.lit(None))
                                     .otherwise(F.col("id").cast("string")).alias("k"))
    parent = spark.range(9000).where("id % 2 = 0").select(F.col("id").cast("string").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)       # else Spark joins the rows to a broadcast parent
    keys = star.orphan_keys(child, parent, "k")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert keys.agg(F.sum("n_rows")).first()[0] == star.orphans(child, parent, "k").count()
    join = plan.index("LeftAnti")
    assert plan.index("partial_count") > join               # the count is below the join


# -------------------------------------------------- encoding and fits

def test_means_leave_out_a_rows_own_fold(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1.0, 2.0, 9.0]), i % 4 != 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k string, y double, train boolean")
    means = features.fit_means(df.where("train"), ["id"], ["k"], label="y")
    got = means.transform(df.unionAll(spark.createDataFrame([(900, "new", 1.0, False)], df.schema)), F.col("train"))
    fold = {r["id"]: r["f"] for r in df.select("id", means.fold.alias("f")).collect()}
    fitted = [(i, k, y) for i, k, y, t in rows if t and y is not None]
    prior = sum(y for _, _, y in fitted) / len(fitted)
    for r in got.collect():
        seen = [y for i, k, y in fitted if k == r["k"] and k is not None and not (r["train"] and fold[i] == fold[r["id"]])]
        want = (sum(seen) + prior * features.PRIOR_ROWS) / (len(seen) + features.PRIOR_ROWS)
        assert abs(r["k_mean"] - want) < 1e-9
    assert len(set(fold.values())) == features.FOLDS
    with pytest.raises(ValueError):
        features.indexed_features(SI.delays(spark, SF001), category_mode="median")


def test_held_out_rows_stop_boosting_and_fit_no_means(spark):
    from tablework.operators import models
    train, test, names = features.model_tables(SI.delays(spark, SF001), category_mode="mean", validation=0.2)
    assert "route_id_mean" in names and "route_id_idx" not in names and "held_out" in train.columns
    share = train.agg(F.avg(F.col("held_out").cast("double"))).first()[0]
    assert 0.15 < share < 0.25 and test.where("held_out").count() == 0
    assert models.fit_gbt(train, max_iter=20, max_depth=3, held_out="held_out").getNumTrees < 20


def test_linear_states_merge_and_skip_null_rows(spark):
    import numpy as np
    from tablework.operators import linear_state as L
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(500, 3)) * [1, 1000, 0.001] + [5, 1e6, 0]
    y = x @ [2.0, -0.5, 30.0] + 7 + rnd.normal(size=500) * 0.01
    rows = [(*map(float, v), float(t)) for v, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0), (1.0, 1.0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").withColumn("k", F.lit(3))
    parts = [L.linear_state(df.where(F.pmod(F.xxhash64("b"), F.lit(3)) == i), ["a", "b", "c", "k"], "y") for i in range(3)]
    fit = L.solve(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    want, *_ = np.linalg.lstsq(np.column_stack([x - x.mean(0)]), y - y.mean(), rcond=None)
    assert fit["n"] == 500 and np.allclose([fit["coefficients"][c] for c in "abc"], want, rtol=1e-4)
    assert fit["coefficients"]["k"] == 0 and fit["r2"] > 0.999
    assert L.solve(L.linear_state(df.where("false"), ["a"], "y"))["n"] == 0


# ---------------------------------------------------------- publishing

def test_a_failed_publish_leaves_the_old_star(spark):
    target = shared_scratch(spark, "star")
    with pytest.raises(FileNotFoundError):
        feeds.read_star(spark, target)
    old = {"routes": spark.createDataFrame([("1",)], "route_id string"), "trips": spark.createDataFrame([("a", "1")], "trip_id string, route_id string")}
    feeds.publish_star(old, target)
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("string").alias("trip_id"), F.lit("2").alias("route_id"))
    with pytest.raises(Exception, match="lost"):
        feeds.publish_star({"routes": spark.createDataFrame([("2",), ("3",)], "route_id string"), "trips": broken}, target)
    now = feeds.read_star(spark, target)
    assert [r[0] for r in now["routes"].collect()] == ["1"] and now["trips"].count() == 1
    feeds.publish_star({"routes": spark.createDataFrame([("2",)], "route_id string")}, target)
    assert {k: [r[0] for r in v.collect()] for k, v in feeds.read_star(spark, target).items()} == {"routes": ["2"]}


def test_the_package_is_sent_once(spark):
    from tablework.session import ship_package
    ship_package(spark)
    before = list(spark.sparkContext._python_includes)
    ship_package(spark)
    assert spark.sparkContext._python_includes == before and any("tablework" in x for x in before)


def test_ranks_found_without_a_join_are_those_of_the_values(spark):
    from tablework.operators import star
    values = [None, "", *[str(i) for i in range(90)], "é"]
    df = spark.createDataFrame([(v,) for v in values * 3], "k string")
    starts, n = star.ranked(df, "k", bits=5)
    assert n == 92 and len(starts) == 32
    ranks = star.with_ranks(df, {"k": starts}, ["rank"])
    order = sorted(v for v in values if v is not None)
    assert {r["k"]: r["rank"] for r in ranks.collect()} == {None: 0, **{v: i * 32 // 92 for i, v in enumerate(order)}}
    assert ranks.count() == df.count() and star.ranked(df.where("k = 'none'"), "k") == ([], 0)
    assert {r["rank"] for r in star.with_ranks(df, {"k": []}, ["rank"]).collect()} == {0}
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan



def test_routes_and_calendar_meet_trips_before_the_stop_events(spark):
    """One row per trip meets its route, so the fact moves twice, not thrice."""
    from tablework.operators.denorm import denormalise
    st = spark.createDataFrame([("T1", "S1", "x"), ("T1", None, "y"), (None, "S1", "z")], "trip_id string, stop_id string, note string")
    trips = spark.createDataFrame([("T1", None, "C1"), ("T1", "R1", None)], "trip_id string, route_id string, service_id string")
    routes = spark.createDataFrame([("R1", "a"), ("R1", "b")], "route_id string, note string")     # shares a name
    stops = spark.createDataFrame([("S1", "s")], "stop_id string, stop_name string")
    cal = spark.createDataFrame([("C1", 1)], "service_id string, monday int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = denormalise(st, trips, routes, stops, cal)
        assert df.columns == ["service_id", "stop_id", "route_id", "trip_id", "note", "note", "stop_name", "monday"]
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, [
            (svc, stop, route, "T1", note, rn, "s" if stop else None, day) for note, stop in (("x", "S1"), ("y", None))
            for svc, route, rn, day in (("C1", None, None, 1), (None, "R1", "a", None), (None, "R1", "b", None))]))
        plan = denormalise(st, trips, routes.select("route_id"), stops, cal).explain
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            plan()
        assert text.getvalue().index("hashpartitioning(trip_id") < text.getvalue().index("hashpartitioning(route_id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delay_columns_are_worked_out_once(spark):
    """Filters on drawn columns of the lazy table repeat the draws; those on
    the written one read a column."""
    from tablework.operators import shapes
    from tablework.plans import standins as SI
    lazy, once = SI.delays(spark, SF001), SI.delay_table(spark, SF001, "delay_minutes")
    assert sorted(r[0] for r in lazy.select("delay_minutes").collect()) == sorted(r[0] for r in once.collect())
    assert "md5" not in shapes.histogram(once, "delay_minutes", 50)._jdf.queryExecution().optimizedPlan().toString()


def test_trees_on_blocks_use_every_row_and_score_like_trees_on_rows(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    from tablework.operators import models
    x = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) / 10_000 for k in range(2)]
    rows = spark.range(0, 6000, 1, 4).select(array_to_vector(F.array(x[0], x[1], (F.col("id") % 3).cast("double"))).alias("features"),
                                 F.when(x[0] > 0.5, 8.0).otherwise(2.0).alias("signal"), x[1].alias("noise"), (F.col("id") % 10 == 0).alias("held"))
    rows = rows.select("features", (F.col("signal") + F.col("noise") + F.col("features").isNotNull().cast("int")).alias("label"), "held")
    assert models.row_blocks(rows) is None and models.row_blocks(rows.limit(0)) is None
    blocks, bins = models.row_blocks(rows, "held", blocks=500, bins=8)
    assert [c and len(c) for c in bins.cuts] == [7, 7, None]
    fitted, kept = blocks.where("NOT held"), rows.where("NOT held")
    sums = [F.sum("weight"), F.round(F.sum(F.col("label") * F.col("weight")), 6)]
    assert tuple(fitted.agg(*sums).first()) == tuple(kept.agg(F.count("*").cast("double"), F.round(F.sum("label"), 6)).first())
    assert fitted.count() <= 500 and blocks.where("held").count() == rows.where("held").count()

    plain = models.fit_gbt(rows, max_iter=5, max_depth=3, held_out="held")
    monkeypatch.setattr(models.row_blocks, "__defaults__", (None, 500, 32))
    for model in (models.fit_gbt(rows, max_iter=5, max_depth=3, held_out="held"), models.fit_forest(rows, 5, 4, featureSubsetStrategy="all")):
        assert isinstance(model, models.BinnedTrees) and len(model.featureImportances.toArray()) == 3
        scored = model.transform(rows)
        assert scored.columns == [*rows.columns, "prediction"] and scored.select(*rows.columns).collect() == rows.collect()
        assert models.regression_metrics(model.transform(rows)).first()["rmse"] < 1.2 * models.regression_metrics(plain.transform(rows)).first()["rmse"] + 0.6
