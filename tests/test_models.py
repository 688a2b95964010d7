"""Rows-only keys checked by bounds."""

import glob

from pyspark.sql import functions as F

from conftest import SF001
from tablework.operators import features, models, profile
from tablework.plans import standins as SI
from tablework.session import shared_scratch
from tablework.sources import write_metrics


def test_approx_quartiles_within_rank_error(spark):
    d = SI.delays(spark, "/root/testdata/sf0.01").select("delay_minutes").cache()
    n = d.count()
    for p, a in zip([0.25, 0.75], profile.quartiles(d, "delay_minutes", "approx", 0.01)):
        below = d.where(F.col("delay_minutes") < a).count()
        at_most = d.where(F.col("delay_minutes") <= a).count()
        target = p * n
        assert below - 0.01 * n <= target <= at_most + 0.01 * n
    d.unpersist()


def test_trees_beat_the_mean(spark):
    train, test, names = features.model_tables(SI.delays(spark, SF001))
    sd = test.agg(F.stddev_pop("label")).first()[0]
    for fit, kw in [(models.fit_forest, {"num_trees": 5, "max_depth": 4}),
                    (models.fit_gbt, {"max_iter": 5, "max_depth": 3})]:
        m = models.regression_metrics(fit(train, **kw).transform(test)).first()
        assert m.rmse < sd and m.r2 > 0.3


def test_max_bins_from_metadata(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefghij" * 5], "route_id string")
    idx = features.index_categories(df, ["route_id"])
    a = features.assemble(idx, ["route_id_idx"])
    assert models.max_bins_for(a, floor=2) == 11  # 10 labels + the unknown bucket


def test_metrics_csv_and_best_model(spark):
    table = models.model_comparison(spark, [("A", 2.0, 1.0, 0.5, 1.0, 0.5),
                                            ("B", 1.5, 1.0, 0.6, 2.0, 0.333333)])
    path = write_metrics(table, shared_scratch(spark, "metrics"))
    parts = glob.glob(path.replace("file:", "") + "/part-*.csv")
    assert len(parts) == 1
    head = open(parts[0]).readline().strip()
    assert head == "model,rmse,mae,r2,train_seconds,efficiency_score_per_sec"
    assert models.best_model(table).first().model == "B"
    assert models.efficiency(2.0, 0.0) is None and models.efficiency(2.0, 1.0) == 0.5


def _feature_rows(spark, n=3000):
    from pyspark.ml.functions import array_to_vector
    x = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000 for k in range(2)]
    rows = spark.range(0, n, 1, 4).select(array_to_vector(F.array(x[0], x[1], (F.col("id") % 3).cast("double"))).alias("features"),
                                          F.when(x[0] > 0.5, 8.0).otherwise(2.0).alias("signal"), x[1].alias("noise"))
    return rows.select("features", (F.col("signal") + F.col("noise")).alias("label"))


def test_bin_numbers_are_the_cuts_below_in_generated_code(spark):
    nan, inf = float("nan"), float("inf")
    cuts = [[-inf, -1.0, 0.0, 0.5, 2.0, inf], None, [], [1.0], [float(i) for i in range(255)]]
    values = [-inf, -2.0, -1.0, -0.0, 0.0, 0.25, 0.5, 0.7, 2.0, 3.0, 254.5, inf, nan, None]
    df = spark.createDataFrame([([v] * len(cuts),) for v in values], "v array<double>").coalesce(1)
    found = df.select(models.Bins(cuts).numbers(F.col("v")).alias("x"))
    # NaN is above all numbers, a null above none
    below = lambda v, c: 0.0 if v is None else float(len(c)) if v != v else float(sum(y < v for y in c))
    assert [repr(r.x) for r in found.collect()] == [repr([v if c is None else below(v, c) for c in cuts]) for v in values]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_compared_tree_fits_share_one_making_of_their_blocks(spark, monkeypatch):
    rows, calls, plain = _feature_rows(spark), [], models.row_blocks

    def counted(train, held_out=None, blocks=500, bins=32):
        calls.append(bins)
        return plain(train, held_out, blocks, bins)

    monkeypatch.setattr(models, "row_blocks", counted)
    kw = {"forest": {"num_trees": 5, "max_depth": 4}, "gbt": {"max_iter": 3, "max_depth": 3}}
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    for cached in (True, False):
        calls.clear()
        table, fitted = models.compare_models(spark, rows, rows, **kw, cached=cached)
        assert calls == [32] and table.where("train_seconds > 0 AND rmse < 2").count() == 3
        assert all(isinstance(fitted[name], models.BinnedTrees) for name in ("Random Forest", "Gradient Boosted Trees"))
    # other bins are other blocks; they are not kept after the fits
    calls.clear()
    models.compare_models(spark, rows, rows, forest={**kw["forest"], "max_bins": 16}, gbt=kw["gbt"])
    assert calls == [16, 32] and len(spark.sparkContext._jsc.getPersistentRDDs()) == kept


def test_mean_tables_draw_once_and_keep_every_row(spark):
    """Passes after the first read no join and no draw; labels and features are those of the rows."""
    delays = SI.delays(spark, SF001)
    keys = ["trip_id", "stop_sequence", "stop_id"]
    train, test, names = features.model_tables(delays, category_mode="mean", keep=tuple(keys))
    plan = train._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "lineitem" not in plan
    p = features.prepare(delays)
    from tablework.operators.sampling import split_column
    p = p.withColumn("split", split_column(keys, (0.8, 0.2), 42))
    p = features.fit_means(p.where("split = 0"), keys).transform(p, F.col("split") == 0)
    wanted = features.assemble(p, names).select("features", F.col("delay_minutes").alias("label"), "split", *keys)
    from pyspark.ml.functions import vector_to_array

    def plainly(df):
        return sorted((*[r[k] for k in keys], r["label"], *[round(x, 9) for x in r["x"]]) for r in df.withColumn("x", vector_to_array("features")).collect())

    for i, found in enumerate((train, test)):
        assert plainly(found) == plainly(wanted.where(F.col("split") == i))
