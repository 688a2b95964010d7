"""Regression fits, metrics and the comparison table.

Fits are MLlib estimators (their aggregations are tree-reduced on
executors).  Metrics are one aggregate over the predictions instead of one
evaluator pass per metric.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.groups import best_row
from tablework.operators.layout import spread
from tablework.sources.schemas import METRICS


def max_bins_for(df: DataFrame, features: str = "features", floor: int = 32) -> int:
    """The smallest valid ``maxBins``: at least the largest number of
    values of a nominal feature (indexer labels plus the unknown bucket),
    read from the vector's attribute metadata."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    nominal = meta.get("attrs", {}).get("nominal", [])
    most = 0
    for a in nominal:
        most = max(most, a.get("num_vals") or len(a.get("vals", [])))
    return max(floor, most)


def fit_linear(train: DataFrame, max_iter: int = 50, **kw):
    """Linear regression (normal equations up to 4096 features)."""
    return LinearRegression(featuresCol="features", labelCol="label",
                            maxIter=max_iter, **kw).fit(train)


#: Train rows that trees are fitted on one by one.  More are fitted in blocks.
BLOCKS = 1 << 19
#: Most bins of a feature with many values (fewer if the fit's maxBins is less).
BINS = 256


@dataclass
class Bins:
    """Cut points per feature of an assembled vector; None: values as they are."""

    cuts: list[list[float] | None]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """df with the binned features replaced by their bin's number."""
        binned = array_to_vector(self.numbers(vector_to_array(features)))
        return df.withColumn(features, binned).withMetadata(features, df.schema[features].metadata)

    def numbers(self, values: Column) -> Column:
        """An array of feature values with the binned ones as their bin's
        number, the number of cuts below the value."""

        def number(x: Column, cuts: list[float], first: int = 0) -> Column:
            # halves in the expression: generated code, and few comparisons a row
            if not cuts:
                return F.lit(float(first))
            k = len(cuts) // 2
            return F.when(x > F.lit(cuts[k]), number(x, cuts[k + 1:], first + k + 1)).otherwise(number(x, cuts[:k], first))

        return F.array(*[values[i] if cuts is None else number(values[i], cuts) for i, cuts in enumerate(self.cuts)])


@dataclass
class BinnedTrees:
    """A tree model fitted on bin numbers; scores rows with the values themselves."""

    bins: Bins
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.bins.transform(df.withColumn("__features", F.col("features")))
        return self.model.transform(scored).drop("features").withColumnRenamed("__features", "features").select(
            *df.columns, self.model.getPredictionCol())

    def __getattr__(self, name: str):
        if name in ("model", "bins"):
            raise AttributeError(name)
        return getattr(self.model, name)


def row_blocks(train: DataFrame, held_out: str | None = None, blocks: int = BLOCKS,
               bins: int = 32) -> tuple[DataFrame, Bins] | None:
    """Train rows as weighted blocks for trees, or None for ``blocks`` rows
    or fewer.

    Trees only look at a feature's bin, and choose splits by the sums of
    weights and labels per bin.  So rows of one bin in every feature are one
    training row with their number as weight and their mean label: each row
    counts, and the sums are those of the rows.  A feature of fewer
    than ``bins`` values, or a nominal one, keeps its values; others get
    ``bins`` bins of like counts, from a quantile sketch of all rows.  Where there are fewer such
    groups than ``blocks``, a hash deals each group's rows to several, so a
    bootstrap still draws many small units (blocks instead of rows).  Rows
    of ``held_out`` stay single, since the error on them decides when to
    stop."""
    attrs = train.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"] for a in attrs.get("nominal", [])}
    size = train.select(F.size(vector_to_array("features")).alias("k")).first()
    if size is None:
        return None
    # the vector is unpacked once a row, in a projection of its own
    flat = train.select(vector_to_array("features").alias("raw"), F.col("label").cast("double").alias("label"), *([held_out] if held_out else []))
    fitted = ~F.col(held_out) if held_out else F.lit(True)
    x = [F.when(fitted, F.col("raw")[i]) for i in range(size["k"])]
    n, *counts = flat.agg(F.count(F.lit(1)), *[F.approx_count_distinct(v) for v in x]).first()
    if n <= blocks:
        return None
    many = [i for i in range(len(x)) if i not in nominal and counts[i] >= bins]
    cuts = Bins([None] * len(x))
    if many:
        shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
        quantiles = flat.agg(*[F.percentile_approx(x[i], shares, F.lit(40 * bins)) for i in many]).first()
        for i, q in zip(many, quantiles):
            cuts.cuts[i] = sorted(set(q or []))
    rows = flat.where(fitted).select(cuts.numbers(F.col("raw")).alias("x"), "raw", "label")
    groups = max(1, rows.agg(F.approx_count_distinct(F.xxhash64("x"))).first()[0])
    deals = max(1, blocks // groups)
    # the block number is from a hash of the row as it was
    by = [F.pmod(F.xxhash64("raw", "label"), F.lit(deals)).alias("block")] if deals > 1 else []
    out = (rows.groupBy("x", *by)
           .agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
           .select("x", "label", "weight", *([F.lit(False).alias(held_out)] if held_out else [])))
    if held_out:
        single = flat.where(F.col(held_out)).select(cuts.numbers(F.col("raw")).alias("x"), "label", F.lit(1.0).alias("weight"), held_out)
        out = out.unionAll(single)
    out = out.select(array_to_vector("x").alias("features"), *out.columns[1:])
    return out.withMetadata("features", train.schema["features"].metadata), cuts


class TreeRows:
    """The blocks of one train table, made once for all tree fits on the same
    bins and held-out rows, and kept until ``release``."""

    def __init__(self, train: DataFrame):
        self.train = train
        self.kept: dict = {}
        #: Seconds that blocks found ready had taken when they were made.
        self.spared = 0.0

    def get(self, held_out: str | None, bins: int) -> tuple[DataFrame, Bins] | None:
        """:func:`row_blocks`, written to the cache, or None for few rows."""
        of = (held_out, bins)
        if of in self.kept:
            self.spared += self.kept[of][1]
            return self.kept[of][0]
        t0 = time.perf_counter()
        found = row_blocks(self.train, held_out, bins=bins)
        if found:
            found = (spread(found[0], self.train.sparkSession.sparkContext.defaultParallelism).persist(), found[1])
            found[0].count()
        self.kept[of] = (found, time.perf_counter() - t0)
        return found

    def release(self) -> None:
        for found, _ in self.kept.values():
            if found:
                found[0].unpersist()
        self.kept.clear()


def _fit_trees(estimator, train: DataFrame, held_out: str | None = None, made: TreeRows | None = None):
    """The estimator's fit on the rows, or on their blocks if they are many
    (and have no weights of their own).  ``made``: blocks that several fits share."""
    if estimator.isDefined("weightCol"):
        return estimator.fit(train)
    rows = made or TreeRows(train)
    try:
        found = rows.get(held_out, min(BINS, estimator.getMaxBins()))
        if found is None:
            return estimator.fit(train)
        return BinnedTrees(found[1], estimator.setWeightCol("weight").fit(found[0]))
    finally:
        if made is None:
            rows.release()


def fit_forest(train: DataFrame, num_trees: int = 50, max_depth: int = 8,
               max_bins: int | None = None, seed: int = 42, cache_node_ids: bool = False,
               made: TreeRows | None = None, **kw):
    """Random forest; ``max_bins`` derived from metadata when None.

    ``cache_node_ids`` keeps each row's current node per tree in a cached
    table, checkpointed to the shared checkpoint folder, instead of walking
    every tree from the root on each level pass: the same model, ~1.5x faster
    for 50 trees of depth 8 at sf0.1.  It holds rows x trees ints in executor
    memory, so it is off unless asked for.
    """
    bins = max_bins or max_bins_for(train)
    return _fit_trees(RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees,
                                            maxDepth=max_depth, maxBins=bins, seed=seed,
                                            cacheNodeIds=cache_node_ids, **kw), train, made=made)


def fit_gbt(train: DataFrame, max_iter: int = 50, max_depth: int = 5,
            max_bins: int | None = None, seed: int = 42, held_out: str | None = None,
            made: TreeRows | None = None, **kw):
    """Gradient-boosted trees (node-id caching measured slower for
    depth-5 trees, so it is left off).  ``held_out`` names a boolean column
    of train: these rows are not fitted, and boosting stops when a round no
    longer lowers their error by ``validationTol``."""
    bins = max_bins or max_bins_for(train)
    if held_out:
        kw = {"validationIndicatorCol": held_out, **kw}
    return _fit_trees(GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter,
                                   maxDepth=max_depth, maxBins=bins, seed=seed, **kw), train, held_out, made)


def timed_fit(fit, train: DataFrame, **kw):
    """(model, wall-clock seconds of the fit)."""
    t0 = time.perf_counter()
    model = fit(train, **kw)
    return model, time.perf_counter() - t0


def regression_metrics(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, R^2 (``1 - SSE/SST``) and n in one pass.  SST uses
    the mean of the same rows via ``n*var_pop``, so no second scan."""
    e = F.col(label) - F.col(prediction)
    agg = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"),
                   F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"),
                   F.var_pop(label).alias("vy"))
    return agg.select(F.sqrt("mse").alias("rmse"), "mae",
                      (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("vy") * F.col("n")))
                      .alias("r2"), "n")


def efficiency(rmse, seconds):
    """``round((1/rmse)/seconds, 6)``; null when seconds is 0."""
    if not seconds or not rmse:
        return None
    return round((1.0 / rmse) / seconds, 6)


def comparison_row(name: str, metrics_row, seconds: float) -> tuple:
    return (name, float(metrics_row["rmse"]), float(metrics_row["mae"]),
            float(metrics_row["r2"]), float(seconds),
            efficiency(metrics_row["rmse"], seconds))


def model_comparison(spark: SparkSession, rows) -> DataFrame:
    """The comparison table (one row per fitted model)."""
    return spark.createDataFrame(list(rows), schema=METRICS)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """The names in an assembled vector's metadata, in its order (they
    are kept when the table is written and read as Parquet)."""
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


def feature_importance(spark: SparkSession, model, names) -> DataFrame:
    """Tree feature importances as (feature, importance) rows."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)],
                                 "feature string, importance double")


def best_model(table: DataFrame) -> DataFrame:
    """T5: lowest-RMSE row of the comparison table."""
    return best_row(table, "rmse")


def compare_models(spark: SparkSession, train: DataFrame, test: DataFrame,
                   forest: dict | None = None,
                   gbt: dict | None = None, linear: dict | None = None,
                   partitions: int | None = None, cached: bool = True):
    """L5-L12 end to end: fit three models, score the whole test set, return
    (comparison table, {name: model}).  Train/test are cached for the
    iterative fits and released afterwards; ``cached=False`` is for frames
    that read written tables, which are passed over a few times only (the
    trees go over their cached blocks).  Both tree fits share their blocks,
    and each one's seconds include making them."""
    train = spread(train, partitions)
    if cached:
        train, test = train.cache(), test.cache()
        train.count()  # materialise before timing, so no fit pays for the scan
    made = TreeRows(train)
    try:
        rows, fitted = [], {}
        specs = [("Linear Regression", fit_linear, linear or {}),
                 ("Random Forest", fit_forest, {"made": made, **(forest or {})}),
                 ("Gradient Boosted Trees", fit_gbt, {"made": made, **(gbt or {})})]
        for name, fit, kw in specs:
            spared = made.spared
            model, secs = timed_fit(fit, train, **kw)
            secs += made.spared - spared
            m = regression_metrics(model.transform(test)).first()
            rows.append(comparison_row(name, m, secs))
            fitted[name] = model
        return model_comparison(spark, rows), fitted
    finally:
        made.release()
        if cached:
            train.unpersist()
            test.unpersist()
