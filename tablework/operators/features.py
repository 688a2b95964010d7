"""Feature operators (L1-L4): time features, category indexing, assembly.

Everything is a DataFrame transform; the only values that reach the driver
are the number of categories per column and vector metadata.  (The MLlib
pipeline of ``feature_stages`` also brings its label lists there.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.draws import unit_draw
from tablework.functions.scalars import feed_hour, peak_flag, service_days
from tablework.operators.numbering import numbered
from tablework.session import shared_scratch
from tablework.sources.schemas import WEEKDAYS

# The reference's candidate features, in its order.
CANDIDATE_FEATURES = ["arrival_hour_mod", "is_peak", "stop_sequence", "num_service_days",
                      "route_id_idx", "agency_id_idx", "is_disrupted"]
CATEGORY_COLUMNS = ["route_id", "agency_id"]


def present_columns(df: DataFrame, wanted) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def add_time_features(df: DataFrame, time_col: str = "arrival_time",
                      day_cols=WEEKDAYS) -> DataFrame:
    """``arrival_hour``, ``arrival_hour_mod``, ``is_peak`` and, when
    weekday flags are present, ``num_service_days`` (null if any is null)."""
    out = df.withColumn("arrival_hour", feed_hour(time_col))
    out = out.withColumn("arrival_hour_mod", F.col("arrival_hour") % F.lit(24))
    extra = {"is_peak": peak_flag("arrival_hour_mod")}
    days = present_columns(df, day_cols)
    if days:
        extra["num_service_days"] = service_days(days)
    return out.withColumns(extra)


@dataclass
class CategoryIndex:
    """L1: fitted category indexes: a written table (column, value, idx) and
    the number of values per column."""

    values: DataFrame
    sizes: dict[str, int]

    def transform(self, df: DataFrame) -> DataFrame:
        """df and ``<col>_idx`` per column: the value's index; null and unseen
        values get the last one.  The index columns are nominal (their vector
        attribute names the number of values, not the values).  The table of
        values is joined by value: Spark broadcasts it while its written size
        is within its threshold, and may split a hot value otherwise."""
        out = df
        for c, n in self.sizes.items():
            part = self.values.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("idx").alias("__idx"))
            meta = {"ml_attr": {"type": "nominal", "name": f"{c}_idx", "num_vals": n + 1}}
            idx = F.coalesce("__idx", F.lit(n)).cast("double")
            out = (out.join(part, F.col(f"`{c}`").cast("string") == F.col("__value"), "left")
                   .withColumn(f"{c}_idx", idx).drop("__value", "__idx").withMetadata(f"{c}_idx", meta))
        return out

    @property
    def output_columns(self) -> list[str]:
        return [f"{c}_idx" for c in self.sizes]


def fit_index(df: DataFrame, cols=CATEGORY_COLUMNS) -> CategoryIndex:
    """L1: the values of each column numbered from the most frequent one,
    ties by value.  All columns are counted in one aggregate (combined before
    the shuffle) and numbered by ranges of (column, count, value), so neither
    the driver nor one task holds a column's values."""
    cols = present_columns(df, cols)
    spark = df.sparkSession
    if not cols:
        return CategoryIndex(spark.createDataFrame([], "column string, value string, idx long"), {})
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    path = shared_scratch(spark, "category-counts")
    counts.write.parquet(path)
    at = numbered(spark.read.parquet(path), [F.col("column"), F.col("n").desc(), F.col("value")], "at")
    firsts = at.groupBy("column").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("labels"))   # a row per column
    values = at.join(F.broadcast(firsts), "column").select("column", "value", (F.col("at") - F.col("first")).alias("idx"))
    path = shared_scratch(spark, "category-index")
    values.write.parquet(path)
    labels = {r["column"]: r["labels"] for r in firsts.collect()}
    return CategoryIndex(spark.read.parquet(path), {c: labels.get(c, 0) for c in cols})


def index_categories(df: DataFrame, cols=CATEGORY_COLUMNS,
                     fit_on: DataFrame | None = None) -> DataFrame:
    """L1: add ``<col>_idx`` for each category column, fitted on ``fit_on``
    (default: ``df`` itself)."""
    return fit_index(fit_on if fit_on is not None else df, cols).transform(df)


#: Folds of the out-of-fold means, and rows of the overall mean added to each.
FOLDS, PRIOR_ROWS = 5, 20.0


@dataclass
class MeanEncoding:
    """Categories as smoothed label means: a written table (column, value,
    n, total, fold_n, fold_total) and the overall mean."""

    means: DataFrame
    columns: list[str]
    prior: float
    fold: Column

    def transform(self, df: DataFrame, fitted_rows: Column) -> DataFrame:
        """df and ``<col>_mean`` per column.  Rows that the means were fitted
        on (``fitted_rows``) get the mean of the other folds, so no row sees
        its own label; the others get the mean of all folds.  Null and unseen
        values get the overall mean."""
        out = df.withColumns({"__own": F.coalesce(fitted_rows, F.lit(False)), "__fold": self.fold})
        for c in self.columns:
            part = (self.means.where(F.col("column") == c).drop("column")
                    .select(F.col("value").alias("__value"), *[F.col(x).alias(f"__{x}") for x in ("n", "total", "fold_n", "fold_total")]))

            def rest(all_: str, folds: str) -> Column:
                seen = F.when(F.col("__own"), F.get(folds, "__fold")).otherwise(F.lit(0))
                return F.coalesce(F.col(all_) - seen, F.lit(0))

            mean = (rest("__total", "__fold_total") + self.prior * PRIOR_ROWS) / (rest("__n", "__fold_n") + PRIOR_ROWS)
            out = (out.join(part, F.col(f"`{c}`").cast("string") == F.col("__value"), "left")
                   .withColumn(f"{c}_mean", mean).drop("__value", "__n", "__total", "__fold_n", "__fold_total"))
        return out.drop("__own", "__fold")


def fold_of(keys, seed: int = 42) -> Column:
    """The keyed fold of a row; rows with a null key are in the first."""
    return F.coalesce(F.floor(unit_draw(list(keys), seed, "fold") * FOLDS).cast("int"), F.lit(0))


def fit_means(train: DataFrame, keys, cols=CATEGORY_COLUMNS, label: str = "delay_minutes", seed: int = 42,
              fold: Column | None = None) -> MeanEncoding:
    """Label sums per category and keyed fold, all columns in one aggregate
    (combined before the shuffle, where a row is one fold's count and total).
    For categories with many values: one number per column, so trees need no
    bin per value and do not learn single labels by heart.  ``fold``: the
    column that holds :func:`fold_of`, if it was drawn before."""
    cols = present_columns(train, cols)
    fold = fold_of(keys, seed) if fold is None else fold
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    rows = (train.where(F.col(label).isNotNull()).select(F.inline(pairs), F.col(label).cast("double").alias("y"), fold.alias("f"))
            if cols else train.sparkSession.createDataFrame([], "column string, value string, y double, f int"))
    in_fold = [F.col("f") == i for i in range(FOLDS)]
    parts = rows.where(F.col("value").isNotNull()).groupBy("column", "value", "f").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    means = parts.groupBy("column", "value").agg(
        F.sum("n").alias("n"), F.sum("y").alias("total"),
        F.array(*[F.sum(F.when(x, F.col("n")).otherwise(0)) for x in in_fold]).alias("fold_n"),
        F.array(*[F.sum(F.when(x, F.col("y")).otherwise(0.0)) for x in in_fold]).alias("fold_total"))
    path = shared_scratch(train.sparkSession, "category-means")
    means.write.parquet(path)
    prior = train.agg(F.avg(label).alias("m")).first()["m"]
    return MeanEncoding(train.sparkSession.read.schema(means.schema).parquet(path), cols, float(prior or 0.0), fold)


def assemble(df: DataFrame, feature_cols, out: str = "features",
             handle_invalid: str = "skip") -> DataFrame:
    """L3: feature vector; with ``skip`` a row with any null feature is
    dropped (see :func:`skipped_rows` for how many)."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def feature_stages(category_cols=CATEGORY_COLUMNS, feature_cols=CANDIDATE_FEATURES,
                     out: str = "features") -> Pipeline:
    """L2: the indexer and the assembler as one ``Pipeline`` (fit, then
    transform), for callers that keep the fitted stages as one model."""
    return Pipeline(stages=[
        StringIndexer(inputCols=list(category_cols),
                      outputCols=[f"{c}_idx" for c in category_cols],
                      handleInvalid="keep", stringOrderType="frequencyDesc"),
        VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="skip")])


def skipped_rows(df: DataFrame, feature_cols) -> DataFrame:
    """Rows the assembler skips (any null feature), counted in one pass."""
    any_null = F.lit(False)
    for c in feature_cols:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(any_null).alias("n_skipped"))


def prepare(df: DataFrame, label: str = "delay_minutes", leaky_features: bool = True) -> DataFrame:
    """Time features, non-null label, boolean flag as int.  ``leaky_features=False``
    leaves ``is_disrupted`` out of the features (the label is drawn from
    it, so with it the fit mostly learns the flag)."""
    return labelled(add_time_features(df), label, leaky_features)


def labelled(df: DataFrame, label: str = "delay_minutes", leaky_features: bool = True) -> DataFrame:
    """The rows of :func:`prepare` with time features already there."""
    out = df.where(F.col(label).isNotNull())
    if "is_disrupted" in out.columns:
        out = out.withColumn("is_disrupted", F.col("is_disrupted").cast("int"))
    if not leaky_features and "is_disrupted" in out.columns:
        out = out.drop("is_disrupted")
    return out


def as_ordinal(df: DataFrame, cols) -> DataFrame:
    """Drop the nominal attribute of index columns: trees then split them as
    ordered numbers (frequency rank) instead of as category sets."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def indexed_features(df: DataFrame, keys=("trip_id", "stop_sequence", "stop_id"),
                     label: str = "delay_minutes", leaky_features: bool = True,
                     weights=(0.8, 0.2), seed: int = 42, index_fit: str = "train",
                     category_mode: str = "nominal",
                     keep: tuple = (), validation: float = 0.0) -> tuple[DataFrame, list[str]]:
    """Features -> hash split column -> indexer (fitted on the train split by
    default, on all rows with ``index_fit='all'`` as the reference did) ->
    assembled ``(features, label, split, *keep)`` and the feature names.

    ``category_mode="nominal"`` keeps the indexer's categories (trees then
    need ``maxBins`` >= categories, see ``models.max_bins_for``);
    ``"ordinal"`` passes every index as a frequency rank; ``"mean"`` passes
    out-of-fold label means (:func:`fit_means`), the choice for categories
    with very many values.  The choice is the caller's and never follows
    from the data.  With ``"mean"``, df is passed over once: draws and the
    columns needed are written to a scratch table.  ``validation``: share of
    the train rows, by keyed hash, that ``held_out`` marks, for fits that
    stop on them.
    """
    from tablework.operators.sampling import split_column

    if category_mode not in ("nominal", "ordinal", "mean"):
        raise ValueError(f"category_mode is 'nominal', 'ordinal' or 'mean', not {category_mode!r}")
    draws = {"split": split_column(list(keys), weights, seed)}
    if validation:
        held = F.coalesce(unit_draw(list(keys), seed, "validation") < validation, F.lit(False))
        draws["held_out"], keep = held & (F.col("split") == 0), (*keep, "held_out")
    candidates = CANDIDATE_FEATURES
    if category_mode == "mean":
        # three passes follow (sums, overall mean, means), so draws and features are worked out once
        rows = add_time_features(df).withColumns({"split": draws.pop("split"), "drawn_fold": fold_of(keys, seed)}).withColumns(draws)
        columns = [*present_columns(rows, [*CANDIDATE_FEATURES, *CATEGORY_COLUMNS]), label, "split", "drawn_fold", *keep]
        path = shared_scratch(df.sparkSession, "prepared")
        rows = rows.select(*dict.fromkeys(columns))
        rows.write.parquet(path)
        prepared = labelled(df.sparkSession.read.schema(rows.schema).parquet(path), label, leaky_features)
        fitted = (F.col("split") == 0) & ~(F.col("held_out") if validation else F.lit(False))
        prepared = fit_means(prepared.where(fitted), keys, label=label, seed=seed, fold=F.col("drawn_fold")).transform(prepared, fitted)
        candidates = [c.replace("_idx", "_mean") for c in CANDIDATE_FEATURES]
    else:
        prepared = prepare(df, label, leaky_features).withColumn("split", draws.pop("split")).withColumns(draws)
        index = fit_index(prepared.where(F.col("split") == 0) if index_fit == "train" else prepared)
        prepared = index.transform(prepared)
        if category_mode == "ordinal":
            prepared = as_ordinal(prepared, index.output_columns)
    feats = present_columns(prepared, candidates)
    out = assemble(prepared, feats).select("features", F.col(label).alias("label"), "split", *keep)
    return out, feats


def model_tables(df: DataFrame, keys=("trip_id", "stop_sequence", "stop_id"),
                 label: str = "delay_minutes", leaky_features: bool = True,
                 weights=(0.8, 0.2), seed: int = 42, index_fit: str = "train",
                 category_mode: str = "nominal",
                 keep: tuple = (), validation: float = 0.0) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, feature names) from :func:`indexed_features`; each part
    is a filter of the same deterministic split column."""
    out, feats = indexed_features(df, keys, label, leaky_features, weights, seed, index_fit,
                                  category_mode, keep, validation)
    train = out.where(F.col("split") == 0).drop("split")
    test = out.where(F.col("split") == 1).drop("split")
    return train, test, feats
