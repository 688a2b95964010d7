"""Batch stages with Parquet hand-overs, as the reference runs them:

    feed -> schedule (denormalised) -> delays (augmented)
         -> profile / stats / outliers / route reports
         -> train / test tables -> three regressors -> comparison table
         -> star tables -> parameterised reports

Each stage reads the previous stage's table and writes its own, so a failed
stage restarts from the last written table (no long lineage is kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablework.operators import augment, features, models, star
from tablework.operators.denorm import denormalise
from tablework.operators.layout import spread
from tablework.operators.sampling import sample_hash
from tablework.session import shared_scratch
from tablework.sources.feeds import read_table, write_star, write_table


def _written(df: DataFrame, name: str) -> DataFrame:
    """df written to a fresh shared folder: dealing by ranges samples its
    input, which would otherwise work the joins or draws out twice."""
    spark = df.sparkSession
    path = shared_scratch(spark, name)
    write_table(df, path)
    return read_table(spark, path, schema=df.schema)


def write_schedule(feed: dict[str, DataFrame], path: str, partitions: int | None = None) -> DataFrame:
    """Ingest: denormalise the feed and write it range-clustered by route and
    trip, so that a route or trip lies in few files and Parquet statistics
    skip the others.  ``partitions`` deals a fact of few splits to more tasks
    before the joins.  The stop events are read once (``feeds.gated`` stop
    events are counted then)."""
    sched = _written(denormalise(spread(feed["stop_times"], partitions), feed["trips"], feed["routes"],
                                 feed["stops"], feed["calendar"]), "schedule-joined")
    write_table(star.clustered(sched, ["route_id", "trip_id"]), path)
    return read_table(sched.sparkSession, path, step="ingest")


def write_delays(spark: SparkSession, schedule: DataFrame, path: str) -> DataFrame:
    """Augment: add the delay columns (pure per-row expressions, no shuffle)."""
    write_table(augment.augment_delays(schedule), path)
    return read_table(spark, path, step="augment")


def write_model_tables(spark: SparkSession, delays: DataFrame, path: str,
                       keys=("trip_id", "stop_sequence", "stop_id"), leaky_features: bool = True,
                       index_fit: str = "train", category_mode: str = "nominal",
                       keep: tuple = (), validation: float = 0.0) -> tuple[DataFrame, DataFrame, list[str]]:
    """Features: hash split, indexer fitted on train, assembled vectors,
    written once as one table partitioned by ``split``; train and test are
    read back by partition pruning.  ``split`` has two values, so each task
    writes at most two files and no rebalance shuffle is needed."""
    out, names = features.indexed_features(delays, keys, leaky_features=leaky_features,
                                           index_fit=index_fit, category_mode=category_mode, keep=keep, validation=validation)
    write_table(out, path, partition_by=["split"], rebalance=False)
    table = read_table(spark, path, step="features")
    return (table.where("split = 0").drop("split"),
            table.where("split = 1").drop("split"), names)


def run_models(spark: SparkSession, train: DataFrame, test: DataFrame,
               train_fraction: float = 1.0, seed: int = 42, forest: dict | None = None,
               gbt: dict | None = None, linear: dict | None = None, keys: tuple = (),
               partitions: int | None = None):
    """Models: optional train sample by ``keys`` (columns that the model
    tables kept; the reference used 25 %), three fits, metrics on the whole
    test set."""
    if train_fraction < 1.0:
        if not keys:
            raise ValueError("a train sample needs the key columns (write_model_tables(keep=...))")
        train = sample_hash(train, list(keys), train_fraction, seed)
    return models.compare_models(spark, train, test, forest=forest, gbt=gbt,
                                 linear=linear, partitions=partitions)


def write_star_tables(delays: DataFrame, target: str, id_mode: str = "unique",
                      fraction: float = 1.0, seed: int = 42,
                      keys=("trip_id", "stop_sequence", "stop_id")) -> dict[str, DataFrame]:
    """Star: routes / trips / delay_events written by executors; the fact is
    range-clustered on trip so trip lookups prune by Parquet statistics.
    ``fraction < 1`` exports a keyed hash sample (the reference exported
    2 %); the dimensions are built from the same sampled rows."""
    s = star.build_star(sample_hash(delays, list(keys), fraction, seed), id_mode=id_mode)
    s["delay_events"] = star.clustered(_written(s["delay_events"], "star-events"), ["trip_id", "stop_sequence"])
    paths = write_star(s, target)
    spark = delays.sparkSession
    return {k: read_table(spark, p, step="star") for k, p in paths.items()}
