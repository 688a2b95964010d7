"""Command line over the batch stages, one subcommand per stage:

    python -m tablework ingest   --feed DIR --out DIR/schedule
    python -m tablework augment  --src DIR/schedule --out DIR/delays
    python -m tablework profile  --src DIR/delays
    python -m tablework features --src DIR/delays --out DIR/model
    python -m tablework models   --src DIR/model --metrics DIR/metrics [--train-fraction 0.25]
    python -m tablework star     --src DIR/delays --out DIR/star [--threshold 5.0] [--fraction 0.02]

Each stage reads the previous stage's Parquet table.  Reports print a
bounded preview (``show``); full results stay in DataFrames / tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _args(argv):
    ap = argparse.ArgumentParser(prog="tablework")
    sub = ap.add_subparsers(dest="stage", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--feed", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--min-rows", type=int, default=100_000)
    p = sub.add_parser("augment")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("profile")
    p.add_argument("--src", required=True)
    p.add_argument("--approx", action="store_true")
    p.add_argument("--exact-columns", default=None, metavar="A,B",
                   help="exact distinct counts for these columns, HLL for the others")
    p = sub.add_parser("features")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--no-leaky-features", action="store_true")
    p.add_argument("--category-mode", choices=["nominal", "ordinal", "mean"], default="nominal")
    p = sub.add_parser("models")
    p.add_argument("--src", required=True)
    p.add_argument("--metrics", required=True)
    p.add_argument("--train-fraction", type=float, default=1.0)
    p = sub.add_parser("star")
    p.add_argument("--src", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--threshold", type=float, default=5.0)
    p.add_argument("--fraction", type=float, default=1.0,
                   help="export a keyed hash sample (the reference used 0.02)")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None, preview: int = 20) -> dict:
    from tablework.operators import augment, groups, models, profile
    from tablework.plans import batch, reports
    from tablework.sources import gated, read_feed_folder, read_table, write_metrics

    a = _args(argv)
    spark = spark or SparkSession.builder.appName(f"tablework-{a.stage}").getOrCreate()
    out: dict = {}
    if a.stage == "ingest":
        feed = read_feed_folder(spark, a.feed)
        feed["stop_times"], gate = gated(feed["stop_times"], a.min_rows)
        sched = batch.write_schedule(feed, a.out)
        out["gate"] = gate()
        out["volume"] = groups.group_volume(sched)
    elif a.stage == "augment":
        delays = batch.write_delays(spark, read_table(spark, a.src, step="ingest"), a.out)
        out["on_time"] = augment.on_time_rate(delays)
    elif a.stage == "profile":
        d = read_table(spark, a.src, step="augment")
        out["profile"] = (profile.profile_columns_auto(d, a.exact_columns.split(",")) if a.exact_columns
                          else profile.profile_columns(d, approx=a.approx))
        out["describe"] = profile.describe_numeric(d, "delay_minutes")
        out["moments"] = profile.moments(d, "delay_minutes")
        out["outliers"] = profile.iqr_outliers(d, "delay_minutes")
        out["routes"] = groups.group_stats(d)
        out["top_routes"] = groups.topk_groups(d)
    elif a.stage == "features":
        batch.write_model_tables(spark, read_table(spark, a.src, step="augment"), a.out,
                                 leaky_features=not a.no_leaky_features, category_mode=a.category_mode,
                                 keep=augment.EVENT_KEYS)
        out["rows"] = read_table(spark, a.out).groupBy("split").count().orderBy("split")
    elif a.stage == "models":
        table = read_table(spark, a.src, step="features")
        train = table.where("split = 0").drop("split")
        test = table.where("split = 1").drop("split")
        comparison, fitted = batch.run_models(spark, train, test, a.train_fraction, keys=augment.EVENT_KEYS)
        names = models.feature_names(train)
        for name in ("Random Forest", "Gradient Boosted Trees"):
            out[f"importance: {name}"] = models.feature_importance(spark, fitted[name], names)
        write_metrics(comparison, a.metrics)
        out["comparison"] = comparison
        out["best"] = models.best_model(comparison)
    elif a.stage == "star":
        s = batch.write_star_tables(read_table(spark, a.src, step="augment"), a.out,
                                    fraction=a.fraction)
        out["over_threshold"] = reports.routes_over_threshold(spark, s, a.threshold)
        route = reports.sample_route(s).first()["route_id"]
        out["disrupted"] = reports.disrupted_events_for_route(spark, s, route, limit=10)
        out["on_time_share"] = reports.on_time_share(spark, s)
    for name, df in out.items():
        if preview:
            print(f"== {name}")
            df.show(preview, truncate=False)
    return out


if __name__ == "__main__":
    main()
