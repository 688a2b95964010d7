"""Benchmark: the reference's five stages at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``; prints one JSON line.

Stages hand over by Parquet tables written to fresh folders under the
session's ``spark.checkpoint.dir`` (a new ``/tmp/run-*`` folder only when
the configuration names none).  Model fits use the reference's parameters
(linear maxIter 50; forest 50 trees depth 8; boosting 50 rounds depth 5);
the route key is folded to the reference's 1,243 routes (``o_custkey %
1243``), and routes and agencies are features as out-of-fold label means.
``gbt_stopped`` is boosting that stops on a tenth of the train rows, which
no other fit sees either.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from pyspark.sql import functions as F  # noqa: E402

from tablework.operators import augment, groups, models, profile, shapes  # noqa: E402
from tablework.plans import batch, reports, standins  # noqa: E402
from tablework.session import build_session, shared_scratch  # noqa: E402


# side-by-side reading; rows/s are derived there from ~1.15 M training rows.
ROUTES = 1243
REFERENCE = {
    "linear": {"rmse": 3.7773972715299373, "mae": 2.0056569064004335,
               "r2": 0.6372128875750052, "train_seconds": 6.503832578659058,
               "rows_per_sec": 177000, "efficiency": 0.040704},
    "forest": {"rmse": 3.7845199249656067, "mae": 2.0039006880001335,
               "r2": 0.6358434562517193, "train_seconds": 103.75980234146118,
               "rows_per_sec": 11000, "efficiency": 0.002547},
    "gbt": {"rmse": 3.798776189687527, "mae": 2.013199847932256,
            "r2": 0.6330947375824771, "train_seconds": 122.65898728370667,
            "rows_per_sec": 9000, "efficiency": 0.002146},
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = sf_dir.rsplit("sf", 1)[-1]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    # The session's spark.checkpoint.dir is used when configured; a fresh
    # local folder only when it is not.
    fallback = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/ckpt"
    spark = build_session(f"local[{cpus}]", int(cpus), "tablework-bench", extra,
                          checkpoint_if_unset=fallback)

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    feed = standins.feed(spark, sf_dir)
    sched = timed("ingest_denormalise", lambda: batch.write_schedule(
        feed, shared_scratch(spark, "schedule"), partitions=int(cpus)))
    timed("group_volume", lambda: groups.group_volume(sched).collect())
    delays = timed("augment", lambda: batch.write_delays(
        spark, sched, shared_scratch(spark, "delays")))
    timed("on_time_rate", lambda: augment.on_time_rate(delays).collect())
    timed("profile_columns", lambda: profile.profile_columns(delays).collect())
    timed("profile_columns_approx", lambda: profile.profile_columns(delays, approx=True).collect())
    timed("moments_exact_median", lambda: profile.moments(delays, "delay_minutes", "exact").collect())
    timed("iqr_outliers", lambda: profile.iqr_outliers(delays, "delay_minutes", "exact").collect())
    timed("group_stats", lambda: groups.group_stats(delays).collect())
    timed("topk_groups", lambda: groups.topk_groups(delays).collect())
    timed("histogram", lambda: shapes.histogram(delays, "delay_minutes").collect())
    timed("density_curve", lambda: shapes.density_curve(delays, "delay_minutes").collect())
    star_tables = timed("star_write", lambda: batch.write_star_tables(
        delays, shared_scratch(spark, "star")))
    timed("report_routes_over_threshold",
          lambda: reports.routes_over_threshold(spark, star_tables, 5.0, 10).collect())
    route = reports.sample_route(star_tables).first()["route_id"]
    timed("report_disrupted_for_route",
          lambda: reports.disrupted_events_for_route(spark, star_tables, route).collect())
    timed("report_on_time_share", lambda: reports.on_time_share(spark, star_tables).collect())
    folded = delays.withColumn("route_id", (F.col("route_id").cast("bigint") % ROUTES).cast("string"))
    train, test, names = timed("model_tables", lambda: batch.write_model_tables(
        spark, folded, shared_scratch(spark, "model"), category_mode="mean", validation=0.1))
    bins = models.max_bins_for(train)
    marked = models.spread(train, int(cpus)).cache()
    train = marked.where("NOT held_out").cache()
    n_train, n_marked = train.count(), marked.count()

    fits = {}
    for label, fit, kw in [("linear", models.fit_linear, {"max_iter": 50}),
                           ("forest", models.fit_forest, {"num_trees": 50, "max_depth": 8, "cache_node_ids": True}),
                           ("gbt", models.fit_gbt, {"max_iter": 50, "max_depth": 5}),
                           ("gbt_stopped", models.fit_gbt, {"max_iter": 50, "max_depth": 5, "held_out": "held_out"})]:
        tr, n = (marked, n_marked) if "held_out" in kw else (train, n_train)
        model, secs = models.timed_fit(fit, tr, **kw)
        m = timed(f"score_{label}", lambda: models.regression_metrics(model.transform(test)).first())
        times[f"fit_{label}"] = round(secs, 3)
        fits[label] = {"rmse": round(m["rmse"], 6), "mae": round(m["mae"], 6),
                       "r2": round(m["r2"], 6), "train_seconds": round(secs, 3),
                       "train_rows": n, "rows_per_sec": round(n / secs, 1),
                       "efficiency": models.efficiency(m["rmse"], secs)}
    train.unpersist()
    marked.unpersist()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_stage_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "max_bins": bins, "models": fits, "reference_models": REFERENCE}))
    spark.stop()


if __name__ == "__main__":
    main()
