"""Plan shapes: pruning, pushdown, no needless shuffles, reused work."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF001
from tablework.operators import augment, groups, shapes, star
from tablework.plans import batch, standins as SI
from tablework.session import shared_scratch


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _delays_table(spark):
    sched = batch.write_schedule(SI.feed(spark, SF001), shared_scratch(spark, "schedule"))
    return batch.write_delays(spark, sched, shared_scratch(spark, "delays"))


def test_column_pruning_reaches_the_scan(spark):
    d = _delays_table(spark)
    p = plan_of(groups.group_stats(d))
    assert "ReadSchema: struct<route_short_name:string,is_disrupted:boolean,delay_minutes:double>" in p


def test_lookup_filter_is_pushed_to_parquet(spark):
    s = batch.write_star_tables(_delays_table(spark), shared_scratch(spark, "star"))
    p = plan_of(s["delay_events"].where(F.col("trip_id") == "7"))
    assert "PushedFilters: [IsNotNull(trip_id), EqualTo(trip_id,7)]" in p
    ids = s["delay_events"].agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("d")).first()
    assert ids.n == ids.d  # unique surrogate ids without a global row_number


def test_augmentation_adds_no_shuffle(spark):
    d = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", F.col("user_id").cast("string").alias("route_id"))
    out = augment.add_delay(augment.add_group_uniform(d), keys=["event_id"])
    p = plan_of(out)
    assert "Exchange" not in p and "Join" not in p


def test_share_total_reuses_the_grouping_shuffle(spark):
    d = spark.read.parquet(f"{SF001}/events.parquet")
    out = groups.value_share(d, "event_type")
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_histogram_bounds_are_a_subquery_not_a_join(spark):
    d = spark.read.parquet(f"{SF001}/events.parquet")
    p = plan_of(shapes.histogram(d, "value"))
    assert "Subquery" in p and "NestedLoopJoin" not in p and "Cartesian" not in p


def test_group_reports_combine_map_side(spark):
    d = spark.read.parquet(f"{SF001}/events.parquet")
    p = plan_of(groups.group_stats(d, "event_type", "value", "event_type"))
    assert "partial_avg" in p and "partial_count" in p


def test_distinct_profile_is_not_one_wide_aggregate(spark):
    from tablework.operators import profile
    d = spark.read.parquet(f"{SF001}/lineitem.parquet")
    p = plan_of(profile.profile_columns(d))
    assert "Expand" not in p  # long form: no per-column distinct expansion
    assert "Generate" in p and "inline" in p


def test_spread_follows_the_argument_only(spark):
    from tablework.operators.layout import spread
    df = spark.range(1000).coalesce(1)
    assert spread(df, None) is df
    out = spread(df, 8)
    assert "RoundRobinPartitioning(8)" in plan_of(out) and out.count() == 1000


def test_route_report_aggregates_before_it_joins(spark):
    from tablework.plans import registry, reports
    p = plan_of(reports.routes_over_threshold(spark, registry._star(spark, SF001)))
    scan = p.index("delay_minutes")
    assert "partial_sum(delay_minutes" in p and "partial_count" in p[:p.index("partial_sum(delay_minutes") + 2000]
    assert scan >= 0
