"""The driver's test tables in the roles of the timetable feed.

lineitem = stop events, orders = trips, customer = routes, part = stops,
nation = calendar.  Every column is derived by a per-row expression from the
given tables, so the work grows with them.  Derived values:

* ``arrival_time``: hour ``(l_orderkey + l_linenumber) % 30`` (hours 24-29
  occur, as in feeds past midnight), minute ``l_partkey % 60``;
* ``service_id``: ``o_orderkey % 30`` - services 25..29 have no calendar
  row, so left-join nulls and the assembler's skipped rows really occur;
* weekday flags: bits 0..6 of ``n_nationkey``;
* ``direction_id``: ``o_orderkey % 2``; ``route_type``: ``c_nationkey % 4``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.augment import augment_delays
from tablework.operators.denorm import denormalise
from tablework.session import shared_scratch
from tablework.sources.feeds import read_table, write_table
from tablework.sources.schemas import WEEKDAYS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hhmm(hour, minute):
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(minute.cast("string"), 2, "0"), F.lit(":00"))


def stop_times(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    t = _hhmm((F.col("l_orderkey") + F.col("l_linenumber")) % 30, F.col("l_partkey") % 60)
    return li.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        t.alias("arrival_time"), t.alias("departure_time"),
        F.col("l_partkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("int").alias("stop_sequence"),
        F.lit(None).cast("string").alias("stop_headsign"),
        F.col("l_returnflag").alias("pickup_type"),
        F.col("l_linestatus").alias("drop_off_type"),
        F.col("l_quantity").cast("double").alias("shape_dist_traveled"),
        F.lit("1").alias("timepoint"))


def trips(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("trip_id"),
        F.col("o_custkey").cast("string").alias("route_id"),
        (F.col("o_orderkey") % 30).cast("string").alias("service_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        (F.col("o_orderkey") % 2).cast("int").alias("direction_id"))


def routes(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("route_id"),
        F.col("c_mktsegment").alias("route_short_name"),
        F.col("c_nationkey").cast("string").alias("agency_id"),
        (F.col("c_nationkey") % 4).cast("int").alias("route_type"))


def stops(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("stop_id"),
                    F.col("p_name").alias("stop_name"))


def calendar(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("service_id"),
        *[F.shiftright(F.col("n_nationkey"), i).bitwiseAND(F.lit(1)).cast("int").alias(d)
          for i, d in enumerate(WEEKDAYS)])


def feed(spark, sf_dir) -> dict[str, DataFrame]:
    return {"stop_times": stop_times(spark, sf_dir), "trips": trips(spark, sf_dir),
            "routes": routes(spark, sf_dir), "stops": stops(spark, sf_dir),
            "calendar": calendar(spark, sf_dir)}


def schedule(spark, sf_dir) -> DataFrame:
    """The denormalised schedule (reference: joined_schedule)."""
    f = feed(spark, sf_dir)
    return denormalise(f["stop_times"], f["trips"], f["routes"], f["stops"], f["calendar"])


def delays(spark, sf_dir) -> DataFrame:
    """The schedule with delay columns (reference: trips_with_delay)."""
    return augment_delays(schedule(spark, sf_dir))


#: The delay columns that features are made of.
FEATURE_INPUTS = ["trip_id", "stop_sequence", "stop_id", "arrival_time", "route_id", "agency_id", *WEEKDAYS,
                  "is_disrupted", "delay_minutes"]


def delay_table(spark, sf_dir, *columns: str) -> DataFrame:
    """These columns of :func:`delays`, worked out once and read again from a
    written table, for queries that pass over them several times.  Otherwise
    each pass repeats the joins, and a filter on a drawn column is pushed
    below the projection with a copy of its draws per mention."""
    path = shared_scratch(spark, "delay-columns")
    write_table(delays(spark, sf_dir).select(*columns), path)
    return read_table(spark, path)


def events_delay(spark, sf_dir) -> DataFrame:
    """``events`` as delay records: value = delay, error = disrupted,
    user = route, event_id = draw key."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").cast("string").alias("route_id"),
                    "event_type", F.col("value").alias("delay_minutes"),
                    (F.col("event_type") == F.lit("error")).alias("is_disrupted"))
