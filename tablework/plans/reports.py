"""Parameterised SQL reports over the star tables.

Values are bound with Spark SQL named parameter markers (``:name``), never
spliced into the text, so a value such as ``x' OR 1=1 --`` is compared as a
plain string.  Tables are passed as DataFrames (``{events}`` placeholders),
so no global temp view is registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One row per trip before any join: the events shrink to their trips, and
# only sums and counts move.
ROUTES_OVER_THRESHOLD = """
WITH of_trip AS (
  SELECT trip_id, SUM(delay_minutes) AS total, COUNT(delay_minutes) AS timed, COUNT(*) AS events
  FROM {events} GROUP BY trip_id
), of_name AS (
  SELECT r.route_short_name, SUM(o.total) / NULLIF(SUM(o.timed), 0) AS avg_delay, SUM(o.events) AS n
  FROM of_trip o JOIN {trips} t USING (trip_id) JOIN {routes} r USING (route_id)
  GROUP BY r.route_short_name
)
SELECT route_short_name, avg_delay, n FROM of_name WHERE avg_delay > :threshold
ORDER BY avg_delay DESC, route_short_name ASC LIMIT :k"""

ON_TIME_SHARE = """
SELECT 100D * COUNT_IF(delay_minutes BETWEEN :lo AND :hi) / NULLIF(COUNT(*), 0) AS pct_on_time
FROM {events}"""


def routes_over_threshold(spark: SparkSession, star: dict[str, DataFrame],
                          threshold: float = 5.0, k: int = 10) -> DataFrame:
    """Route names whose mean delay exceeds ``threshold``, top ``k``."""
    return spark.sql(ROUTES_OVER_THRESHOLD, args={"threshold": float(threshold), "k": int(k)},
                     events=star["delay_events"], trips=star["trips"], routes=star["routes"])


def disrupted_events_for_route(spark: SparkSession, star: dict[str, DataFrame],
                               route_id: str, limit: int | None = None) -> DataFrame:
    """Disrupted events of one route.  The reference shows the first 10
    in no stated order; here ``limit`` (optional) applies after ordering by
    trip, stop and delay so the rows shown are defined."""
    wanted = spark.sql("SELECT trip_id FROM {trips} WHERE route_id = :route", args={"route": str(route_id)},
                       trips=star["trips"])
    disrupted = star["delay_events"].where(F.col("is_disrupted") == 1)
    df = (disrupted.join(wanted, "trip_id", "left_semi")
          .select("trip_id", "stop_id", "delay_minutes", "disruption_reason"))
    if limit is not None:
        df = df.orderBy("trip_id", "stop_id", "delay_minutes").limit(limit)
    return df


def on_time_share(spark: SparkSession, star: dict[str, DataFrame],
                  lo: float = -1.0, hi: float = 5.99) -> DataFrame:
    """Percent of events with delay in [lo, hi] (null delays count in
    the denominator; an empty table gives null)."""
    return spark.sql(ON_TIME_SHARE, args={"lo": float(lo), "hi": float(hi)},
                     events=star["delay_events"])


def sample_route(star: dict[str, DataFrame]) -> DataFrame:
    """A route id to use as a report parameter (the smallest one)."""
    return star["routes"].agg(F.min("route_id").alias("route_id"))
