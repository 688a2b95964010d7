"""Denormalising joins.

The stop-event fact is the only large input.  Routes and calendar meet the
trips first, a row per trip instead of one per stop event, so the fact is
shuffled on ``trip_id`` and ``stop_id`` only; the dimensions are left joins
that Spark broadcasts when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-plans at run time from
real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def denormalise(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                stops: DataFrame, calendar: DataFrame) -> DataFrame:
    """Stop events -> trips (inner), -> routes, stops, calendar (left).

    Orphan stop events vanish; unknown route / stop / service keep the row
    with nulls; a duplicated dimension key fans out.  USING-joins keep each
    key once, in front: ``service_id, stop_id, route_id, trip_id, ...``.
    """
    of_trip = trips.join(routes, on="route_id", how="left").join(calendar, on="service_id", how="left")
    df = stop_times.join(of_trip, on="trip_id", how="inner").join(stops, on="stop_id", how="left")
    # by position, since dimensions may share the names of other columns
    of = {"st": len(stop_times.columns) - 2, "trips": len(trips.columns) - 3, "routes": len(routes.columns) - 1,
          "calendar": len(calendar.columns) - 1, "stops": len(stops.columns) - 1}
    at = {"stop_id": [0], "trip_id": [1]}
    first = 2
    for part, n in [("st", of["st"]), ("service_id", 1), ("route_id", 1), *[(k, of[k]) for k in ("trips", "routes", "calendar", "stops")]]:
        at[part], first = range(first, first + n), first + n
    order = [i for part in ("service_id", "stop_id", "route_id", "trip_id", "st", "trips", "routes", "stops", "calendar") for i in at[part]]
    names = df.columns
    return df.toDF(*[str(i) for i in range(first)]).select(*[F.col(str(i)).alias(names[i]) for i in order])


def group_attribute_table(df: DataFrame, key: str, value) -> DataFrame:
    """Distinct keys with one attribute column (``value`` is a name->Column
    pair), the table the reference builds before joining it back."""
    name, col = value
    return df.select(key).distinct().withColumn(name, col)


def attach_group_attr(df: DataFrame, attrs: DataFrame, key: str) -> DataFrame:
    """Left join a per-key attribute table; a null key gets null."""
    return df.join(attrs, on=key, how="left")
