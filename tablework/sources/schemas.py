"""Declared schemas of the timetable feed and the star tables.

Ids are always strings (leading zeros and letters survive; joins compare
text).  Times are strings because feed hours may be 24 or more.
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, D, L = StringType(), IntegerType(), DoubleType(), LongType()

STOP_TIMES = _s(
    ("trip_id", S), ("arrival_time", S), ("departure_time", S), ("stop_id", S),
    ("stop_sequence", I), ("stop_headsign", S), ("pickup_type", S),
    ("drop_off_type", S), ("shape_dist_traveled", D), ("timepoint", S))

TRIPS = _s(("trip_id", S), ("route_id", S), ("service_id", S),
           ("trip_headsign", S), ("direction_id", I))

ROUTES = _s(("route_id", S), ("route_short_name", S), ("agency_id", S),
            ("route_type", I))

STOPS = _s(("stop_id", S), ("stop_name", S))

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday",
            "saturday", "sunday"]

CALENDAR = _s(("service_id", S), *[(d, I) for d in WEEKDAYS])

FEED_SCHEMAS = {"stop_times": STOP_TIMES, "trips": TRIPS, "routes": ROUTES,
                "stops": STOPS, "calendar": CALENDAR}

# Star tables: routes 1-n trips 1-n delay_events.
STAR_ROUTES = ROUTES
STAR_TRIPS = TRIPS
STAR_EVENTS = _s(("event_id", L), ("trip_id", S), ("stop_id", S),
                 ("stop_sequence", I), ("arrival_time", S),
                 ("delay_minutes", D), ("is_disrupted", I),
                 ("disruption_reason", S))

# Model comparison table.
METRICS = _s(("model", S), ("rmse", D), ("mae", D), ("r2", D),
             ("train_seconds", D), ("efficiency_score_per_sec", D))
