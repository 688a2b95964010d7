"""SQL twins of the stand-in views, for checking results with a second
engine (DuckDB) over the same Parquet tables.  Only text templates; nothing
here runs a query."""

from __future__ import annotations

import math

from tablework.operators.augment import (DISRUPTED_SHIFT_SCALE, DISRUPTION_REASONS,
                                         ON_TIME_CLIP, ON_TIME_NORMAL, ON_TIME_P_RANGE,
                                         ROUTE_SEED, EVENT_SEED)
from tablework.sources.schemas import WEEKDAYS


def d(x: float) -> str:
    """A double literal that parses exactly."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def u(purpose: str, seed: int, *keys: str) -> str:
    cast = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    h = f"CAST(('0x' || substr(md5(concat_ws('|', '{purpose}', '{seed}', {cast})), 1, 12)) AS BIGINT)"
    return f"(CASE WHEN {nn} THEN CAST({h} AS DOUBLE) / {d(2.0 ** 48)} END)"


def hash_id(*keys: str) -> str:
    cast = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {cast})), 1, 15)) AS BIGINT)"


def uniform(seed, lo, hi, *keys):
    return f"({d(lo)} + {u('uniform', seed, *keys)} * {d(float(hi) - float(lo))})"


def normal(seed, mu, sigma, *keys):
    z = (f"(sqrt({d(-2.0)} * ln({d(1.0)} - {u('radius', seed, *keys)})) * "
         f"cos({d(2 * math.pi)} * {u('angle', seed, *keys)}))")
    return f"({d(mu)} + {z} * {d(sigma)})"


def exponential(seed, shift, scale, *keys):
    return f"({d(shift)} + (-ln({d(1.0)} - {u('exponential', seed, *keys)})) * {d(scale)})"


def choice(seed, labels, *keys):
    arr = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in labels) + "]"
    return f"list_extract({arr}, CAST(floor({u('choice', seed, *keys)} * {len(labels)}) AS INTEGER) + 1)"


def clip(x, lo, hi):
    return f"greatest({d(lo)}, least({d(hi)}, {x}))"


def hhmm(hour, minute):
    return (f"lpad(CAST({hour} AS VARCHAR), 2, '0') || ':' || "
            f"lpad(CAST({minute} AS VARCHAR), 2, '0') || ':00'")


_T = hhmm("(l_orderkey + l_linenumber) % 30", "l_partkey % 60")
_DAYS = ", ".join(f"CAST((n_nationkey >> {i}) & 1 AS INTEGER) AS {day}"
                  for i, day in enumerate(WEEKDAYS))

FEED_CTES = f"""
stop_times AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, {_T} AS arrival_time,
         {_T} AS departure_time, CAST(l_partkey AS VARCHAR) AS stop_id,
         CAST(l_linenumber AS INTEGER) AS stop_sequence,
         CAST(NULL AS VARCHAR) AS stop_headsign, l_returnflag AS pickup_type,
         l_linestatus AS drop_off_type, CAST(l_quantity AS DOUBLE) AS shape_dist_traveled,
         '1' AS timepoint
  FROM lineitem),
trips AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
         CAST(o_orderkey % 30 AS VARCHAR) AS service_id, o_orderpriority AS trip_headsign,
         CAST(o_orderkey % 2 AS INTEGER) AS direction_id
  FROM orders),
routes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS route_id, c_mktsegment AS route_short_name,
         CAST(c_nationkey AS VARCHAR) AS agency_id, CAST(c_nationkey % 4 AS INTEGER) AS route_type
  FROM customer),
stops AS (SELECT CAST(p_partkey AS VARCHAR) AS stop_id, p_name AS stop_name FROM part),
calendar AS (SELECT CAST(n_nationkey AS VARCHAR) AS service_id, {_DAYS} FROM nation)"""

SCHEDULE_COLS = ["service_id", "stop_id", "route_id", "trip_id", "arrival_time",
                 "departure_time", "stop_sequence", "stop_headsign", "pickup_type",
                 "drop_off_type", "shape_dist_traveled", "timepoint", "trip_headsign",
                 "direction_id", "route_short_name", "agency_id", "route_type",
                 "stop_name", *WEEKDAYS]

_SCHED_SELECT = ", ".join(
    {"service_id": "t.service_id", "stop_id": "st.stop_id", "route_id": "t.route_id",
     "trip_id": "st.trip_id"}.get(c, c) + f" AS {c}" for c in SCHEDULE_COLS)

SCHEDULE_CTE = f"""{FEED_CTES},
schedule AS (
  SELECT {_SCHED_SELECT}
  FROM stop_times st JOIN trips t ON st.trip_id = t.trip_id
  LEFT JOIN routes r ON t.route_id = r.route_id
  LEFT JOIN stops s ON st.stop_id = s.stop_id
  LEFT JOIN calendar c ON t.service_id = c.service_id)"""

_K = ("trip_id", "stop_sequence", "stop_id")
_S = EVENT_SEED

DELAYS_CTE = f"""{SCHEDULE_CTE},
with_p AS (SELECT *, {uniform(ROUTE_SEED, *ON_TIME_P_RANGE, 'route_id')} AS p_on_time FROM schedule),
flagged AS (SELECT *, {u('flag', _S, *_K)} > p_on_time AS is_disrupted FROM with_p),
delays AS (
  SELECT route_id, {", ".join(c for c in SCHEDULE_COLS if c != "route_id")}, p_on_time, is_disrupted,
         round(CASE WHEN is_disrupted THEN {exponential(_S + 3, *DISRUPTED_SHIFT_SCALE, *_K)}
                    ELSE {clip(normal(_S + 1, *ON_TIME_NORMAL, *_K), *ON_TIME_CLIP)} END, 2)
           + CAST(0 AS DOUBLE) AS delay_minutes,
         CASE WHEN is_disrupted THEN {choice(_S + 4, DISRUPTION_REASONS, *_K)} END
           AS disruption_reason
  FROM flagged)"""

EVENTS_DELAY_CTE = """
events_delay AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS route_id, event_type,
         value AS delay_minutes, event_type = 'error' AS is_disrupted
  FROM events)"""

DELAY_COLS = ["route_id"] + [c for c in SCHEDULE_COLS if c != "route_id"] + [
    "p_on_time", "is_disrupted", "delay_minutes", "disruption_reason"]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)
