"""Delay augmentation columns (A1-A8) built on keyed hash draws.

All draws are pure functions of (seed, key), so the columns are the same on
any partition layout and a recomputed partition reproduces them exactly.
No join and no shuffle: the per-route probability is a hash of the route
key, not a ``distinct`` + join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.draws import (choice_by, exponential_by, flag_by,
                                       mixture, normal_by, uniform_by)
from tablework.functions.scalars import clip, pct

# Fixed values of the reference's delay model.
# Disruption labels, in the reference's order:
DISRUPTION_REASONS = [
    "Traffic congestion",
    "Road closure",
    "Vehicle breakdown",
    "Staff shortage",
    "Weather conditions",
    "Diversion in operation",
    "Signal fault",
]
ON_TIME_P_RANGE = (0.755, 0.845)   # per-route on-time probability
ON_TIME_NORMAL = (1.5, 1.3)        # mean, sd of an on-time delay (minutes)
ON_TIME_CLIP = (-1.0, 5.99)        # on-time band
DISRUPTED_SHIFT_SCALE = (6.0, 8.0)  # 6 + Exp(scale 8) minutes
ROUTE_SEED = 42
EVENT_SEED = 7

EVENT_KEYS = ("trip_id", "stop_sequence", "stop_id")


def add_group_uniform(df: DataFrame, key="route_id", seed: int = ROUTE_SEED,
                      low: float = ON_TIME_P_RANGE[0], high: float = ON_TIME_P_RANGE[1],
                      out: str = "p_on_time") -> DataFrame:
    """A1: one uniform value per key in [low, high)."""
    return df.withColumn(out, uniform_by(key, seed, low, high))


def add_delay(df: DataFrame, keys=EVENT_KEYS, seed: int = EVENT_SEED,
              p_col: str = "p_on_time", reasons=DISRUPTION_REASONS) -> DataFrame:
    """``is_disrupted``, ``delay_minutes`` (2 digits) and
    ``disruption_reason`` (null unless disrupted).

    Draw streams: flag ``seed``, normal ``seed+1``/``seed+2``, exponential
    ``seed+3``, reason ``seed+4``.
    """
    keys = list(keys)
    mu, sigma = ON_TIME_NORMAL
    lo, hi = ON_TIME_CLIP
    shift, scale = DISRUPTED_SHIFT_SCALE
    flagged = df.withColumn("is_disrupted", flag_by(keys, seed, F.col(p_col)))
    on_time = clip(normal_by(keys, seed + 1, mu, sigma), lo, hi)
    disrupted = exponential_by(keys, seed + 3, shift, scale)
    return flagged.withColumns({
        "delay_minutes": F.round(mixture("is_disrupted", disrupted, on_time), 2),
        "disruption_reason": F.when(F.col("is_disrupted"), choice_by(keys, seed + 4, reasons)),
    })


def augment_delays(df: DataFrame, route_key: str = "route_id", keys=EVENT_KEYS,
                   route_seed: int = ROUTE_SEED, seed: int = EVENT_SEED) -> DataFrame:
    """A1-A7 together; output keeps the route key first (as the reference's
    join put it) followed by the input columns and the four new ones."""
    out = add_delay(add_group_uniform(df, route_key, route_seed), keys, seed)
    rest = [c for c in out.columns if c != route_key]
    return out.select(route_key, *rest)


def on_time_rate(df: DataFrame, flag: str = "is_disrupted", target_pct: float = 80.0,
                 tolerance_pct: float = 5.0) -> DataFrame:
    """Share of rows whose flag is false, in one aggregate, with the
    calibration check against the target.  Null flags count as not on time
    (the reference's ``filter(~flag)`` drops them from the numerator)."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(~F.col(flag)).alias("n_on_time"))
    share = pct("n_on_time", "n_rows", 4)
    return agg.select("n_rows", "n_on_time", share.alias("pct_on_time"),
                      F.lit(float(target_pct)).alias("target_pct"),
                      (F.abs(share - F.lit(float(target_pct))) <= F.lit(float(tolerance_pct)))
                      .alias("within_tolerance"))
