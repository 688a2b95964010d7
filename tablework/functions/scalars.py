"""Scalar column functions (F1-F14).  All built-in expressions: they stay in
whole-stage codegen and never call Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feed_hour(time_col) -> Column:
    """F1-F2: hour field of an ``HH:MM:SS`` feed time; 24+ stays as is.
    ``try_cast``: '' or junk gives null, ' 7' gives 7."""
    return F.split(_c(time_col), ":").getItem(0).try_cast("int")


def hour_of_day(time_col) -> Column:
    """feed hour modulo 24 (``25:10:00`` -> 1)."""
    return feed_hour(time_col) % F.lit(24)


# Peak windows of the reference, inclusive hour ranges
# (07:00-09:59 and 16:00-18:59).
PEAK_WINDOWS = ((7, 9), (16, 18))


def peak_flag(hour_col, windows=PEAK_WINDOWS) -> Column:
    """1 when the hour lies in any inclusive window, else 0 (null -> 0)."""
    h = _c(hour_col)
    cond = reduce(lambda a, b: a | b, [h.between(lo, hi) for lo, hi in windows])
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def service_days(day_cols) -> Column:
    """Number of service weekdays; any null flag gives null."""
    return reduce(lambda a, b: a + b, [_c(c).cast("int") for c in day_cols])


def clip(col, lo: float, hi: float) -> Column:
    """``greatest(lo, least(hi, x))``.  Spark's greatest/least skip
    nulls, so a null input yields ``hi`` - the reference's behaviour."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), _c(col)))


def as_int(col) -> Column:
    """Boolean or double to int (doubles truncate)."""
    return _c(col).cast("int")


def pct(num, den, digits: int = 2) -> Column:
    """``round(100 * num / den, digits)`` as double; zero or null
    denominator gives null instead of an error."""
    return F.round(F.lit(100.0) * F.try_divide(_c(num).cast("double"), _c(den)), digits)
