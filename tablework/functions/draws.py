"""Seeded, layout-independent random draws (A1-A7, M1-M2 building block).

``rand(seed)`` depends on how rows are spread over partitions, so the same
row gets another value after a repartition, on another cluster size or after
a retried task.  Here a draw is a pure function of (seed, key columns):

    u(purpose, seed, key) = int(first 12 hex digits of md5(purpose|seed|k1|k2...)) / 2**48

which lies in [0, 1), is the same on any layout and survives executor loss
(a recomputed partition yields the same values).  The purpose (``sample``,
``split``, ``flag``, ...) keeps draws of one seed independent of each other.  The key must identify the
row; rows that share a key share their draws.  A null key gives a null draw
(as the reference's join-based attribute would).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_48 = float(2 ** 48)


def _keys(keys) -> list[Column]:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def unit_draw(keys, seed: int, purpose: str = "draw") -> Column:
    """Uniform draw in [0, 1) keyed by ``keys``; null if any key is null."""
    ks = _keys(keys)
    text = F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), *[k.cast("string") for k in ks])
    u = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") / F.lit(TWO_POW_48)
    not_null = reduce(lambda a, b: a & b, [k.isNotNull() for k in ks])
    return F.when(not_null, u)


def uniform_by(keys, seed: int, low: float, high: float) -> Column:
    """A1: uniform in [low, high) - the same value for every row of a key."""
    return F.lit(float(low)) + unit_draw(keys, seed, "uniform") * F.lit(float(high) - float(low))


def flag_by(keys, seed: int, threshold) -> Column:
    """A2: true when the draw exceeds ``threshold`` (a column or number), so
    it is true with probability ``1 - threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return unit_draw(keys, seed, "flag") > t


def normal_by(keys, seed: int, mu: float = 0.0, sigma: float = 1.0) -> Column:
    """A3: N(mu, sigma) by Box-Muller from two draws.
    ``1-u`` lies in (0, 1], so the log is always defined."""
    u1 = unit_draw(keys, seed, "radius")
    u2 = unit_draw(keys, seed, "angle")
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)
    return F.lit(float(mu)) + z * F.lit(float(sigma))


def exponential_by(keys, seed: int, shift: float = 0.0, scale: float = 1.0) -> Column:
    """A5: ``shift + Exp(scale)`` by inverse CDF."""
    u = unit_draw(keys, seed, "exponential")
    return F.lit(float(shift)) + (-F.log(F.lit(1.0) - u)) * F.lit(float(scale))


def choice_by(keys, seed: int, labels) -> Column:
    """One of ``labels`` with equal probability."""
    idx = F.floor(unit_draw(keys, seed, "choice") * F.lit(len(labels))).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), idx + F.lit(1))


def mixture(flag, when_true, when_false) -> Column:
    """``flag ? a : b`` (a null flag takes ``b``)."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return F.when(f, when_true).otherwise(when_false)


def sample_mask(keys, seed: int, fraction: float) -> Column:
    """M1: keep-row predicate of a Bernoulli(fraction) sample."""
    return unit_draw(keys, seed, "sample") < F.lit(float(fraction))
