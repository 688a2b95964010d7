"""Exact quantiles without gathering values in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer (one task for a global quantile).  Here each wanted rank
is bracketed by a sketch and settled by counting:

1. one pass counts the rows and takes sketch values (``percentile_approx``)
   a little below and above each rank;
2. one counting pass finds how many rows lie below, on and between the two
   values of each bracket.  A rank that falls on a bracket's end is found;
   otherwise the open range between holds it, a few rows per ten thousand;
3. open ranges of at most ``LEAF_ROWS`` rows are read (all of them in one
   job); larger ones are bracketed again among their own rows.

Every round narrows a range by thousands, so two or three passes do for any
number of rows, however the values are spread; only comparisons are used, so
infinities and ranges beyond the largest double need no care.  The column is
kept in its own type: integers beyond 2**53 and decimals are exact.

Interpolation follows ``quantile_cont``: position p*(n-1) between the floor
and ceiling ranks.  Between a finite and an infinite value the result is the
infinite one, as for any position strictly between them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegralType

#: Rows of an open range that may be read to the driver.
LEAF_ROWS = 20_000
#: Rank error of the sketch, as a share of the rows.
SKETCH_ERROR = 1e-4


def _bracket(x, share: float):
    """Sketch values surely at or below, and at or above, this share."""
    low, high = max(0.0, share - 2 * SKETCH_ERROR), min(1.0, share + 2 * SKETCH_ERROR)
    return F.percentile_approx(x, F.array(F.lit(low), F.lit(high)), F.lit(int(1 / SKETCH_ERROR)))


def _inside(x, low, high):
    """Condition of an open range; None is no bound."""
    cond = F.lit(True)
    if low is not None:
        cond = cond & (x > F.lit(low))
    if high is not None:
        cond = cond & (x < F.lit(high))
    return cond


def _kth_values(base: DataFrame, n: int, ranks: set[int], stats: dict | None = None,
                known: dict | None = None) -> dict:
    """{rank: value} by narrowing; ``stats`` counts the passes.  ``known``:
    {rank: (low, high)} brackets for the first round, from a stored sketch."""
    x = F.col("x")
    found: dict = {}
    known = known or {}
    check = bool(known)                                       # does the sketch belong to these rows?
    open_ = [(None, None, 0, n, k) for k in sorted(ranks)]    # low, high, rows up to low, rows between, rank

    def one_pass(exprs):
        if stats is not None:
            stats["passes"] = stats.get("passes", 0) + 1
        return base.agg(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()

    while open_:
        if not known and sum(m for *_, m, _ in open_) <= LEAF_ROWS:
            some = F.lit(False)
            for low, high, *_ in open_:
                some = some | _inside(x, low, high)
            if stats is not None:
                stats["passes"] = stats.get("passes", 0) + 1
            values = sorted(r["x"] for r in base.where(some).collect())
            for low, high, below, _, k in open_:
                own = [v for v in values if (low is None or v > low) and (high is None or v < high)]
                found[k] = own[k - below]
            return found
        if known:
            ends, known = [known[k] for *_, k in open_], {}
        else:
            sketch = one_pass([_bracket(F.when(_inside(x, low, high), x), (k - below) / max(1, m - 1))
                               for low, high, below, m, k in open_])
            ends = [tuple(sketch[i]) for i in range(len(open_))]
        checked = [F.count(F.lit(1))] if check else []
        counts = one_pass([F.count_if(_inside(x, r[0], r[1]) & cond) for r, (a, b) in zip(open_, ends)
                           for cond in (x < F.lit(a), x == F.lit(a), (x > F.lit(a)) & (x < F.lit(b)), x == F.lit(b))] + checked)
        if check and counts[-1] != n:
            raise ValueError(f"the states hold {n} values, the rows {counts[-1]}")
        check, after = False, []
        for i, ((low, high, below, m, k), (a, b)) in enumerate(zip(open_, ends)):
            under, on_a, between, on_b = (counts[4 * i + j] for j in range(4))
            on_b = 0 if a == b else on_b
            at = k - below
            if at < under:
                after.append((low, a, below, under, k))
            elif at < under + on_a:
                found[k] = a
            elif at < under + on_a + between:
                after.append((a, b, below + under + on_a, between, k))
            elif at < under + on_a + between + on_b:
                found[k] = b
            else:
                upto = under + on_a + between + on_b
                after.append((b, high, below + upto, m - upto, k))
        open_ = after
    return found


def _typed(df: DataFrame, col: str):
    kind = df.select(F.col(col)).schema[0].dataType
    return F.col(col) if isinstance(kind, (IntegralType, DecimalType)) else F.col(col).cast("double")


def _between(lo, hi, share: float) -> float:
    lo, hi = float(lo), float(hi)
    if share == 0 or lo == hi:
        return lo
    if math.isinf(lo) or math.isinf(hi):
        return lo if math.isinf(lo) and not math.isinf(hi) else (hi if not math.isinf(lo) else math.nan)
    step = hi - lo
    return lo + step * share if math.isfinite(step) else lo * (1 - share) + hi * share


def wanted_ranks(probs, n: int, discrete: bool = False) -> set[int]:
    """0-based ranks that quantiles of n values need."""
    if discrete:
        return {max(int(math.ceil(p * n)) - 1, 0) for p in probs}
    return {f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}


def quantiles_from_states(df: DataFrame, states: DataFrame, col: str, probs, discrete: bool = False,
                          stats: dict | None = None) -> list:
    """``exact_quantiles`` of a table whose batches left states (see
    ``states``): the rows are counted and bracketed by the merged sketch, so
    one counting pass and the reading of the open ranges settle the ranks.
    A state that does not belong to the rows is noticed by its counts."""
    from tablework.operators.states import brackets

    n, known = brackets(states, col, lambda m: wanted_ranks(probs, m, discrete))
    if not n:
        return [None for _ in probs]
    base = _numbers(df, col)
    return _of_ranks(_kth_values(base, n, set(known), stats, known), probs, n, discrete)


def _numbers(df: DataFrame, col: str) -> DataFrame:
    """(x): the column's values in its type, without nulls and NaN."""
    base = df.select(_typed(df, col).alias("x")).where(F.col("x").isNotNull())
    if isinstance(base.schema[0].dataType, (DoubleType, FloatType)):
        base = base.where(~F.isnan("x"))
    return base


def _of_ranks(values: dict, probs, n: int, discrete: bool) -> list:
    if discrete:
        return [values[max(int(math.ceil(p * n)) - 1, 0)] for p in probs]
    at = [p * (n - 1) for p in probs]
    return [_between(values[math.floor(pos)], values[math.ceil(pos)], pos - math.floor(pos)) for pos in at]


def exact_quantiles(df: DataFrame, col: str, probs, discrete: bool = False,
                    stats: dict | None = None) -> list:
    """Exact quantiles of ``col`` (nulls and NaN ignored) for each probability;
    ``None`` for an empty column.  Default: ``quantile_cont`` (linear
    interpolation, doubles).  ``discrete=True``: ``percentile_disc`` /
    ``quantile_disc``, the value at rank ``max(ceil(p*n) - 1, 0)`` in the
    column's type.  ``stats`` (a dict) receives the number of passes."""
    base = _numbers(df, col).persist()
    try:
        n = base.count()
        if not n:
            return [None for _ in probs]
        return _of_ranks(_kth_values(base, n, wanted_ranks(probs, n, discrete), stats), probs, n, discrete)
    finally:
        base.unpersist()


def approx_quantiles(df: DataFrame, col: str, probs, rel_error: float = 0.01) -> list[float | None]:
    """Greenwald-Khanna quantiles (``approxQuantile``): one pass, rank error
    at most ``rel_error * n``; the reference's method."""
    res = df.approxQuantile(col, list(probs), rel_error)
    return res if res else [None for _ in probs]
