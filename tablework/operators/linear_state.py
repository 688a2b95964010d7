"""Linear regression from mergeable sums.

A batch leaves one row: the number of rows, the sums of all products of two
of (1, features, label).  Rows of batches add up, so a fit over everything
ever ingested reads no rows of the table, and what reaches the driver is one
row of (features + 2)^2 / 2 numbers, whatever the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_state(df: DataFrame, features, label: str) -> DataFrame:
    """(columns, products): the upper triangle of sums of products over (1,
    features..., label), row by row, from one aggregate (one partial row per
    task).  Rows with a null or NaN in any of them are left out, as the
    assembler skips them."""
    names = [*features, label]
    cols = [F.lit(1.0), *[F.col(f"`{c}`").cast("double") for c in names]]
    whole = F.lit(True)
    for c in cols[1:]:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    sums = [F.coalesce(F.sum(F.when(whole, a * b)), F.lit(0.0)) for i, a in enumerate(cols) for b in cols[i:]]
    return df.agg(F.array(*sums).alias("products")).select(F.array(*[F.lit(c) for c in names]).alias("columns"), "products")


def merged(states: DataFrame) -> DataFrame:
    """The states of several batches as one; batches must agree in their columns."""
    at = states.select("columns", F.posexplode("products").alias("i", "v"))
    return (at.groupBy("columns", "i").agg(F.sum("v").alias("v")).groupBy("columns")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("products")))


def solve(states: DataFrame) -> dict:
    """{intercept, coefficients, n, r2, rmse} of the least-squares fit.  With
    dependent features the coefficients of the smallest norm are taken; no
    rows give no coefficients."""
    rows = merged(states).collect()
    if len(rows) != 1:
        raise ValueError(f"states of {len(rows)} column lists")
    names, flat = rows[0]["columns"], rows[0]["products"]
    k = len(names) + 1
    full = np.zeros((k, k))
    full[np.triu_indices(k)] = flat
    full = full + np.triu(full, 1).T
    n = full[0, 0]
    if not n:
        return {"intercept": None, "coefficients": {}, "n": 0, "r2": None, "rmse": None}
    # centred and scaled: the sums of unlike columns differ by many digits
    mean = full[0, 1:] / n
    cov = full[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov), 0))
    scale[scale <= 1e-12 * np.maximum(1, np.abs(mean))] = 0
    safe = np.where(scale > 0, scale, 1)
    corr = cov / np.outer(safe, safe)
    used = scale[:-1] > 0
    beta = np.zeros(k - 2)
    beta[used] = np.linalg.lstsq(corr[:-1, :-1][np.ix_(used, used)], corr[:-1, -1][used], rcond=1e-12)[0]
    slopes = beta * safe[-1] / safe[:-1]
    left = max(0.0, cov[-1, -1] - 2 * slopes @ cov[:-1, -1] + slopes @ cov[:-1, :-1] @ slopes)
    return {"intercept": float(mean[-1] - slopes @ mean[:-1]), "n": int(round(n)),
            "coefficients": {c: float(b) for c, b in zip(names, slopes)},
            "r2": float(1 - left / cov[-1, -1]) if scale[-1] > 0 else None, "rmse": float(np.sqrt(left))}
