"""Correlation and rank statistics, computed on the cluster.

Ranks come from the skew-safe order-statistics primitive in ``ranks``; only the
final scalars (one row) reach the driver, e.g. for a p-value.
"""

from __future__ import annotations

import math
from itertools import combinations
from functools import reduce
from typing import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.operators.ranks import average_rank, is_value, positions_from_counts


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every pair (a < b in list order), one aggregate pass."""
    pairs = list(combinations(cols, 2))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("pearson"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def spearman(df: DataFrame, x: str, y: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Spearman rho, n and two-sided p-value, on rows where both values are present (NaN is none).

    Works on distinct (x, y) pairs and their counts: one positions pass ranks the distinct values of
    both columns, and the pairs are weighted by their counts, so a hot value or pair is a single row.
    Ranks are centred on their mean (n + 1) / 2, which is exact. rho is NULL if either column is
    constant; p is NULL below three rows.
    """
    groups = list(group_cols)
    keys = [f"_g{i}" for i in range(len(groups))]
    both = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    pairs = both.where(is_value(F.col("_x")) & is_value(F.col("_y"))).groupBy(*keys, "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    long = pairs.select(*keys, "_c", F.explode(F.array(F.struct(F.lit("x").alias("of"), F.col("_x").alias("v")), F.struct(F.lit("y").alias("of"), F.col("_y").alias("v")))).alias("_s"))
    counts = long.groupBy(*keys, F.col("_s.of").alias("_of"), F.col("_s.v").alias("_v")).agg(F.sum("_c").alias("n_equal"))
    ranks = average_rank(positions_from_counts(counts, "_v", [*keys, "_of"]), "_rank")
    centred = F.col("_rank") - (F.col("n_group") + 1) / F.lit(2.0)

    def attach(rows: DataFrame, of: str) -> DataFrame:
        r = ranks.where(F.col("_of") == of).select(*[F.col(k).alias(f"_r{k}") for k in keys], F.col("_v").alias("_rv"), centred.alias(f"_r{of}"))
        on = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys] + [F.col(f"_{of}") == F.col("_rv")]
        return rows.join(r, reduce(lambda a, b: a & b, on)).drop("_rv", *[f"_r{k}" for k in keys])

    ranked = attach(attach(pairs, "x"), "y")
    dot = lambda a, b: F.sum(F.col("_c") * F.col(a) * F.col(b))
    aggs = [F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n"), dot("_rx", "_ry").alias("_xy"), dot("_rx", "_rx").alias("_xx"), dot("_ry", "_ry").alias("_yy")]
    sums = ranked.groupBy(*keys).agg(*aggs) if keys else ranked.agg(*aggs)
    rho = F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx") * F.col("_yy")))
    out = sums.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.when(rho.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho))).alias("spearman"), "n")
    return out.withColumn("p_value", _tail(correlation_p)(F.col("spearman"), F.col("n").cast("double")))


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """col_a, col_b, spearman, n, p_value of every pair of columns, each on its own complete rows."""
    parts = [spearman(df, a, b).select(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), "spearman", "n", "p_value")
             for a, b in combinations(cols, 2)]
    return reduce(lambda p, q: p.unionByName(q), parts)


def _tail(f):
    """A p-value function as a column function; it runs on results of one row a group."""
    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(u, w) for u, w in zip(a, b)], dtype=float)

    return p


def correlation_p(rho: float, n: float) -> float:
    """Two-sided p of a rank correlation by Student's t with n - 2 degrees of freedom."""
    if rho is None or math.isnan(rho) or n < 3:
        return float("nan")
    if abs(rho) >= 1:
        return 0.0
    dof = n - 2
    t2 = rho * rho * dof / (1 - rho * rho)
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t2))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b) by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):  # the fraction converges fast on the other side
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    keep = lambda v: v if abs(v) > 1e-300 else 1e-300
    c, d = 1.0, 1 / keep(1 - (a + b) * x / (a + 1))
    total = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d, c = 1 / keep(1 + even * d), keep(1 + even / c)
        total *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d, c = 1 / keep(1 + odd * d), keep(1 + odd / c)
        total *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * total


def kruskal_wallis(df: DataFrame, value: str, group: str, min_group_size: int = 30) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H over groups with at least ``min_group_size`` values.

    Returns one row (h, n_groups, n, p_value); h and p (chi-square with n_groups - 1 degrees of
    freedom) are NULL with fewer than two groups and when all values are equal (no order to test).
    Rank sums per group come from distinct (group, value) counts joined to the
    global average rank of each distinct value, so the hot-value case is one row.
    """
    x = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).where(is_value(F.col("_v")))
    counted = x.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))  # everything below reads these counts, no rows
    sizes = counted.groupBy("_g").agg(F.sum("_c").alias("_ng")).where(F.col("_ng") >= min_group_size)
    gv = counted.join(sizes.select("_g"), "_g", "left_semi")
    values = gv.groupBy("_v").agg(F.sum("_c").alias("n_equal"))
    pos = average_rank(positions_from_counts(values, "_v"), "_rank")  # global ranks of distinct values
    rank_sums = gv.join(pos.select("_v", "_rank"), "_v").groupBy("_g").agg(
        F.sum(F.col("_c") * F.col("_rank")).alias("_R"), F.sum("_c").alias("_ng"))
    terms = rank_sums.agg(F.sum(F.col("_R") * F.col("_R") / F.col("_ng")).alias("_s"),
                          F.sum("_ng").alias("n"), F.count(F.lit(1)).alias("n_groups"))
    ties = pos.agg(F.sum(F.col("n_equal").cast("double") ** 3 - F.col("n_equal")).alias("_t"))
    n = F.col("n").cast("double")
    h_raw = F.lit(12.0) / (n * (n + 1)) * F.col("_s") - F.lit(3.0) * (n + 1)
    corr = F.lit(1.0) - F.try_divide(F.col("_t"), n * n * n - n)
    out = terms.crossJoin(ties).select(
        F.when(F.col("n_groups") >= 2, F.try_divide(h_raw, corr)).alias("h"), "n_groups", F.col("n").cast("bigint").alias("n"))
    p = _tail(lambda h, k: float("nan") if h is None or math.isnan(h) else chi2_sf(h, int(k) - 1))
    return out.withColumn("p_value", p(F.col("h"), F.col("n_groups").cast("double")))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution (regularised incomplete gamma), plain Python."""
    if x is None or dof <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    if z < a + 1:  # series for the lower part
        term = total = 1.0 / a
        k = a
        for _ in range(10000):
            k += 1
            term *= z / k
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        lower = total * math.exp(-z + a * math.log(z) - math.lgamma(a))
        return max(0.0, 1.0 - lower)
    # continued fraction for the upper part
    b = z + 1 - a
    c = 1e300
    d = 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h
