"""Median imputation with group fallback."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.operators.ranks import quantiles_wide, stacked_counts, wide_quantiles

#: Groups up to this many have their medians sent to every task.
BROADCAST_GROUPS = 100_000


def group_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str], approx: bool = False) -> DataFrame:
    """One row per group with the exact median of each column (one skew-safe pass)."""
    return quantiles_wide(df, cols, [0.5], by, ["median"], approx=approx)


def impute_group_median(df: DataFrame, cols: Sequence[str], by: Sequence[str], approx: bool = False) -> DataFrame:
    """``coalesce(value, group median, global median)`` for each column (a NULL group key is a group).

    One pass counts the values of each group; group medians come from these counts and global ones
    from their sums over the groups. Up to BROADCAST_GROUPS groups, which are counted first, the
    medians are broadcast and the rows are not shuffled; beyond it AQE decides and splits hot groups.
    """
    by = list(by)
    if approx:
        gm = group_medians(df, cols, by, approx)
        glob = quantiles_wide(df, cols, [0.5], [], ["global"], approx=approx)
    else:
        counts = stacked_counts(df, cols, by)
        gm = wide_quantiles(counts, cols, [0.5], by, ["median"])
        whole = counts.groupBy("_sl_column", "_sl_value").agg(F.sum("n_equal").alias("n_equal"))
        glob = wide_quantiles(whole, cols, [0.5], [], ["global"])
    few = df.select(*by).distinct().limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    l, r = df.alias("_rows"), gm.alias("_gm")
    cond = reduce(lambda a, b: a & b, [F.col(f"_rows.{g}").eqNullSafe(F.col(f"_gm.{g}")) for g in by])
    joined = l.join(F.broadcast(r) if few else r, cond, "left").select("_rows.*", *[F.col(f"_gm.{c}_median") for c in cols])
    joined = joined.crossJoin(F.broadcast(glob))  # one row
    return joined.select(
        *[F.coalesce(F.col(c), F.col(f"{c}_median"), F.col(f"{c}_global")).alias(c) if c in cols else F.col(c)
          for c in df.columns]
    )


def fill_constant(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    return df.fillna({c: value for c in cols})


def median_fill(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Exact interpolated-median fill (Spark's ``Imputer`` does not interpolate)."""
    glob = quantiles_wide(df, cols, [0.5], [], ["global"], approx=approx)
    joined = df.crossJoin(F.broadcast(glob))
    return joined.select(*[F.coalesce(F.col(c), F.col(f"{c}_global")).alias(c) if c in cols else F.col(c)
                           for c in df.columns])
