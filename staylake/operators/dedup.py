"""Deterministic de-duplication (one row per key)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_sl_rn"


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   drop_null_keys: bool = True, cluster_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per key under ``order`` (``row_number() = 1``).

    Spell NULL placement explicitly in ``order`` (``desc_nulls_last``,
    ``asc_nulls_last``). Catalyst turns the ``rn = 1`` filter into a
    per-partition group limit below the window shuffle, so only the running
    best row per key and partition crosses the network.

    ``cluster_by`` (a subset of ``keys``) hash-partitions on those columns
    instead: the window reuses that partitioning, and so does a later join or
    aggregate on the same columns (one shuffle of the data instead of two).
    """
    base = df
    if drop_null_keys:
        for k in keys:
            base = base.where(F.col(k).isNotNull())
    if cluster_by:
        base = base.repartition(*cluster_by)
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return base.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def most_complete_per_key(df: DataFrame, keys: Sequence[str], completeness: Sequence[str],
                          tie_break: Sequence[str] | None = None, cluster_by: Sequence[str] | None = None) -> DataFrame:
    """Per key keep the row with the most non-NULL ``completeness`` columns (in
    priority order); remaining ties are broken by the full row in ascending
    order (NULLs last), so the pick never depends on partitioning."""
    flags = [F.col(c).isNotNull().cast("int").desc() for c in completeness]
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in keys]
    ties = [F.col(c).asc_nulls_last() for c in rest]
    return latest_per_key(df, keys, flags + ties, cluster_by=cluster_by)


def casefold_distinct(df: DataFrame, col: str) -> DataFrame:
    """One spelling per case-insensitive value: the smallest (binary order)."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.lower(F.col(col)).alias("_sl_folded"))
        .agg(F.min(col).alias(col))
        .select(col)
    )


def dropped_by_dedup(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed by a de-duplication, as one-row counts (a report)."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return b.crossJoin(a).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
