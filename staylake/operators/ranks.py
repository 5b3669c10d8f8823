"""Skew-safe exact ranks and quantiles.

Spark's exact ``percentile`` / ``median`` aggregate keeps a value -> count map
per group and merges it in one task, so a group holding a third of all rows
becomes one huge task; an un-partitioned window moves every row into one task.
This module computes exact order statistics without either, from
``groupBy(group, value).count()`` (map-side combined: a hot *value* is one row
before any shuffle).

Quantiles refine a histogram. Values map to buckets by a function that never
decreases, so bucket counts alone tell which bucket holds a wanted position;
that bucket is cut again between its own smallest and largest value, and only
the values of the piece that holds the position are put in order. The counts
are shuffled once and read again for each step; nothing runs while the query is
built, and no step orders a whole group.

Ranks of *all* values (``positions_from_counts``) range-partition the counts:
sampled range bounds split a hot group across many tasks, the partition id is
fixed as data by a checkpoint (two reads of sampled bounds could disagree), and
per-(partition, group) totals, at most ``P + G`` rows, offset the running counts.

Positions are one row per distinct ``(group, value)`` with the number of rows
strictly below it (``n_below``), its multiplicity (``n_equal``) and the group
size (``n_group``). NaN is no value: it is left out, like NULL.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.session import cut_lineage

_PID = "_sl_pid"
#: Buckets per unit of ln(1 + |value| * FINEST) (at most 93,000 for all doubles), and pieces that a bucket is cut into.
PER_UNIT, FINEST, PIECES = 64, float(1 << 20), 1024


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds)


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def value_counts(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct (group..., value), NULL values included (map-side combined)."""
    groups = list(group_cols)
    return df.select(*groups, value).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n_equal"))


def positions_from_counts(counts: DataFrame, value: str, group_cols: Sequence[str] = (),
                          num_partitions: int | None = None) -> DataFrame:
    """n_below / n_group for each distinct non-NULL (group..., value) of a counts table."""
    groups = list(group_cols)
    counts = counts.where(is_value(F.col(value)) if dict(counts.dtypes)[value] in ("double", "float") else F.col(value).isNotNull())
    ranged = counts.repartitionByRange(_partitions(counts, num_partitions), *groups, value).withColumn(
        _PID, F.spark_partition_id()
    )
    # The range bounds come from sampling, and the running counts and the
    # per-partition totals read this frame twice. Without a single
    # materialisation the two reads may sample different bounds, so the
    # partition id is fixed as data by a reliable checkpoint in the shared
    # checkpoint folder (it also survives executor loss).
    ranged = cut_lineage(ranged)
    before = Window.partitionBy(_PID, *groups).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local_below", F.coalesce(F.sum("n_equal").over(before), F.lit(0)))
    totals = ranged.groupBy(_PID, *groups).agg(F.sum("n_equal").alias("_part_total"))
    earlier = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        _PID,
        *groups,
        F.coalesce(F.sum("_part_total").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_part_total").over(whole).alias("n_group"),
    )
    l, r = local.alias("l"), offsets.alias("r")
    cond = (F.col(f"l.{_PID}") == F.col(f"r.{_PID}"))
    for g in groups:
        cond = cond & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    return l.join(r, cond, "inner").select(
        *[F.col(f"l.{g}").alias(g) for g in groups],
        F.col(f"l.{value}").alias(value),
        (F.col("l._local_below") + F.col("r._offset")).cast("bigint").alias("n_below"),
        F.col("l.n_equal").cast("bigint").alias("n_equal"),
        F.col("r.n_group").cast("bigint").alias("n_group"),
    )


def value_positions(df: DataFrame, value: str, group_cols: Sequence[str] = (),
                    num_partitions: int | None = None) -> DataFrame:
    """Distinct (group..., value) with n_below, n_equal, n_group. NULL values are skipped."""
    return positions_from_counts(value_counts(df, value, group_cols), value, group_cols, num_partitions)


def average_rank(positions: DataFrame, name: str = "avg_rank") -> DataFrame:
    """1-based average rank of each distinct value (ties share the mean rank)."""
    return positions.withColumn(name, F.col("n_below") + (F.col("n_equal") + F.lit(1)) / F.lit(2.0))


def with_average_rank(df: DataFrame, value: str, group_cols: Sequence[str] = (), name: str = "avg_rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Attach the within-group average rank of ``value`` to every row (NULL value -> NULL rank)."""
    groups = list(group_cols)
    ranks = average_rank(value_positions(df, value, groups, num_partitions), name).select(*groups, value, name)
    l, r = df.alias("_rows"), ranks.alias("_ranks")
    cond = F.col(f"_rows.{value}") == F.col(f"_ranks.{value}")
    for g in groups:
        cond = cond & F.col(f"_rows.{g}").eqNullSafe(F.col(f"_ranks.{g}"))
    return l.join(r, cond, "left").select("_rows.*", F.col(f"_ranks.{name}"))


def is_value(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def bucket_of(v: Column) -> Column:
    """A whole number that never decreases from a smaller double to a larger one (log1p is semi-monotonic)."""
    return (F.signum(v) * F.floor(F.log1p(F.abs(v) * F.lit(FINEST)) * F.lit(float(PER_UNIT)))).cast("double")


def _piece_of(v: Column, low: Column, high: Column) -> Column:
    width = high - low
    return F.when((width > 0) & (width < float("inf")), F.floor((v - low) / width * F.lit(float(PIECES)))).otherwise(F.lit(0)).cast("long")


def values_at(counts: DataFrame, value: str, groups: Sequence[str], probs: Sequence[float], few_groups: bool = False) -> DataFrame:
    """Positions (group..., value, n_below, n_equal, n_group) of the values that quantiles ``probs`` need.

    ``few_groups``: the caller knows a bound on the number of groups, so the tables of wanted
    buckets (at most two a quantile and group) may be broadcast; otherwise AQE decides.
    """
    keys = [f"_g{i}" for i in range(len(groups))]
    v = F.col(value).cast("double")
    c = counts.where(is_value(v)).select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], v.alias("_v"), F.col("n_equal").alias("_n"))
    c = c.withColumn("_b", bucket_of(F.col("_v")))

    def wanted(below: Column, here: Column, n: Column) -> Column:
        hits = F.lit(False)
        for p in probs:
            h = (n - 1) * F.lit(float(p))
            for at in (F.floor(h), F.ceil(h)):
                hits = hits | ((below <= at) & (at < below + here))
        return hits

    def meet(rows: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
        table = table.select(*[F.col(k).alias(f"_t{k}") if k in on else F.col(k) for k in table.columns])
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t{k}")) for k in on])
        return rows.join(F.broadcast(table) if few_groups else table, cond).drop(*[f"_t{k}" for k in on])

    up_to = lambda part, order: Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda part, order: F.coalesce(F.sum("_n").over(up_to(part, order)), F.lit(0))
    buckets = c.groupBy(*keys, "_b").agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    buckets = buckets.withColumn("_below", before(keys, "_b")).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    buckets = buckets.where(wanted(F.col("_below"), F.col("_n"), F.col("_all"))).drop("_n")
    inside = meet(c, buckets, [*keys, "_b"]).withColumn("_p", _piece_of(F.col("_v"), F.col("_low"), F.col("_high")))
    pieces = inside.groupBy(*keys, "_b", "_p").agg(F.sum("_n").alias("_n"), F.first("_below").alias("_below"), F.first("_all").alias("_all"))
    pieces = pieces.withColumn("_from", F.col("_below") + before([*keys, "_b"], "_p"))
    pieces = pieces.where(wanted(F.col("_from"), F.col("_n"), F.col("_all"))).select(*keys, "_b", "_p", "_from")
    last = meet(inside, pieces, [*keys, "_b", "_p"]).withColumn("n_below", F.col("_from") + before([*keys, "_b", "_p"], "_v"))
    return last.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], F.col("_v").alias(value), F.col("n_below").cast("bigint").alias("n_below"),
                       F.col("_n").cast("bigint").alias("n_equal"), F.col("_all").cast("bigint").alias("n_group"))


def quantiles_from_counts(counts: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str], names: Sequence[str],
                          few_groups: bool = False) -> DataFrame:
    """Exact interpolated quantiles of a (group..., value, n_equal) counts table."""
    groups = list(group_cols)
    pos = values_at(counts, value, groups, probs, few_groups or not groups)
    n1, v, aggs = F.col("n_group") - F.lit(1), F.col(value), []
    for p, n in zip(probs, names):
        h = n1 * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        holds = lambda at: (F.col("n_below") <= at) & (at < F.col("n_below") + F.col("n_equal"))
        aggs += [F.max(F.when(holds(lo), v)).alias(f"_{n}_lo"), F.max(F.when(holds(hi), v)).alias(f"_{n}_hi"), F.max(h - lo).alias(f"_{n}_frac")]
    if groups:
        # groups without a value still appear (with NULL quantiles)
        c = F.col(value).cast("double")
        empty = counts.where(~F.coalesce(is_value(c), F.lit(False))).select(
            *groups, F.lit(None).cast("double").alias(value), *[F.lit(None).cast("bigint").alias(x) for x in ("n_below", "n_equal", "n_group")])
        agg = pos.unionByName(empty).groupBy(*groups).agg(*aggs)
    else:
        agg = pos.agg(*aggs)
    out = [F.col(g) for g in groups]
    for n in names:
        lo_v, hi_v, frac = F.col(f"_{n}_lo"), F.col(f"_{n}_hi"), F.col(f"_{n}_frac")
        out.append(F.when((frac == 0) | (lo_v == hi_v), lo_v).otherwise(lo_v + frac * (hi_v - lo_v)).alias(n))
    return agg.select(*out)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str] = (),
              names: Sequence[str] | None = None, num_partitions: int | None = None,
              approx: bool = False, accuracy: int = 10000, few_groups: bool = False) -> DataFrame:
    """Exact linearly interpolated quantiles (pandas / numpy 'linear') per group.

    Position ``h = (n - 1) p`` (0-based); result ``v[floor h] + (h - floor h)
    (v[ceil h] - v[floor h])``. NaN and NULL are no values; groups without a
    value give NULL (kept as a group only if they had rows). ``approx=True``
    uses the bounded ``percentile_approx`` sketch instead. ``num_partitions``
    has no effect any more: nothing is range-partitioned.
    """
    groups = list(group_cols)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    if approx:
        aggs = [F.percentile_approx(F.col(value).cast("double"), float(p), accuracy).alias(n)
                for p, n in zip(probs, names)]
        return df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)
    return quantiles_from_counts(value_counts(df, value, groups), value, probs, groups, names, few_groups)


def median(df: DataFrame, value: str, group_cols: Sequence[str] = (), name: str = "median",
           approx: bool = False) -> DataFrame:
    return quantiles(df, value, [0.5], group_cols, [name], approx=approx)


def quantiles_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                   names: Sequence[str] | None = None, approx: bool = False,
                   num_partitions: int | None = None) -> DataFrame:
    """Quantiles of several columns in ONE pass: the columns are unpivoted and
    the column name becomes one more group key. Output columns ``{col}_{name}``."""
    groups = list(group_cols)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    if approx:
        aggs = [F.percentile_approx(F.col(c).cast("double"), float(p), 10000).alias(f"{c}_{n}")
                for c in cols for p, n in zip(probs, names)]
        return df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)
    return wide_quantiles(stacked_counts(df, cols, groups), cols, probs, groups, names)


def stacked_counts(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Value counts of several columns in one pass: group..., _sl_column, _sl_value, n_equal."""
    groups = list(group_cols)
    stacked = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in cols]) \
                .unpivot(groups, list(cols), "_sl_column", "_sl_value")
    return value_counts(stacked, "_sl_value", groups + ["_sl_column"])


def wide_quantiles(counts: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str],
                   names: Sequence[str]) -> DataFrame:
    """One row per group of ``stacked_counts``, columns ``{col}_{name}``."""
    groups = list(group_cols)
    # without group columns a group is a column, so their number is known
    long = quantiles_from_counts(counts, "_sl_value", probs, groups + ["_sl_column"], names, few_groups=not groups)
    pivoted = long.groupBy(*groups).pivot("_sl_column", list(cols)).agg(*[F.first(n).alias(n) for n in names])
    if len(names) == 1:
        pivoted = pivoted.select(*groups, *[F.col(f"`{c}`").alias(f"{c}_{names[0]}") for c in cols])
    return pivoted
