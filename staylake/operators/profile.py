"""Distributed profiling: duplicates, missingness, summaries, distributions.

All results are small (one row per column / group / bin); the work is one or a
few aggregate passes over the data, each combined map-side before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.operators.ranks import is_value, quantiles, quantiles_wide
from staylake.operators.ranks import value_counts as counts_by_value


def _and(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    l, r = left.alias("_l"), right.alias("_r")
    cond = _and([F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys])
    other = [c for c in right.columns if c not in keys]
    return l.join(r, cond, how).select(*[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in other])


# ---------------------------------------------------------------- duplicates

def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "row_count") -> DataFrame:
    """Keys occurring more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def duplicate_conflicts(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per duplicated key: row count and the number of distinct values of each column.

    Duplicated keys are found first and the rows semi-joined to them, so the
    multi-column distinct (an Expand of the input) runs on the duplicated part
    only.
    """
    valid = df.where(_and([F.col(k).isNotNull() for k in keys]))
    dups = duplicate_keys(valid, keys).select(*keys)
    rows = valid.join(dups, list(keys), "left_semi")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        *[F.count_distinct(F.col(c)).alias(f"distinct_{c}_count") for c in cols],
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      conflict_names: Sequence[str] | None = None) -> DataFrame:
    """Long (metric, value) summary of key duplication, ordered by metric."""
    names = list(conflict_names) if conflict_names else list(cols)
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_and([F.col(k).isNotNull() for k in keys])).alias("rows_with_valid_key"),
    )
    prof = duplicate_conflicts(df, keys, cols)
    conflicts = prof.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("duplicate_count"), F.lit(0)).alias("rows_in_duplicate_keys"),
        *[F.count_if(F.col(f"distinct_{c}_count") > 1).alias(f"duplicate_keys_with_{n}_conflict")
          for c, n in zip(cols, names)],
    )
    wide = totals.crossJoin(conflicts)
    metric_cols = [c for c in wide.columns]
    wide = wide.select(*[F.col(c).cast("string").alias(c) for c in metric_cols])
    return wide.unpivot([], metric_cols, "metric", "value").orderBy("metric")


# ---------------------------------------------------------------- missingness / column quality

def missing_rate(df: DataFrame, cols: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    """Percent of NULL (and NaN for floating columns) per column, descending."""
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)
    def missing(c: str) -> Column:
        m = F.col(c).isNull()
        if dtypes[c] in ("double", "float"):
            m = m | F.isnan(F.col(c))
        return m
    wide = df.agg(*[(F.avg(missing(c).cast("double")) * F.lit(100.0)).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "missing_rate")
    if only_positive:
        long = long.where(F.col("missing_rate") > 0)
    return long.orderBy(F.col("missing_rate").desc(), F.col("column"))


def column_quality(df: DataFrame, cols: Sequence[str] | None = None, approx_distinct: bool = False) -> DataFrame:
    """dtype, non-null, missing, missing rate (percent, 2 dp) and distinct count per column.

    Exact distinct counts over many columns make Spark expand every row once
    per column; ``approx_distinct=True`` switches to HyperLogLog++ sketches
    (bounded memory, one pass) for wide or huge tables.
    """
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)
    distinct = (lambda c: F.approx_count_distinct(c)) if approx_distinct else (lambda c: F.count_distinct(c))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"nn_{i}"), distinct(c).alias(f"nd_{i}")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"nn_{i}").alias("non_null_count"), (F.col("_n") - F.col(f"nn_{i}")).alias("missing_count"),
                 F.round(F.try_divide(F.col("_n") - F.col(f"nn_{i}"), F.col("_n")) * F.lit(100.0), 2).alias("missing_rate"),
                 F.col(f"nd_{i}").alias("unique_count"))
        for i, c in enumerate(cols)
    ]
    return (wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            .orderBy(F.col("missing_rate").desc(), F.col("column")))


# ---------------------------------------------------------------- describe

def describe(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75),
             approx: bool = False) -> DataFrame:
    """pandas-style numeric describe, one row per column (sample std): one
    moments aggregate plus one stacked quantile pass for all columns."""
    names = [f"p{int(round(p * 100)):02d}" for p in percentiles]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}_count"), F.avg(x).alias(f"{c}_mean"), F.stddev_samp(x).alias(f"{c}_std"),
                 F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
    moments = df.agg(*aggs)
    q = quantiles_wide(df, cols, percentiles, [], names, approx=approx)
    wide = moments.crossJoin(q)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_count").alias("count"), F.col(f"{c}_mean").alias("mean"),
                     F.col(f"{c}_std").alias("std"), F.col(f"{c}_min").alias("min"),
                     *[F.col(f"{c}_{n}").alias(n) for n in names], F.col(f"{c}_max").alias("max")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_value(df: DataFrame, col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-NULL value per group (ties -> smallest value) and its frequency."""
    groups = list(group_cols)
    counts = df.where(F.col(col).isNotNull()).groupBy(*groups, col).agg(F.count(F.lit(1)).alias("_c"))
    pick = F.min_by(F.struct(F.col(col).alias("v"), F.col("_c").alias("c")), F.struct((-F.col("_c")).alias("nc"), F.col(col).alias("v")))
    agg = counts.groupBy(*groups).agg(pick.alias("_m")) if groups else counts.agg(pick.alias("_m"))
    return agg.select(*groups, F.col("_m.v").alias("top"), F.col("_m.c").alias("freq"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per text column.

    All four come from one value-count aggregate per column (map-side combined,
    so a hot value is one row before the shuffle): count = sum of the counts,
    unique = number of counted values, top / freq = the most frequent value
    (ties -> smallest). One scan per column and no ``count_distinct``."""
    parts = []
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
        pick = F.min_by(F.struct(F.col(c).alias("v"), F.col("_c").alias("c")),
                        F.struct((-F.col("_c")).alias("nc"), F.col(c).alias("v")))
        stats = counts.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("count"),
                           F.count(F.lit(1)).alias("unique"), pick.alias("_m"))
        parts.append(stats.select(F.lit(c).alias("column"), "count", "unique",
                                  F.col("_m.v").cast("string").alias("top"), F.col("_m.c").alias("freq")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------- grouped summaries

def grouped_summary(df: DataFrame, by: Sequence[str], value: str, approx: bool = False) -> DataFrame:
    """count / mean / exact median of ``value`` per group, ordered by median desc."""
    by = list(by)
    base = df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"), F.avg(F.col(value).cast("double")).alias("mean"))
    med = quantiles(df, value, [0.5], by, ["median"], approx=approx)
    return _null_safe_join(base, med, by).orderBy(F.col("median").desc_nulls_last(), *[F.col(b).asc_nulls_last() for b in by])


def value_counts(df: DataFrame, col: str, labels: Sequence | None = None, dropna: bool = True) -> DataFrame:
    """Absolute and normalised counts; with ``labels`` every label appears in that order (missing -> 0)."""
    base = df.where(F.col(col).isNotNull()) if dropna else df
    counts = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    shared = counts.crossJoin(F.broadcast(total)).select(col, "count", (F.col("count") / F.col("_total")).alias("share"))
    if labels is None:
        return shared.orderBy(F.col("count").desc(), F.col(col).asc_nulls_last())
    spark = df.sparkSession
    label_df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], f"_order int, {col} {dict(df.dtypes)[col]}")
    # the label list is a driver-supplied constant; its size is known
    out = F.broadcast(label_df).join(shared, col, "left")
    return out.select(col, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
                      F.coalesce("share", F.lit(0.0)).alias("share"), "_order").orderBy("_order").drop("_order")


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """value / sum(value) over the whole frame via a one-row broadcast total."""
    total = df.agg(F.sum(value).alias("_sl_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(name, F.col(value) / F.col("_sl_total")).drop("_sl_total")


def cut(c: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None,
        include_lowest: bool = True) -> Column:
    """Right-closed bins ``(e_i, e_{i+1}]`` (pandas ``cut``); the first bin
    includes its left edge when ``include_lowest``. Outside -> NULL."""
    x = F.col(c) if isinstance(c, str) else c
    labels = list(labels) if labels else [f"({edges[i]}, {edges[i + 1]}]" for i in range(len(edges) - 1)]
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr.otherwise(F.lit(None).cast("string"))


def pivot_wide(df: DataFrame, row: Sequence[str], col: str, value: str, values: Sequence) -> DataFrame:
    """Long -> wide with a fixed value list (no extra pass to discover values)."""
    return df.groupBy(*row).pivot(col, list(values)).agg(F.first(value))


def crosstab_normalized(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Share of each listed value in ALL rows of the row group; values not listed count in the
    denominator only, a missing combination is 0."""
    shares = [(F.count_if(F.col(col).eqNullSafe(F.lit(v))) / F.count(F.lit(1))).alias(str(v)) for v in values]
    return df.groupBy(row).agg(*shares)


def mode_share(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Per group: the most frequent value (ties -> smallest) and its share of the group's rows."""
    by = list(by)
    top = top_value(df, col, by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    j = _null_safe_join(sizes, top, by, "left")
    return j.select(*by, F.col("top").alias("mode"), (F.coalesce(F.col("freq"), F.lit(0)) / F.col("_n")).alias("mode_share"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max of the finite values (last bin closed), every bin listed."""
    x = F.col(col).cast("double")
    df = df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counted = (df.where(x.isNotNull()).select(x.alias(col)).crossJoin(F.broadcast(rng))
               .select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(rng))
    return (all_bins.join(counted, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .orderBy("bin"))


def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Five numbers with 1.5 IQR fences: q1, median, q3, whiskers (most extreme
    points inside the fences), outlier count, per group. NaN and NULL are no values."""
    by = list(by)
    q = quantiles(df, value, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"], approx=approx)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr"))
    # whiskers and outliers come from the distinct values and their counts, not from the rows
    counts = counts_by_value(df.select(*by, F.col(value).cast("double").alias(value)), value, by).where(is_value(F.col(value)))
    counts = _null_safe_join(counts, q, by) if by else counts.crossJoin(F.broadcast(q))  # q is one row without groups
    inside = (F.col(value) >= F.col("lower_fence")) & (F.col(value) <= F.col("upper_fence"))
    agg = counts.groupBy(*by).agg(
        F.sum("n_equal").alias("count"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n_equal"))).alias("outliers"),
    )
    if not by:  # an empty table still has counts
        agg = agg.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("count", "outliers")})
    if by:
        return _null_safe_join(q, agg, by)
    return q.crossJoin(agg)


def co_missing(df: DataFrame, a: Column, b: Column, names: Sequence[str] = ("a", "b")) -> DataFrame:
    """2x2 counts of two boolean conditions (e.g. NULL rating x zero reviews)."""
    na, nb = names
    return df.agg(
        F.count_if(a & b).alias(f"{na}_and_{nb}"),
        F.count_if(a & ~b).alias(f"{na}_only"),
        F.count_if(~a & b).alias(f"{nb}_only"),
        F.count_if(~a & ~b).alias("neither"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (union of one-row aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
