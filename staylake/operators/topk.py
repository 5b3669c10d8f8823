"""Sort / limit / arg-min-max selections bounded by k, and row numbers inside groups of any size."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.session import cut_lineage

#: (shard, group) rows up to this many are sent to every task.
BROADCAST_STARTS = 100_000


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """k rows under ``order`` (planned as TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def arg_cases(df: DataFrame, cases: dict[str, tuple[str, str]], key: str) -> DataFrame:
    """Named arg-min / arg-max picks in one aggregate: ``{name: ('min'|'max', column)}``.

    Ties are broken by the smaller key, so the pick is deterministic.
    """
    aggs = []
    for name, (how, col) in cases.items():
        if how == "min":
            aggs.append(F.min_by(F.col(key), F.struct(F.col(col), F.col(key))).alias(name))
        else:
            aggs.append(F.min_by(F.col(key), F.struct((-F.col(col)).alias("v"), F.col(key))).alias(name))
    wide = df.agg(*aggs)
    return wide.unpivot([], list(cases), "case_name", key)


def top_categories(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose ``col`` is among the k most frequent values (ties -> smaller value)."""
    top = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.col("_n").desc(), F.col(col)).limit(k).select(col))
    # at most k rows: a proven-size broadcast
    return df.join(F.broadcast(top), col, "left_semi")


def pick_one(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def champion_first(registry: DataFrame, task: str | None = None, allow_candidate: bool = False,
                   status_col: str = "status", created_col: str = "created_at") -> DataFrame:
    """Champion before candidate, newest first; a candidate only when allowed."""
    allowed = ["CHAMPION", "CANDIDATE"] if allow_candidate else ["CHAMPION"]
    r = registry.where(F.col(status_col).isin(*allowed))
    if task is not None and "model_task" in registry.columns:
        r = r.where(F.col("model_task") == task)
    prio = F.when(F.col(status_col) == "CHAMPION", 0).otherwise(1)
    return r.orderBy(prio, F.col(created_col).desc(), F.col("model_version").desc()).limit(1)


def smallest_accepted(results: DataFrame, tolerance: float = 0.01, size_col: str = "n_features",
                      rmse_col: str = "rmse", key: str | None = None) -> DataFrame:
    """Smallest feature set whose RMSE is within ``tolerance`` of the full
    (largest) set's RMSE; ties by RMSE then ``key``."""
    tie = [F.col(key)] if key else []
    full = (results.orderBy(F.col(size_col).desc(), F.col(rmse_col), *tie).limit(1)
            .select(F.col(rmse_col).alias("_full_rmse")))
    lim = F.col("_full_rmse") * F.lit(1 + tolerance)
    return (results.crossJoin(F.broadcast(full)).where(F.col(rmse_col) <= lim).drop("_full_rmse")
            .orderBy(F.col(size_col), F.col(rmse_col), *tie).limit(1))


def hash_order(key: str, seed: int = 42) -> Column:
    """Seeded, engine-portable pseudo-random order key: md5 of 'key|seed'."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def bounded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows chosen by a seeded hash of the key: stable under
    any partitioning (``sample()`` only gives an expected size). Planned as a
    per-partition top-n, so only n rows per partition reach the final merge."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


def rank_within(df: DataFrame, order: Sequence[Column], partition: Sequence[str], name: str = "rank") -> DataFrame:
    """1-based row number within each partition group under ``order`` (ties broken by ``order``'s tail).

    Rows are range-partitioned and sorted by (partition, order), so a huge group is spread over many
    shards and no task orders it as a whole. A row's number is its place in the shard, less where its
    group starts there, plus the group's rows in earlier shards; the latter two are one row for each
    shard and group. Shards are fixed by a checkpoint, as their sampled bounds may differ per read.
    """
    if not partition:
        raise ValueError("rank_within needs partition columns; rank a bounded frame with top_k instead")
    keys = [f"_sl_k{i}" for i in range(len(partition))]
    shards = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(shards, *partition, *order).sortWithinPartitions(*partition, *order)
    # monotonically_increasing_id is the shard's number times 2^33 plus the row's place in it
    ranged = cut_lineage(ranged.withColumn("_sl_at", F.monotonically_increasing_id()))
    shard = F.shiftright("_sl_at", 33)
    starts = ranged.groupBy(shard.alias("_sl_shard"), *[F.col(p).alias(k) for p, k in zip(partition, keys)]).agg(F.min("_sl_at").alias("_sl_start"), F.count(F.lit(1)).alias("_sl_n"))
    earlier = Window.partitionBy(*keys).orderBy("_sl_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_sl_before", F.coalesce(F.sum("_sl_n").over(earlier), F.lit(0))).drop("_sl_n")
    few = starts.limit(BROADCAST_STARTS + 1).count() <= BROADCAST_STARTS
    on = [shard == F.col("_sl_shard")] + [F.col(p).eqNullSafe(F.col(k)) for p, k in zip(partition, keys)]
    joined = ranged.join(F.broadcast(starts) if few else starts, reduce(lambda a, b: a & b, on))
    number = F.col("_sl_at") - F.col("_sl_start") + F.col("_sl_before") + 1
    return joined.select(*df.columns, number.cast("int").alias(name))
