"""Optimal length buckets and token-budget batches.

The histogram of all lengths is small; dynamic programming over it finds the bucket boundaries
with the least padding. Inside a bucket, documents in a random but fixed order fill batches whose
padded size stays within the token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm._scratch import Scratch, small_side

#: Lengths up to 2^EXACT_BITS are boundaries of their own, longer ones in steps of 2^-EXACT_BITS of
#: their size, so the histogram has at most 2^(EXACT_BITS - 1) rows per power of two.
EXACT_BITS = 12
#: Rows of a bucket that one task numbers, once there are more than SHARDS times as many.
SHARD_ROWS = 1_000_000
SHARDS = 512


def grid_length(length: Column) -> Column:
    """The length, rounded up to the boundary grid."""
    step = F.expr(f"shiftleft(1L, greatest(0, length(bin(_length)) - {EXACT_BITS}))")
    return (F.ceil(length / step) * step).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least total padding.

    ``lengths`` ascends; counts and sums are the documents and their true tokens at each length.
    Divide and conquer over the monotone last-bucket start: O(buckets * m log m).
    """
    m = len(lengths)
    if m == 0:
        return []
    c, s = np.r_[0, np.cumsum(counts, dtype=np.int64)], np.r_[0, np.cumsum(sums, dtype=np.int64)]
    g = lengths.astype(np.int64)
    best = g * c[1:] - s[1:]  # one bucket for the first i + 1 lengths
    starts = [np.zeros(m, dtype=np.int64)]
    for _ in range(1, min(buckets, m)):
        new, start = best.copy(), np.zeros(m, dtype=np.int64)
        stack = [(0, m - 1, 0, m - 1)]
        while stack:
            lo, hi, from_, to = stack.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(max(from_, 0), min(to, j) + 1)  # the last bucket holds lengths i..j
            cost = np.where(i > 0, best[i - 1], 0) + g[j] * (c[j + 1] - c[i]) - (s[j + 1] - s[i])
            k = int(np.argmin(cost))
            new[j], start[j] = cost[k], i[k]
            stack += [(lo, j - 1, from_, int(i[k])), (j + 1, hi, int(i[k]), to)]
        starts.append(start)
        best = new
    out, j = [], m - 1
    for start in reversed(starts):
        if j < 0:
            break
        out.append(int(g[j]))
        j = int(start[j]) - 1
    return out[::-1]


def pack(docs: DataFrame, length: Column, buckets: int = 8, token_budget: int = 16_384, seed: int = 0) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, batch, slot, padding of every row.

    ``length`` is a column of ``docs`` (which needs doc_id; other columns are ignored). Batches of
    bucket b have max(1, token_budget // bucket_length) rows, so rows * bucket_length stays within
    the budget unless a single document is longer. Batches are full but for the last of a bucket.
    ``batch`` counts from 0 within its bucket, ``slot`` from 0 within its batch.

    A null length counts as 0, and documents of length 0 are packed like others. Repeated rows each
    get a slot. Ties in the order are between rows with the same id and length, so the result is
    the same on every run. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sized = docs.select("doc_id", F.coalesce(length, F.lit(0)).cast("long").alias("_length"))
    sized = scratch.write(sized.withColumn("grid", grid_length(F.col("_length"))).withColumn("order", F.xxhash64("doc_id", "_length", F.lit(seed))), "sized")
    histogram = sized.groupBy("grid").agg(F.count("*").alias("n"), F.sum("_length").alias("s")).orderBy("grid").collect()
    g, n, s = (np.array([r[k] for r in histogram], dtype=np.int64) for k in ("grid", "n", "s"))
    bounds = best_boundaries(g, n, s, buckets) or [0]
    shards = max(SHARDS, -(-int(n.sum()) // SHARD_ROWS))
    bucket = F.lit(len(bounds) - 1)
    for k in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("grid") <= bounds[k], F.lit(k)).otherwise(bucket)
    rows = sized.withColumn("bucket", bucket).withColumn("shard", F.pmod("order", F.lit(shards)).cast("int"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n")).select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("order", "doc_id", "_length")) - 1
    rows = rows.withColumn("place", place).join(small_side(offsets, shards * len(bounds)), ["bucket", "shard"])
    at = F.col("offset") + F.col("place")
    bound = F.element_at(F.array(*(F.lit(b).cast("long") for b in bounds)), F.col("bucket") + 1)
    per_batch = F.element_at(F.array(*(F.lit(max(1, token_budget // max(1, b))).cast("long") for b in bounds)), F.col("bucket") + 1)
    return rows.select("doc_id", F.col("_length").alias("n_tokens"), "bucket", bound.alias("bucket_length"), F.floor(at / per_batch).alias("batch"), (at % per_batch).cast("int").alias("slot"), (bound - F.col("_length")).alias("padding"))
