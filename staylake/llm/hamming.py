"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code has SEGMENTS segments of equal width. Round s looks, in every segment, at the codes
whose segment differs from the query's in exactly s bits; after it all codes within distance
SEGMENTS * (s + 1) - 1 have been met, because one of their segments differs in s bits at most. A
query is done when its k-th verified distance is within that radius; the others go on.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS
#: The upper bits of a segment name the cell that its codes are kept in; a cell is cut into parts of about this many codes.
CELL_BITS, PART_CODES = 3, 20_000
_LOW_BITS = WIDTH - CELL_BITS


def sign_codes(vectors: DataFrame, id_name: str, vector_name: str, seed: int = 6) -> DataFrame:
    """id, code: 64 signs of fixed random projections of the whole vector (any length).

    Null and empty vectors, and vectors with a null or non-finite component, have no code and are left out.
    """

    @F.arrow_udf("long")
    def project(column: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(lengths)
        out = np.zeros(len(column), dtype=np.uint64)
        for d in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == d)
            x = flat[(ends[rows] - d)[:, None] + np.arange(d)]
            basis = np.random.Generator(np.random.PCG64([seed, d])).normal(size=(BITS, d))
            signs = np.stack([(x * b).sum(1) > 0 for b in basis], axis=1)
            out[rows] = np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()
        return pa.array(out.view(np.int64))

    v = F.col(vector_name)
    usable = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(usable).select(F.col(id_name).cast("long").alias("id"), project(v).alias("code"))


def _segment(code: Column, k: int) -> Column:
    return F.shiftrightunsigned(code, k * WIDTH).bitwiseAND((1 << WIDTH) - 1).cast("int")


def _masks(bits: int, weight: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for c in combinations(range(bits), weight)], dtype=np.int64)


def _cells(codes: DataFrame) -> DataFrame:
    """seg, cell, low, code: a row of each code for each segment."""
    seg = F.explode(F.array(*(F.struct(F.lit(k).alias("seg"), _segment(F.col("code"), k).alias("value")) for k in range(SEGMENTS))))
    s = codes.withColumn("s", seg)
    return s.select(F.col("s.seg").alias("seg"), F.shiftright(F.col("s.value"), _LOW_BITS).alias("cell"), F.col("s.value").bitwiseAND((1 << _LOW_BITS) - 1).alias("low"), *[c for c in codes.columns])


def _search_round(index: DataFrame, parts: DataFrame, pending: DataFrame, s: int, want: int) -> DataFrame:
    """Codes with a segment exactly s bits away from the pending queries': query, code, first_id, distance."""
    near = [(int(m), w) for w in range(min(s, CELL_BITS) + 1) if s - w <= _LOW_BITS for m in _masks(CELL_BITS, w)]
    flips = F.explode(F.array(*(F.struct(F.lit(m).alias("flip"), F.lit(s - w).alias("ring")) for m, w in near)))
    probes = _cells(pending).withColumn("f", flips).select("seg", F.col("cell").bitwiseXOR(F.col("f.flip")).alias("cell"), F.col("f.ring").alias("ring"), "low", F.col("code").alias("query"), "bound")
    probes = probes.join(F.broadcast(parts), ["seg", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def look(codes: pa.Table, asked: pa.Table) -> pa.Table:
        none = {"query": np.zeros(0, np.int64), "code": np.zeros(0, np.int64), "first_id": np.zeros(0, np.int64), "distance": np.zeros(0, np.int32)}
        if not codes.num_rows or not asked.num_rows:
            return pa.table(none)
        order = np.argsort(codes.column("low").to_numpy(), kind="stable")
        low, code, first = (codes.column(c).to_numpy()[order] for c in ("low", "code", "first_id"))
        edge = np.searchsorted(low, np.arange((1 << _LOW_BITS) + 1))
        q, qlow, ring, bound = (asked.column(c).to_numpy() for c in ("query", "low", "ring", "bound"))
        out: dict[str, list] = {k: [] for k in none}
        for r in np.unique(ring).tolist():
            masks = _masks(_LOW_BITS, r)
            rows = np.flatnonzero(ring == r)
            step = max(1, 200_000 // len(masks))
            for lo in range(0, len(rows), step):
                here = rows[lo: lo + step]
                slots = qlow[here][:, None] ^ masks[None, :]
                n = edge[slots + 1] - edge[slots]
                which = np.repeat(np.repeat(here, len(masks)), n.ravel())
                at = np.repeat(edge[slots].ravel(), n.ravel()) + X.within(n.ravel())
                d = np.bitwise_count((q[which] ^ code[at]).view(np.uint64)).astype(np.int32)
                keep = d <= bound[which]
                which, at, d = which[keep], at[keep], d[keep]
                best = np.lexsort((first[at], d, which))
                which, at, d = which[best], at[best], d[best]
                _, start, count = np.unique(which, return_index=True, return_counts=True)
                top = np.arange(len(which)) - np.repeat(start, count) < want
                out["query"].append(q[which[top]])
                out["code"].append(code[at[top]])
                out["first_id"].append(first[at[top]])
                out["distance"].append(d[top])
        return pa.table({k: np.concatenate(v) if v else none[k] for k, v in out.items()})

    keys = ["seg", "cell", "part"]
    return index.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(look, "query long, code long, first_id long, distance int")


def top_k(codes: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """The k nearest other rows of each asking row by Hamming distance: query_id, rank, id, distance.

    ``codes`` has id and code (64 bits in a long), ``asks`` is a condition on id. Nearest first, ties
    to the smaller id; all other rows where there are fewer than k. Exact for any data.

    Rows with null id or code take no part. Repeated (id, code) rows count once. Rows with equal
    codes are searched for once, with their k + 1 smallest ids, which are all that a top-k can need,
    so a code of very many rows costs no more than others. Empty tables give an empty result.
    """
    spark = codes.sparkSession
    scratch = Scratch(spark)
    want = k + 1
    codes = scratch.write(codes.where("id is not null and code is not null").select("id", "code"), "codes")
    rank = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    smallest = codes.distinct().withColumn("r", rank).where(F.col("r") <= want)
    known = scratch.write(smallest.groupBy("code").agg(F.min("id").alias("first_id"), F.sort_array(F.collect_list("id")).alias("ids")), "known")
    cells = _cells(known.select("code", "first_id"))
    sizes = cells.groupBy("seg", "cell").agg(F.count("*").alias("n")).collect()  # at most SEGMENTS * 2^CELL_BITS rows
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, id long, distance int")
    parts = spark.createDataFrame([(r["seg"], r["cell"], -(-r["n"] // PART_CODES)) for r in sizes], "seg int, cell int, parts int")
    cut = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    index = scratch.write(cells.join(F.broadcast(parts), ["seg", "cell"]).withColumn("part", cut).drop("parts"), "index")
    queries = codes.where(asks).select("code").distinct()
    pending = scratch.write(queries.withColumn("bound", F.lit(BITS)), "pending-0")
    found = None
    done: list[DataFrame] = []
    for s in range(WIDTH + 1):
        new = _search_round(index, parts, pending, s, want)
        new = new if found is None else new.unionByName(found)
        new = new.groupBy("query", "code").agg(F.min("first_id").alias("first_id"), F.min("distance").alias("distance"))
        near = new.join(known.select("code", F.size("ids").alias("n")), "code")
        order = Window.partitionBy("query").orderBy("distance", "first_id")
        near = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= want).withColumn("have", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        near = near.withColumn("bound", F.coalesce(F.min(F.when(F.col("have") >= want, F.col("distance"))).over(Window.partitionBy("query")), F.lit(BITS)))
        near = scratch.write(near.select("query", "code", "first_id", "distance", "bound"), f"near-{s}")
        radius = SEGMENTS * (s + 1) - 1
        covered = (F.col("bound") <= radius) if s < WIDTH else F.lit(True)
        done.append(near.where(covered))
        found = near.where(~covered).drop("bound")
        bounds = near.where(~covered).select(F.col("query").alias("code"), "bound").distinct()
        alive = pending.select("code").join(near.where(covered).select(F.col("query").alias("code")).distinct(), "code", "left_anti")
        pending = scratch.write(alive.join(bounds, "code", "left").select("code", F.coalesce("bound", F.lit(BITS)).alias("bound")), f"pending-{s + 1}")
        if pending.isEmpty():
            break
    answer = done[0]
    for x in done[1:]:
        answer = answer.unionByName(x)
    answer = answer.join(known.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("id"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    answer = answer.withColumn("r", place).where(F.col("r") <= want).drop("r")
    asked = codes.where(asks).distinct().select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    both = asked.join(answer, "query").where("id <> query_id")
    nearest = both.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
