"""Approximate nearest neighbours by cross-polytope hashing.

A table is a fast pseudo-rotation of the unit vectors (random signs and a Hadamard transform, three
times over); a vector's cell is its nearest signed axis. A query looks into the cells of its
nearest axes in every table. All vectors of those cells are candidates; their cosines are computed
exactly, in double precision, where they lie, and only each cell's best travel on.
Queries that find fewer than they ask for are compared with all vectors, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch

TABLES, PROBES = 8, 20
#: A cell is cut into parts of about this many vectors.
PART_VECTORS = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of each row (a power of two long)."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The table's pseudo-rotation, of vectors padded with 0 to a power of two."""
    d = x.shape[1]
    n = 1 << max(0, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, n - d)))
    signs = np.random.Generator(np.random.PCG64([seed, table, n])).integers(0, 2, (3, n)) * 2.0 - 1
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(x: np.ndarray, tables: int, probes: int, seed: int) -> np.ndarray:
    """Numbers of the nearest signed axes (2 i, or 2 i + 1 for the negative one), rows x tables x probes."""
    out = []
    for t in range(tables):
        y = rotate(x, t, seed)
        both = np.stack([y, -y], axis=2).reshape(len(y), -1)
        out.append(np.argsort(-both, axis=1, kind="stable")[:, :probes])
    return np.stack(out, axis=1)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    return flat, lengths


def _cells(vectors: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """dim, tbl, cell, key, v: a row for each table and probed axis."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, lengths = _matrix(X.column(batch, "v"))
            keys, ends = X.column(batch, "key").to_numpy(), np.cumsum(lengths)
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                for lo in range(0, len(rows), 1000):
                    r = rows[lo: lo + 1000]
                    x = flat[(ends[r] - d)[:, None] + np.arange(d)]
                    cells = axes(x / np.linalg.norm(x, axis=1, keepdims=True), tables, probes, seed)
                    n = cells.shape[2]
                    many = tables * n
                    yield pa.record_batch({
                        "dim": np.full(len(r) * many, d, np.int32), "tbl": np.tile(np.repeat(np.arange(tables, dtype=np.int32), n), len(r)), "cell": cells.astype(np.int32).ravel(),
                        "key": np.repeat(keys[r], many), "v": X.column(batch, "v").take(pa.array(np.repeat(r, many)))})

    return vectors.select("key", "v").mapInArrow(run, "dim int, tbl int, cell int, key long, v array<double>")


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, each row by itself."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def search(vectors: DataFrame, id_name: str, vector_name: str, asks: Column, k: int = 5, tables: int = TABLES, probes: int = PROBES, seed: int = 8) -> DataFrame:
    """The k nearest found other vectors of each asking row by cosine: query_id, rank, vec_id, score.

    ``asks`` is a condition on the id column; every usable row is indexed. Nearest first, ties to the
    smaller id; scores are exact. A query that the probes give fewer than k gets its exact answer from
    all vectors. Measured recall at the defaults is in the README.

    Null vectors, vectors with null or non-finite components, zero vectors and rows without id take
    no part. Only vectors of the query's length are candidates. Equal vectors are indexed once, with
    their k + 1 smallest ids, so a vector of very many rows costs no more than others; repeated rows
    of one id count once. Tables with fewer candidates give all of them; empty ones nothing.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    want = k + 1
    v = F.col(vector_name).cast("array<double>")
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_name).isNotNull() & usable).select(F.col(id_name).cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    smallest = rows.distinct().withColumn("r", rank).where(F.col("r") <= want)
    known = smallest.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("key", F.xxhash64("v", F.element_at("ids", 1)))
    known = scratch.write(known, "known")
    asked = rows.withColumnRenamed("id", id_name).where(asks).withColumnRenamed(id_name, "id")
    asked = scratch.write(asked.distinct().join(known.select("v", "key"), "v").select(F.col("id").alias("query_id"), "key"), "asked")
    queries = known.join(asked.select("key").distinct(), "key", "left_semi")
    index = _cells(known, tables, 1, seed)
    sizes = index.groupBy("dim", "tbl", "cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / PART_VECTORS).cast("int")).drop("n")
    sizes = scratch.write(sizes, "sizes")
    place = ["dim", "tbl", "cell"]
    index = index.join(sizes, place).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")
    probed = _cells(queries, tables, probes, seed).join(sizes, place).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def rerank(held: pa.Table, asking: pa.Table) -> pa.Table:
        q_out, k_out, s_out = [], [], []
        if held.num_rows and asking.num_rows:
            stack = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            a, b = stack(asking), stack(held)
            unit = b / np.linalg.norm(b, axis=1, keepdims=True)
            q, key = asking.column("key").to_numpy(), held.column("key").to_numpy()
            for i in range(len(a)):
                near = unit @ (a[i] / np.linalg.norm(a[i]))
                n = min(want, len(near))
                at = np.flatnonzero(near >= np.partition(near, len(near) - n)[len(near) - n] - 1e-9)
                s = exact_cosines(np.broadcast_to(a[i], (len(at), a.shape[1])), b[at])
                best = np.flatnonzero(s >= np.sort(s)[-n])  # with every tie of the last place
                q_out.append(np.full(len(best), q[i]))
                k_out.append(key[at[best]])
                s_out.append(s[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query": join(q_out, np.int64), "key": join(k_out, np.int64), "score": join(s_out, np.float64)})

    def nearest(index: DataFrame, probed: DataFrame, place: list[str], asked: DataFrame) -> DataFrame:
        near = index.groupBy(*place).cogroup(probed.groupBy(*place)).applyInArrow(rerank, "query long, key long, score double").groupBy("query", "key").agg(F.max("score").alias("score"))
        near = near.join(known.select("key", "ids"), "key").select("query", "score", F.explode("ids").alias("vec_id"))
        order = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
        near = near.withColumn("r", order).where(F.col("r") <= want).drop("r")
        found = asked.join(near, asked["key"] == near["query"]).where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = scratch.write(nearest(index, probed, [*place, "part"], asked), "found")
    full = found.where(F.col("rank") == k).select("query_id")
    few = scratch.write(asked.join(full, "query_id", "left_anti"), "few")
    if few.isEmpty():
        return found
    blocks = known.select("key", "v", F.size("v").alias("dim"))
    n_blocks = blocks.groupBy("dim").agg(F.ceil(F.count("*") / PART_VECTORS).cast("int").alias("parts"))
    blocks = blocks.join(n_blocks, "dim")
    asking = blocks.join(few.select("key").distinct(), "key", "left_semi").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asking = asking.select("part", *[F.col(c).alias(c) for c in ("dim", "key", "v")])  # columns of their own beside those of blocks
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")
    return found.join(few, "query_id", "left_anti").unionByName(nearest(blocks, asking, ["dim", "part"], few))
