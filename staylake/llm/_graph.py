"""Connected components of a link table, and exact set overlap inside candidate clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from staylake.llm._scratch import Scratch

ROWS_PER_BLOCK = 1024
COLUMNS_PER_BLOCK = 1024


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Smallest reachable node of every linked node: columns ``node``, ``root``.

    Alternating large-star and small-star steps on (a, b) pairs until the pairs no longer change;
    each step is one aggregate and one join, and its result is a written table. The smallest
    neighbour is a map-side combined minimum and the join back can be split, so a node with very
    many links does not need one task.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, step, before = scratch.write(edges, f"{name}-0"), 0, None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        down = star.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        step += 1
        edges = scratch.write(down, f"{name}-{step}")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(f"{name}-{step - 1}")
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _overlaps(tokens_a: list[np.ndarray], tokens_b: list[np.ndarray] | None, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of A link with which rows of B (A with itself if B is None): |x & y| * 100 >= percent * |x | y|.

    The product of the two row blocks is accumulated over blocks of columns, rare columns first;
    a pair is given up once even all of its remaining columns could not reach the bound that
    follows from its sizes, and rows without a pair left over are not multiplied any more.
    """
    rows = tokens_a if tokens_b is None else tokens_a + tokens_b
    lengths = np.array([len(t) for t in rows])
    _, column, df = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), dtype=np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    column, row = rank[column], np.repeat(np.arange(len(rows)), lengths)
    keep = column >= np.count_nonzero(df == 1)
    column, row = column[keep], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    na = len(tokens_a)
    left = np.bincount(row, minlength=len(rows)).astype(np.float32)
    sa, sb = size_a.astype(np.float64), size_b.astype(np.float64)
    need = np.ceil((sa[:, None] + sb[None, :]) * percent / (100 + percent) - 1e-9).astype(np.float32)
    live = np.minimum(sa[:, None], sb[None, :]) * 100 >= np.maximum(sa[:, None], sb[None, :]) * percent
    if tokens_b is None:
        live &= ~np.eye(na, dtype=bool)
    got = np.zeros(need.shape, dtype=np.float32)
    first = int(column[0]) if len(column) else 0
    for lo in range(first, int(column[-1]) + 1 if len(column) else 0, COLUMNS_PER_BLOCK):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS_PER_BLOCK])
        r, c = row[i:j], column[i:j] - lo
        left -= np.bincount(r, minlength=len(rows))
        width = int(c.max()) + 1
        block = np.zeros((len(rows), width), dtype=np.float32)
        block[r, c] = 1
        a, b = block[:na], block if tokens_b is None else block[na:]
        ia, ib = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        if not len(ia):
            break
        got[np.ix_(ia, ib)] += a[ia] @ b[ib].T
        rest = np.minimum(left[:na, None], (left if tokens_b is None else left[na:])[None, :])
        live &= got + rest >= need
    return live & (got >= need)


def _forest(linked: np.ndarray, square: bool) -> np.ndarray:
    """Component label (a row number, B's rows after A's) of every row of a link matrix."""
    na, nb = linked.shape
    la, lb = np.arange(na), np.arange(nb) + (0 if square else na)
    while True:
        ma = np.minimum(la, np.where(linked, lb[None, :], na + nb).min(1, initial=na + nb))
        source = ma if square else np.where(linked, ma[:, None], na + nb).min(0, initial=na + nb)
        mb = ma if square else np.minimum(lb, source)
        if (ma == la).all() and (mb == lb).all():
            return la if square else np.concatenate([la, lb])
        la, lb = ma, mb


def verify_clusters(clusters: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Exact links inside candidate clusters.

    ``clusters`` has node, root (of the candidate links); ``sets`` has key, n (set size) and tokens
    (little-endian 64-bit hashes of all the elements that more than one set holds). Every cluster is cut into blocks of
    rows by size, and every pair of blocks whose sizes can reach the bound is multiplied in a task
    of its own or with other small ones; so a cluster of any size is spread over many tasks.
    Returns a, b (a spanning forest of each block's links) and degree (the links of a there).
    """
    roots = clusters.select("root").distinct().select(F.col("root").alias("node"), "root")
    members = clusters.unionByName(roots).withColumnRenamed("node", "key").join(sets.select("key", "n"), "key")
    ranked = members.withColumn("blk", F.floor((F.row_number().over(Window.partitionBy("root").orderBy("n", "key")) - 1) / ROWS_PER_BLOCK).cast("int"))
    ranked = scratch.write(ranked, f"{name}-members")
    blocks = ranked.groupBy("root", "blk").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("rows"))
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, (F.col("x.root") == F.col("y.root")) & (F.col("x.blk") <= F.col("y.blk")) & (F.col("x.high") * 100 >= F.col("y.low") * percent)).select(
        F.col("x.root").alias("root"), F.col("x.blk").alias("i"), F.col("y.blk").alias("j"), (F.col("x.rows") + F.col("y.rows")).alias("rows"))
    pairs = scratch.write(pairs.where("i < j or rows > 2"), f"{name}-pairs")
    shipped = pairs.agg(F.sum("rows")).first()[0] or 0
    bundles = max(1, -(-shipped // (2 * ROWS_PER_BLOCK)))
    sides = pairs.select("root", "i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))).alias("blk"))
    sent = sides.join(ranked, ["root", "blk"]).join(sets.select("key", "tokens"), "key")
    sent = sent.withColumn("bundle", F.pmod(F.xxhash64("root", "i", "j"), F.lit(bundles)))

    def multiply(table: pa.Table) -> pa.Table:
        root, i, j, blk = (table.column(c).to_numpy() for c in ("root", "i", "j", "blk"))
        key, n, tokens = table.column("key").to_numpy(), table.column("n").to_numpy(), table.column("tokens").to_pylist()
        order = np.lexsort((key, blk, j, i, root))
        start = np.flatnonzero(np.r_[True, (np.diff(root[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)])
        out_a, out_b, out_d = [], [], []
        for lo, hi in zip(start, np.r_[start[1:], len(order)], strict=True):
            at = order[lo:hi]
            square = i[at[0]] == j[at[0]]
            sets_here = [np.frombuffer(tokens[k], dtype=np.uint64) for k in at]
            na = len(at) if square else int(np.count_nonzero(blk[at] == i[at[0]]))
            linked = _overlaps(sets_here[:na], None if square else sets_here[na:], n[at[:na]], n[at if square else at[na:]], percent)
            degree = linked.sum(1) if square else np.concatenate([linked.sum(1), linked.sum(0)])
            label = _forest(linked, bool(square))
            has = np.flatnonzero(degree)
            out_a.append(key[at[has]])
            out_b.append(key[at[label[has]]])
            out_d.append(degree[has])
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return pa.table({"a": join(out_a), "b": join(out_b), "degree": join(out_d)})

    return sent.select("bundle", "root", "i", "j", "blk", "key", "n", "tokens").groupBy("bundle").applyInArrow(multiply, "a long, b long, degree long")


def as_batches(name_arrays: dict, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    yield from pa.table(name_arrays).to_batches(max_chunksize=size)
