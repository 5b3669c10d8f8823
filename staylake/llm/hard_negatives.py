"""Hard-negative mining over an inverted multi-index.

Every vector is cut into two halves, each half has a codebook, and a pair of codewords is a cell.
For an anchor, the best inner product that a half can have with any vector of a codeword is bounded
by that with the centroid plus the anchor half's norm times the codeword's radius; a cell's bound is
the sum of its two half bounds. A heap walks the cells by falling bound (the multi-sequence walk).

A search has two rounds. The first visits the best cells until they hold SEED_ROWS rows, which gives
each window a score that its answer reaches at least. The second walks on down to that score: what
is left then has a bound below it, so the windows are certified and the answers exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch

#: Rows aimed at per cell, most codewords of a half (so at most 65,536 cells), rows of a cell's part and anchors of a block.
CELL_ROWS, CODEWORDS, PART_ROWS, BLOCK_ANCHORS = 2048, 256, 4096, 1024
#: Rows (the first by a hash of the id) and entries that the codebooks are fitted on, and rounds of the fit; all rows are indexed.
SAMPLE_ROWS, SAMPLE_ENTRIES, FIT_ROUNDS = 20_000, 4_000_000, 8
#: Rows that the first round's cells hold together.
SEED_ROWS = 4096
_FAR = 1 << 62


@dataclass
class Index:
    """Codebooks, radii and rows per cell; ``rows`` is the table id, label, x, cell, part."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray  # codewords x codewords
    exact: type  # of the arithmetic that no inner product can leave
    rows: DataFrame = field(repr=False)
    parts: DataFrame = field(repr=False)

    @property
    def width(self) -> int:
        return self.books[0].shape[1] + self.books[1].shape[1]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def codebook(sample: np.ndarray, words: int) -> np.ndarray:
    """Centroids of a sample by Lloyd's rounds from fixed random rows; never more than it has different rows."""
    different = np.unique(sample, axis=0)
    rng = np.random.Generator(np.random.PCG64(12))
    centers = different[np.sort(rng.choice(len(different), min(words, len(different)), replace=False))].astype(np.float64)
    for _ in range(FIT_ROUNDS):
        code, _ = nearest(sample, centers)
        many = np.bincount(code, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, code, sample)
        centers[many > 0] = sums[many > 0] / many[many > 0, None]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every row and the distance to it."""
    x = x.astype(np.float64)
    code = np.argmin((centers ** 2).sum(1)[None, :] - 2 * x @ centers.T, axis=1)
    return code, np.sqrt(((x - centers[code]) ** 2).sum(1))


def bounds(index_books, radii, q: np.ndarray, sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Half-score bounds of one anchor: above (sign 1) or below (sign -1) every product with a codeword's vectors."""
    at = index_books[0].shape[1]
    halves = (q[:at], q[at:])
    return tuple(book @ h + sign * np.sqrt(h @ h) * r for book, r, h in zip(index_books, radii, halves, strict=True))


def walk(u: np.ndarray, v: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs (u[i] + v[j], i, j) by falling sum: the heap holds one candidate of each row met."""
    a, b = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
    heap = [(-(u[a[0]] + v[b[0]]), 0, 0)] if len(a) and len(b) else []
    while heap:
        s, i, j = heapq.heappop(heap)
        yield -s, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(u[a[i]] + v[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(u[a[i + 1]] + v[b[0]]), i + 1, 0))


def build(rows: DataFrame, scratch: Scratch) -> Index | None:
    """Index of ``rows`` (id, label, x: longs of one width); None if there are none."""
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    found = rows.agg(F.count("*").alias("n"), F.max(square).alias("norm2"), F.max(F.size("x")).alias("width")).first()
    n, width = found["n"], found["width"]
    if not n:
        return None
    if found["norm2"] >= 2.0 ** 62:
        raise ArithmeticError("inner products of these vectors do not fit a long")
    exact = np.float64 if found["norm2"] < 2.0 ** 52 else np.int64
    words = min(CODEWORDS, max(1, math.ceil(math.sqrt(n / CELL_ROWS))))
    most = min(SAMPLE_ROWS, max(words, SAMPLE_ENTRIES // max(1, width)))
    sample = np.array([r["x"] for r in rows.orderBy(F.xxhash64("id", F.lit("codebook")), "id").limit(most).select("x").collect()], dtype=np.int64)
    half = width // 2
    books = codebook(sample[:, :half], words), codebook(sample[:, half:], words)
    many = len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(X.column(batch, "x"), width)
            (i, r1), (j, r2) = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
            yield pa.record_batch([*batch.columns, pa.array((i * many + j).astype(np.int32)), pa.array(r1), pa.array(r2)], names=[*batch.schema.names, "cell", "r1", "r2"])

    assigned = scratch.write(rows.select("id", "label", "x").mapInArrow(assign, "id long, label long, x array<long>, cell int, r1 double, r2 double"), "assigned")
    cells = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()  # at most CODEWORDS^2 rows
    sizes, radii = np.zeros((len(books[0]), many), dtype=np.int64), (np.zeros(len(books[0])), np.zeros(many))
    for c in cells:
        i, j = divmod(c["cell"], many)
        sizes[i, j] = c["n"]
        radii[0][i], radii[1][j] = max(radii[0][i], c["r1"]), max(radii[1][j], c["r2"])
    parts = rows.sparkSession.createDataFrame([(c["cell"], -(-c["n"] // PART_ROWS)) for c in cells], "cell int, parts int")
    placed = assigned.join(F.broadcast(parts), "cell").select("id", "label", "x", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    return Index(books, radii, sizes, exact, placed, parts)


def _requests(index: Index, asking: DataFrame, seed: bool) -> DataFrame:
    """The cells that each anchor visits in the first (``seed``) or second round: cell, id, label, x, block, lo, hi.

    ``asking`` has id, label, x, block and the windows' least and greatest scores lo, hi (arrays).
    The second round passes the cells of the first and goes on to the smallest lo of the windows.
    """
    books, radii, sizes, width = index.books, index.radii, index.sizes, index.width
    longest = [np.sqrt((b ** 2).sum(1).max(initial=0)) + r.max(initial=0) for b, r in zip(books, radii, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(X.column(batch, "x"), width).astype(np.float64)
            lo, hi = X.column(batch, "lo").to_pylist(), X.column(batch, "hi").to_pylist()
            row, cell = [], []
            for k, q in enumerate(x):
                if not lo[k]:
                    continue
                slack = 1e-9 * (np.sqrt(q @ q) * sum(longest) + 1)  # rounding never hides a cell
                least, greatest = min(lo[k]) - slack, max(hi[k]) + slack
                below, seen = bounds(books, radii, q, -1), 0
                for bound, i, j in walk(*bounds(books, radii, q)):
                    if bound < least:
                        break
                    if not sizes[i, j] or below[0][i] + below[1][j] > greatest:
                        continue
                    if (seen < SEED_ROWS) == seed:
                        row.append(k)
                        cell.append(i * sizes.shape[1] + j)
                    seen += sizes[i, j]
                    if seed and seen >= SEED_ROWS:
                        break
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.record_batch([*taken.columns, pa.array(cell, pa.int32())], names=[*taken.schema.names, "cell"])

    return asking.select("id", "label", "x", "block", "lo", "hi").mapInArrow(run, "id long, label long, x array<long>, block int, lo array<long>, hi array<long>, cell int")


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, equal ones by smaller id."""
    if len(score) > k:
        last = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= last)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _visit(index: Index, requests: DataFrame, same: bool, k: int, scratch: Scratch, name: str) -> DataFrame:
    """anchor, slot, score, id: of each visited part, every window's first k rows of the same (or another) label."""
    width, exact = index.width, index.exact
    requests = requests.join(F.broadcast(index.parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    requests = scratch.write(requests.select("cell", "part", "block", "id", "label", "x", "lo", "hi"), f"{name}-requests")
    wanted = requests.select(*[F.col(c).alias(c) for c in ("cell", "part", "block")]).distinct()  # columns of their own beside those of requests
    held = index.rows.join(wanted, ["cell", "part"])

    def run(held: pa.Table, asking: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "slot": [], "score": [], "id": []}
        if held.num_rows and asking.num_rows:
            rows, queries = (matrix(t.column("x").combine_chunks(), width).astype(exact) for t in (held, asking))
            ids, labels = held.column("id").to_numpy(), held.column("label").to_numpy()
            anchor, label = asking.column("id").to_numpy(), asking.column("label").to_numpy()
            lo, hi = asking.column("lo").to_pylist(), asking.column("hi").to_pylist()
            for at in range(0, len(queries), 128):
                product = (queries[at: at + 128] @ rows.T).astype(np.int64)
                for q, scores in enumerate(product, at):
                    fits = np.flatnonzero(((labels == label[q]) == same) & (ids != anchor[q]) & (scores >= min(lo[q])))
                    scores, candidates = scores[fits], ids[fits]
                    for slot, (a, b) in enumerate(zip(lo[q], hi[q], strict=True)):
                        inside = np.flatnonzero((scores >= a) & (scores <= b))
                        best = inside[_best(scores[inside], candidates[inside], k)]
                        out["anchor"].append(np.full(len(best), anchor[q]))
                        out["slot"].append(np.full(len(best), slot, dtype=np.int32))
                        out["score"].append(scores[best])
                        out["id"].append(candidates[best])
        joined = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}
        return pa.table({c: pa.array(v, pa.int32() if c == "slot" else pa.int64()) for c, v in joined.items()})

    place = ["cell", "part", "block"]
    return held.groupBy(*place).cogroup(requests.groupBy(*place)).applyInArrow(run, "anchor long, slot int, score long, id long")


def first_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, asking: DataFrame, same: bool, k: int, scratch: Scratch, name: str) -> DataFrame:
    """anchor, slot, rank, score, id: the exact first k rows of every window of every anchor.

    ``asking``: id, label, x, block, and the windows lo, hi (arrays of least and greatest scores).
    """
    seeds = _requests(index, asking, True)
    early = scratch.write(first_k(_visit(index, seeds, same, k, scratch, f"{name}-seed"), k), f"{name}-early")
    # the k-th score so far is reached by the answer; windows with fewer rows go on to their own lower end
    reached = early.where(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reached"))
    again = asking.join(reached, asking["id"] == reached["anchor"], "left")
    start = F.transform("lo", lambda low, slot: F.greatest(low, F.coalesce(F.try_element_at("reached", slot), low)))
    late = _requests(index, again.select("id", "label", "x", "block", start.alias("lo"), "hi"), False)
    late = _visit(index, late, same, k, scratch, f"{name}-rest")
    return first_k(early.select("anchor", "slot", "score", "id").unionByName(late), k).select("anchor", "slot", "rank", "score", "id")


def mine(vectors: DataFrame, asks: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has id, label and x (an array of longs); ``asks`` is a condition on id that names the
    anchors. Scores are integer inner products with the anchor; higher ones come first, equal ones by
    smaller id. An anchor's positives are its first ``positives`` other rows of the same label; of each,
    the first ``negatives`` rows of other labels with low * p <= 100 * score <= high * p are returned.

    Rows with a null id, label, vector or component, and empty vectors, take no part. Rows repeated
    under one id count once (the smallest label and vector of them). If lengths differ, only vectors
    of the most frequent length (the longest of equally many) are indexed. An anchor without other
    rows of its label, or a window without rows, gives none; a table with fewer rows than asked for
    gives all; an empty one nothing. Other columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession)
    usable = vectors.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull()))
    usable = usable.select(F.col("id").cast("long").alias("id"), F.struct(F.col("label").cast("long").alias("label"), F.col("x").cast("array<long>").alias("x")).alias("row"))
    rows = scratch.write(usable.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.x"), "rows")
    empty = vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    common = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return empty
    rows = rows.where(F.size("x") == common["width"])
    index = build(rows, scratch)
    n_anchors = rows.where(asks).count()
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(max(1, -(-n_anchors // BLOCK_ANCHORS)))).cast("int").alias("block")
    anchors = scratch.write(rows.where(asks).select("id", "label", "x", block), "anchors")
    everything = anchors.select("*", F.array(F.lit(-_FAR)).alias("lo"), F.array(F.lit(_FAR)).alias("hi"))
    best = scratch.write(search(index, everything, True, positives, scratch, "positive"), "positives")
    own = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("own"))
    p = lambda r: r["score"].cast("decimal(30,0)")
    windows = own.select("anchor", F.transform("own", lambda r: F.ceil(p(r) * low / 100).cast("long")).alias("lo"), F.transform("own", lambda r: F.floor(p(r) * high / 100).cast("long")).alias("hi"))
    asking = scratch.write(anchors.join(windows, anchors["id"] == windows["anchor"]).select("id", "label", "x", "block", "lo", "hi"), "windows")
    mined = search(index, asking, False, negatives, scratch, "negative").alias("m")
    pairs = best.select(F.col("anchor").alias("anchor_id"), (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = mined.join(pairs, (F.col("m.anchor") == F.col("anchor_id")) & (F.col("m.slot") == pairs["slot"]))
    return out.select("anchor_id", "positive_id", F.col("m.rank").alias("rank"), F.col("m.id").alias("negative_id"), "positive_score", F.col("m.score").alias("negative_score"))
