"""Boosted regression trees of many fits at once: every fold and feature set of a study shares the passes over the rows.

Each fit grows the trees that Spark's ``GBTRegressor`` grows for squared error: the first tree on the target, every
later one on twice the residual, level by level, a split by the fall in variance over binned values. A
``GBTRegressor`` reads its rows once a level, so a study of F fits reads them F times as often. Here the rows are binned
and packed once; a pass sums the histograms of the open nodes of all fits, one shuffle of (fit, node, bin) sums
adds them up and picks the splits, and the driver holds the trees only. Two details differ: the candidate
splits come from all training rows, not from a sample of them, and the rows of a tree are drawn by a hash of
their key, so that fits do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from staylake.llm._ship import ship
from staylake.operators.ranks import quantiles_from_counts, stacked_counts
from staylake.session import ensure_checkpoint_dir

#: The parameters of ``GBTRegressor`` that fits here follow, with its defaults.
PARAMS: dict[str, Any] = {"maxDepth": 5, "maxBins": 32, "minInstancesPerNode": 1, "minInfoGain": 0.0, "maxIter": 20, "stepSize": 0.1,
                          "subsamplingRate": 1.0}
#: Rows of a packed block and of a task, trees between checkpoints, and the distinct values of a fold's columns that the driver gets.
BLOCK_ROWS, TASK_ROWS, CHECKPOINT_TREES, COUNTED_VALUES = 50_000, 200_000, 10, 50_000
#: Means and gains this near (relative) are equal but for rounding: sums arrive in any order, and a fit must not depend on it.
SAME_MEAN, SAME_GAIN = 1e-12, 1e-9
PACKED = "n int, fold binary, y binary, h binary, bins binary"


@dataclass
class Column:
    """A binned column: ``cuts`` between a number's bins, or ``values`` categories and one bin for all others."""
    feature: str
    name: str
    cuts: np.ndarray | None = None
    values: int = 0

    @property
    def width(self) -> int:
        return len(self.cuts) + 1 if self.cuts is not None else self.values + 1


@dataclass
class Tree:
    """Nodes in the order they were made, the root first; a leaf has column -1. Right of a number's split are the bins
    above ``cut``, right of a category's split that one category."""
    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])
    depth: int = 0

    def split(self, node: int, column: int, cut: int, values: tuple[float, float]) -> None:
        self.column[node], self.cut[node], self.left[node] = column, cut, len(self.column)
        for v in values:
            self.column.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(v)


class Block(NamedTuple):
    """Rows of a task: fold, target, hash of the key, bins by fold (column, row), predictions so far (fit, row)."""
    fold: np.ndarray
    y: np.ndarray
    h: np.ndarray
    bins: list[np.ndarray]
    pred: np.ndarray


@dataclass
class Fit:
    """One model: it learns from the rows outside ``fold`` and uses the fold's columns at ``columns``."""
    fold: int
    columns: list[int]
    tree: Tree = field(default_factory=Tree)


# ---------------------------------------------------------------- bins

def stride_cuts(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """``GBTRegressor``'s thresholds of sorted distinct values: midpoints, of all or of those nearest to equal shares."""
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= max_bins - 1:
        return middle
    stride = counts.sum() / max_bins
    total, target, chosen = float(counts[0]), stride, []
    for i in range(1, len(values)):
        before, total = total, total + float(counts[i])
        if abs(before - target) < abs(total - target):
            chosen.append(i - 1)
            target += stride
    return middle[chosen]


def cut_counted(pairs: Iterable[tuple[float | None, int]], max_bins: int) -> np.ndarray:
    """``stride_cuts`` of (value, rows) in any order; values may repeat, and NULL is none."""
    total: dict[float, int] = {}
    for v, n in pairs:
        if v is not None:
            total[v] = total.get(v, 0) + n
    at = np.array(sorted(total.items()), dtype=np.float64).reshape(-1, 2)
    return stride_cuts(at[:, 0], at[:, 1], max(1, min(max_bins, int(at[:, 1].sum())))) if len(at) else np.zeros(0)


def cut_points(rows: DataFrame, cols: Sequence[str], max_bins: int) -> dict[str, np.ndarray]:
    """Thresholds of each column over all ``rows``, from counts of its distinct values. Up to COUNTED_VALUES of them the
    driver cuts itself; with more it does so only for columns of few values, and others are cut at exact quantiles found on the cluster."""
    counts = stacked_counts(rows, cols)
    pairs, many = counts.limit(COUNTED_VALUES + 1).collect(), []
    if len(pairs) > COUNTED_VALUES:
        sizes = {r["_sl_column"]: r["count"] for r in counts.groupBy("_sl_column").count().collect()}
        many = [c for c in cols if sizes[c] > COUNTED_VALUES // len(cols)]
        few = [c for c in cols if c not in many]
        pairs = counts.where(F.col("_sl_column").isin(few)).collect() if few else []
    out = {c: cut_counted(((r["_sl_value"], r["n_equal"]) for r in pairs if r["_sl_column"] == c), max_bins) for c in cols if c not in many}
    if many:
        names = [f"q{i}" for i in range(1, max_bins)]
        asked = quantiles_from_counts(counts.where(F.col("_sl_column").isin(many)), "_sl_value",
                                      [i / max_bins for i in range(1, max_bins)], ["_sl_column"], names, few_groups=True)
        out |= {r["_sl_column"]: np.unique(np.array([r[q] for q in names], dtype=np.float64)) for r in asked.collect()}
    return out


def pack(rows: DataFrame, columns: Sequence[Sequence[Column]], n_fits: int) -> RDD[Block]:
    """Blocks of binned rows from (fold, y, h, x0, x1, ...): ``x<k>`` holds the values of fold k's columns. Predictions are 0.

    Passes over an RDD hand whole blocks to Python; as rows of a cached table they were copied column by column each time."""
    kind = np.uint8 if max(c.width for cols in columns for c in cols) <= 1 << 8 else np.uint32

    def binned(x: np.ndarray, cols: Sequence[Column]) -> np.ndarray:
        if not np.isfinite(x).all():
            raise ValueError("a feature is not finite")
        return np.stack([x[:, j].astype(kind) if c.cuts is None else np.searchsorted(c.cuts, x[:, j]).astype(kind) for j, c in enumerate(cols)])

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        get = lambda name: t.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        y, n = get("y").astype(np.float64), t.num_rows
        if not np.isfinite(y).all():
            raise ValueError("a target is not finite")
        bins = [binned(t.column(f"x{k}").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1), cols).tobytes()
                for k, cols in enumerate(columns)]
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *[pa.array([b], pa.binary()) for b in (
            get("fold").astype(np.int32).tobytes(), y.tobytes(), get("h").astype(np.int64).tobytes(), b"".join(bins))]], ["n", "fold", "y", "h", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def unpack(r: Row) -> Block:
        flat, ends = np.frombuffer(r["bins"], dtype=kind), np.cumsum([0, *[len(c) for c in columns]]) * r["n"]
        return Block(np.frombuffer(r["fold"], dtype=np.int32), np.frombuffer(r["y"]), np.frombuffer(r["h"], dtype=np.uint64),
                     [flat[a:b].reshape(-1, r["n"]) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.zeros((n_fits, r["n"])))

    ship(rows.sparkSession)
    return rows.mapInArrow(run, PACKED).rdd.map(unpack)


# ---------------------------------------------------------------- passes

def _drawn(h: np.ndarray, seed: int, tree: int, rate: float) -> np.ndarray:
    """The rows that a tree learns from: a uniform number of each row's hash, the seed and the tree, below ``rate``."""
    if rate >= 1.0:
        return np.ones(len(h), dtype=bool)
    z = h + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < rate


def _walk(tree: Tree, columns: Sequence[Column], bins: np.ndarray) -> np.ndarray:
    """The node that each row has reached, one table look-up a level."""
    n = bins.shape[1]
    node = np.zeros(n, dtype=np.int64)
    if len(tree.column) == 1:
        return node
    wide = max(c.width for c in columns)
    after = np.repeat(np.arange(len(tree.column), dtype=np.int64)[:, None], wide, axis=1)
    for i, c in enumerate(tree.column):
        if c >= 0:
            bin_ = np.arange(wide)
            after[i] = tree.left[i] + (bin_ > tree.cut[i] if columns[c].cuts is not None else bin_ == tree.cut[i])
    after, flat = after.ravel(), np.ascontiguousarray(bins).ravel()
    start, row, first = np.maximum(tree.column, 0).astype(np.int64) * n, np.arange(n, dtype=np.int64), np.arange(len(tree.column), dtype=np.int64) * wide
    for _ in range(tree.depth):
        node = after.take(first.take(node) + flat.take(start.take(node) + row))
    return node


def _histograms(blocks: Iterator[Block], fits: Sequence[Fit], columns: Sequence[Sequence[Column]], m: int, seed: int,
                rate: float) -> Iterator[tuple[int, np.ndarray]]:
    """A task's rows and sum of labels per open node and bin, columns side by side, for every fit: (fit, sums)."""
    sums: dict[int, np.ndarray] = {}
    for b in blocks:
        drawn = _drawn(b.h, seed, m, rate)
        for k, cols in enumerate(columns):
            mine = [i for i, f in enumerate(fits) if f.fold == k and f.tree.open]
            if not mine:
                continue
            at = np.flatnonzero(drawn & (b.fold != k))
            bins, y = b.bins[k].take(at, axis=1), b.y.take(at)
            for i in mine:
                tree, chosen = fits[i].tree, fits[i].columns
                label = y if m == 0 else 2.0 * (y - b.pred[i].take(at))
                places, slot_of = len(tree.open), np.full(len(tree.column), len(tree.open), dtype=np.int64)
                slot_of[tree.open] = np.arange(places)  # rows of closed nodes go to one more place
                slot = slot_of.take(_walk(tree, cols, bins))
                parts, base = [], {w: slot * w for w in {cols[c].width for c in chosen}}
                for c in chosen:
                    w = cols[c].width
                    where = base[w] + bins[c]
                    parts.append(np.stack([np.bincount(where, minlength=(places + 1) * w).reshape(-1, w)[:places],
                                           np.bincount(where, label, (places + 1) * w).reshape(-1, w)[:places]]))
                found = np.concatenate(parts, axis=2)
                sums[i] = sums[i] + found if i in sums else found
    yield from sums.items()


def _best_splits(total: np.ndarray, fit: Fit, cols: Sequence[Column], least: int, least_gain: float) -> np.ndarray:
    """The best split of each open node of a fit, the first of equals in the order of the assembled vector: a row of
    gain (0: none), column, cut, mean on the left, mean on the right, rows of the node and their mean."""
    nodes = fit.tree.open
    first = total[:, :, :cols[fit.columns[0]].width].sum(axis=2)  # every row is in one bin of the first column
    best = np.zeros((len(nodes), 5))  # gain, column, cut, mean on the left, on the right
    start = 0
    for c in fit.columns:
        w = cols[c].width
        n, s = total[0, :, start:start + w], total[1, :, start:start + w]
        start += w
        if w < 2:
            continue
        # the last bin is no candidate: nothing is above it, or it is that of unknown categories
        side = (n.cumsum(axis=1)[:, :-1], s.cumsum(axis=1)[:, :-1]) if cols[c].cuts is not None else (n[:, :-1], s[:, :-1])
        other = first[0][:, None] - side[0], first[1][:, None] - side[1]
        (nl, sl), (nr, sr) = (side, other) if cols[c].cuts is not None else (other, side)
        ok = (nl >= max(least, 1)) & (nr >= max(least, 1))
        ml, mr = np.divide(sl, nl, out=np.zeros_like(sl), where=ok), np.divide(sr, nr, out=np.zeros_like(sr), where=ok)
        ok &= np.abs(ml - mr) > SAME_MEAN * (np.abs(ml) + np.abs(mr))
        whole = np.maximum(first[0], 1)[:, None]
        gain = np.where(ok, (nl / whole) * (nr / whole) * (ml - mr) ** 2, 0.0)
        gain[gain < least_gain] = 0.0
        at, row = (gain >= gain.max(axis=1, keepdims=True) * (1 - SAME_GAIN)).argmax(axis=1), np.arange(len(nodes))
        better = gain[row, at] > best[:, 0] * (1 + SAME_GAIN)
        best[better] = np.stack([gain[row, at], np.full(len(nodes), c), at, ml[row, at], mr[row, at]], axis=1)[better]
    return np.column_stack([best, first[0], first[1] / np.maximum(first[0], 1)])


def _add_tree(b: Block, fits: Sequence[Fit], columns: Sequence[Sequence[Column]], weight: float) -> Block:
    """The block with every fit's prediction moved by its tree."""
    moves = [np.array(f.tree.value).take(_walk(f.tree, columns[f.fold], b.bins[f.fold])) for f in fits]
    return b._replace(pred=b.pred + weight * np.stack(moves))


def _held_out(b: Block, fits: Sequence[Fit]) -> np.ndarray:
    """Rows and squared error of each fit's own fold."""
    return np.array([(mine.sum(), ((b.y[mine] - b.pred[i][mine]) ** 2).sum()) for i, f in enumerate(fits) for mine in [b.fold == f.fold]])


# ---------------------------------------------------------------- fits

def follows(params: dict) -> bool:
    """Whether fits here follow all of these parameters of ``GBTRegressor``."""
    return set(params) <= set(PARAMS)


def fit_together(rows: DataFrame, columns: Sequence[Sequence[Column]], fits: Sequence[Fit], params: dict, seed: int) -> list[float | None]:
    """Fits all of ``fits`` on ``rows`` (fold, y, h, x0, x1, ...; see ``pack``): RMSE of each on its own fold, None without rows.

    Predictions so far are kept with the packed rows, cached anew after every tree and checkpointed every
    CHECKPOINT_TREES trees. A level takes one pass and one shuffle for all fits."""
    p = PARAMS | params
    sc, rate, depth = rows.sparkSession.sparkContext, float(p["subsamplingRate"]), int(p["maxDepth"])
    least, least_gain = int(p["minInstancesPerNode"]), float(p["minInfoGain"])
    ensure_checkpoint_dir(rows.sparkSession)
    parts = max(1, min(rows.rdd.getNumPartitions(), max(sc.defaultParallelism, -(-rows.count() // TASK_ROWS))))
    state = pack(rows.coalesce(parts), columns, len(fits)).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    try:
        for m in range(int(p["maxIter"])):
            for f in fits:
                f.tree = Tree()
            for _ in range(max(1, depth)):
                if not any(f.tree.open for f in fits):
                    break
                now = [replace(f) for f in fits]
                sums = state.mapPartitions(lambda b: _histograms(b, now, columns, m, seed, rate)).reduceByKey(np.add, min(parts, len(fits)))  # noqa: B023
                best = sums.map(lambda s: (s[0], _best_splits(s[1], now[s[0]], columns[now[s[0]].fold], least, least_gain))).collect()  # noqa: B023
                while len(held) > 1:  # the pass has read the new predictions
                    held.pop(0).unpersist()
                _grow(fits, dict(best), depth)
            grown, weight = [replace(f) for f in fits], 1.0 if m == 0 else float(p["stepSize"])
            state = state.map(lambda b: _add_tree(b, grown, columns, weight)).persist(StorageLevel.MEMORY_AND_DISK)  # noqa: B023
            if (m + 1) % CHECKPOINT_TREES == 0:
                state.checkpoint()
            held.append(state)
        errors = state.map(lambda b: _held_out(b, fits)).fold(np.zeros((len(fits), 2)), np.add)
        return [float(np.sqrt(e / n)) if n else None for n, e in errors]
    finally:
        for s in held:
            s.unpersist()


def _grow(fits: Sequence[Fit], best: dict[int, np.ndarray], depth: int) -> None:
    """Splits the open nodes; their children are open next, unless they are at ``depth``."""
    for i, f in enumerate(fits):
        tree, fresh = f.tree, []
        for node, (gain, column, cut, left, right, _, mean) in zip(tree.open, best.get(i, ()), strict=False):
            if node == 0:
                tree.value[0] = mean
            if gain > 0 and tree.depth < depth:
                tree.split(node, int(column), int(cut), (left, right))
                fresh += [len(tree.column) - 2, len(tree.column) - 1]
        tree.depth += bool(fresh)
        tree.open = fresh if tree.depth < depth else []
