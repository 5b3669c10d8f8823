"""Document quality by a byte-level convolutional network in numpy.

The input symbol of a byte is its value, moved up by 256 inside a word that repeats the word
before it. Learned filters slide over all symbols of the document; each filter's responses are
max-pooled over chunks of CHUNK bytes that overlap by half and cover the whole text, and the
chunks' pooled features are combined (mean and maximum) into one probability.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staylake.llm import _text as X
from staylake.llm._scratch import Scratch, free_name
from staylake.llm._ship import ship

FILTERS, WIDTH, CHUNK = 16, 5, 256
STRIDE = CHUNK // 2
#: Labelled documents of each class that the network is fitted on, and chunks of each that the filters see.
SAMPLE_PER_CLASS = 2000
CHUNKS_PER_DOCUMENT = 6
STEPS, BATCH, RATE = 500, 64, 0.01
_PIECE = 128 * STRIDE


@dataclass
class Network:
    """filters[k][symbol] is the weight row of the k-th symbol of a window; dense weighs the combined features."""

    filters: np.ndarray  # WIDTH x 512 x FILTERS
    bias: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    dense: np.ndarray
    offset: float


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input symbols of all rows, each row padded with 0 to whole strides, and the strides per row (2 at least)."""
    h, s, e = X.word_spans(data, offsets, X.NOT_SPACE)
    row = np.searchsorted(offsets, s, "right") - 1
    again = np.flatnonzero((h[1:] == h[:-1]) & (row[1:] == row[:-1])) + 1
    mark = np.zeros(len(data) + 1, dtype=np.int16)
    mark[s[again]] = 1
    np.subtract.at(mark, e[again], 1)
    x = data.astype(np.int16) + 256 * np.cumsum(mark[:-1], dtype=np.int16)
    lengths = np.diff(offsets)
    strides = np.maximum(-(-(lengths + WIDTH - 1) // STRIDE), 2)
    out = np.zeros(int(strides.sum()) * STRIDE, dtype=np.int16)
    first = (np.cumsum(strides) - strides) * STRIDE
    out[np.repeat(first - offsets[:-1], lengths) + np.arange(len(data))] = x
    return out, strides


def convolve(net: Network, x: np.ndarray, strides: np.ndarray) -> np.ndarray:
    """Largest response of every filter in every stride, over the windows that lie inside one row."""
    out = np.empty((len(x) // STRIDE, FILTERS), dtype=np.float32)
    padded = np.concatenate([x, np.zeros(WIDTH - 1, dtype=x.dtype)])
    row_ends = np.cumsum(strides) * STRIDE
    for lo in range(0, len(x), _PIECE):
        n = min(_PIECE, len(x) - lo)
        r = net.filters[0].take(padded[lo: lo + n], axis=0)
        for k in range(1, WIDTH):
            r += net.filters[k].take(padded[lo + k: lo + k + n], axis=0)
        ends = row_ends[(row_ends > lo) & (row_ends <= lo + n)] - lo
        for k in range(1, WIDTH):
            r[ends - k] = -np.inf
        out[lo // STRIDE: (lo + n) // STRIDE] = r.reshape(-1, STRIDE, FILTERS).max(1)
    return out


def features(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Combined features of every row: mean and maximum over its chunks."""
    x, strides = symbols(data, offsets)
    if not len(strides):
        return np.zeros((0, 2 * FILTERS), dtype=np.float32)
    peak = convolve(net, x, strides)
    chunk = np.maximum(np.maximum(peak[:-1], peak[1:]) + net.bias, 0)
    start = np.cumsum(strides) - strides
    real = np.ones(len(chunk), dtype=bool)
    real[start[1:] - 1] = False  # between two rows
    chunk, chunks = chunk[real], strides - 1
    first = np.cumsum(chunks) - chunks
    return np.hstack([np.add.reduceat(chunk, first, axis=0) / chunks[:, None], np.maximum.reduceat(chunk, first, axis=0)]).astype(np.float32)


def probability(net: Network, f: np.ndarray) -> np.ndarray:
    z = ((f - net.center) / net.scale) @ net.dense + net.offset
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def _fit_filters(windows: np.ndarray, owner: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filters and bias by Adam on the mean of the pooled features of each document's windows (n x CHUNK + WIDTH - 1 symbols)."""
    rng = np.random.Generator(np.random.PCG64(5))
    filters = rng.normal(0, 0.3, (WIDTH, 512, FILTERS)).astype(np.float32)
    filters[:, 256:] = filters[:, :256] + rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    bias, dense, offset = np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0
    of = [np.flatnonzero(owner == d) for d in range(len(label))]
    params = [filters, bias, dense]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        docs = rng.integers(0, len(label), BATCH)
        rows = np.concatenate([of[d] for d in docs])
        doc = np.repeat(np.arange(BATCH), [len(of[d]) for d in docs])
        w = windows[rows]
        r = sum(filters[k].take(w[:, k: k + CHUNK], axis=0) for k in range(WIDTH))
        at = r.argmax(1)
        pooled = np.take_along_axis(r, at[:, None, :], 1)[:, 0] + bias
        on = np.maximum(pooled, 0)
        n = np.bincount(doc, minlength=BATCH)
        mean = np.zeros((BATCH, FILTERS), np.float32)
        np.add.at(mean, doc, on)
        mean /= n[:, None]
        error = (1 / (1 + np.exp(-(mean @ dense + offset))) - label[docs]) / BATCH
        back = (error[:, None] * dense / n[:, None])[doc] * (pooled > 0)
        g = np.zeros_like(filters)
        for k in range(WIDTH):
            np.add.at(g[k], (w[np.arange(len(rows))[:, None], at + k], np.arange(FILTERS)[None, :]), back)
        offset -= RATE * float(error.sum()) * 10
        for i, grad in enumerate((g, back.sum(0), mean.T @ error + 1e-4 * dense)):
            first[i] += 0.1 * (grad - first[i])
            second[i] += 0.01 * (grad * grad - second[i])
            params[i] -= RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return filters, bias


def _fit_dense(f: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Weighted logistic regression (Newton steps) on whole-document features."""
    center, scale = f.mean(0), f.std(0) + 1e-3
    x = np.hstack([(f - center) / scale, np.ones((len(f), 1))]).astype(np.float64)
    w, ridge = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, 1.0), 1e-6]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return center, scale, w[:-1].astype(np.float32), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Network | float:
    """Network from ``labels`` (doc_id, label 0 or 1) and the texts of ``docs`` (doc_id, text).

    ``per_class`` rows of each class, the first by a hash of the id, are fitted; each sends at most
    CHUNKS_PER_DOCUMENT windows and its features to the driver. Classes are weighted back to their
    share of all labels. With a single class, or none, the result is the constant share of label 1.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return 1.0 if 1 in counts or not counts else 0.0
    order = F.xxhash64("doc_id", F.lit("quality"))
    picked = [r for y in (0, 1) for r in known.where(F.col("label") == y).select("doc_id", "label").orderBy(order, "doc_id").limit(per_class).collect()]
    chosen = spark.createDataFrame([(r["doc_id"], r["label"]) for r in picked], "doc_id long, label int")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = scratch.write(sample, "sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, strides = symbols(*X.utf8(X.column(batch, "text")))
            first = np.cumsum(strides) - strides
            ids, out = X.column(batch, "doc_id").to_pylist(), []
            for d, a, n in zip(ids, first.tolist(), (strides - 1).tolist(), strict=True):
                rng = np.random.Generator(np.random.PCG64(d & 0x7FFFFFFF))
                row = np.concatenate([x[a * STRIDE: (a + n + 1) * STRIDE], np.zeros(WIDTH - 1, x.dtype)])
                at = np.sort(rng.choice(n, min(n, CHUNKS_PER_DOCUMENT), replace=False))
                out.append(b"".join(row[k * STRIDE: k * STRIDE + CHUNK + WIDTH - 1].tobytes() for k in at.tolist()))
            yield pa.record_batch({"doc_id": X.column(batch, "doc_id"), "label": X.column(batch, "label"), "windows": pa.array(out, pa.binary())})

    rows = sample.mapInArrow(cut, "doc_id long, label int, windows binary").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("windows").alias("windows")).orderBy("doc_id").collect()
    if len({r["label"] for r in rows}) < 2:
        return counts.get(1, 0) / sum(counts.values())
    windows = [np.frombuffer(r["windows"], dtype=np.int16).reshape(-1, CHUNK + WIDTH - 1) for r in rows]
    label = np.array([r["label"] for r in rows], dtype=np.float32)
    filters, bias = _fit_filters(np.concatenate(windows), np.repeat(np.arange(len(rows)), [len(w) for w in windows]), label)
    half = Network(filters, bias, np.zeros(1), np.ones(1), np.zeros(1), 0.0)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = features(half, *X.utf8(X.column(batch, "text")))
            yield pa.record_batch({"doc_id": X.column(batch, "doc_id"), "label": X.column(batch, "label"), "f": pa.array([r.tobytes() for r in f], pa.binary())})

    rows = sample.mapInArrow(whole, "doc_id long, label int, f binary").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("f").alias("f")).orderBy("doc_id").collect()
    f, label = np.array([np.frombuffer(r["f"], dtype=np.float32) for r in rows]), np.array([r["label"] for r in rows], dtype=np.float64)
    share = {y: counts[y] / sum(counts.values()) for y in (0, 1)}
    weight = np.array([share[int(y)] / (label == y).mean() for y in label])
    center, scale, dense, offset = _fit_dense(f, label, weight)
    scratch.drop("sample")
    return Network(filters, bias, center, scale, dense, offset)


def score(docs: DataFrame, net: Network | float, name: str = "_quality") -> DataFrame:
    """All columns of ``docs`` and, last, ``name``, the probability of label 1, from the whole text alone.

    ``docs`` needs text; all its columns are kept, so ``name`` must be none of them (``_scratch.free_name``
    gives one; a ValueError says so). Null and empty texts are scored as a document of
    padding. A very long text is convolved piece by piece and pooled as a whole. Repeated rows get
    equal scores. An empty table gives an empty result.
    """

    if free_name(docs, name) != name:
        raise ValueError(f"the table has a column {name}")

    @F.arrow_udf("double")
    def probabilities(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            if isinstance(net, float):
                yield pa.array(np.full(len(column), net))
                continue
            out, at = [], 0
            sizes = np.diff(X.utf8(column)[1])
            while at < len(column):  # runs of rows of about SEGMENT bytes
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), X.SEGMENT)))
                out.append(probability(net, features(net, *X.utf8(column.slice(at, end - at)))))
                at = end
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(name, probabilities(F.col("text")))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
