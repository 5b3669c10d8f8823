"""Listing segmentation: KMeans on the cluster, cluster quality by aggregation,
profiles, naming by centroid signature, assignment of new rows.

Feature rows are never paired with each other: every metric is a sum over
rows against the k centroids (k x dim numbers, model-sized, inlined as literals).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm._ship import ship
from staylake.operators.profile import _null_safe_join, top_value
from staylake.operators.ranks import quantiles, quantiles_wide

# Defaults of the segmentation model and the segment names.
DEFAULT_K = 3
DEFAULT_N_INIT = 10
DEFAULT_SEED = 42
SEGMENT_NAMES = {
    "standard": "Standard short-stay listings",
    "long_stay": "Long-stay standard apartments",
    "group": "Large short-stay group homes",
}
# The mart columns the segmentation model uses.
SEGMENT_CATEGORICAL = ["room_type", "property_base_group"]
SEGMENT_NUMERIC = ["accommodates", "bedrooms", "bathrooms", "beds", "amenities_count", "minimum_nights_log"]
UNKNOWN_SEGMENT = "Unknown"
#: Points compared with all centres at a time, and how far (Euclidean) a start's centres may still move when it ends.
BLOCK_POINTS, TOLERANCE = 4096, 1e-4


def _as_array(df: DataFrame, vec_col: str) -> Column:
    dtype = dict(df.dtypes)[vec_col]
    return F.col(vec_col).cast("array<double>") if dtype.startswith("array") else vector_to_array(F.col(vec_col))


def cluster_quality(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Inertia, clusters observed, Calinski-Harabasz and Davies-Bouldin for given labels.

    Two aggregate passes, no joins and no row pairs: (1) count and mean vector
    per cluster (Spark ML ``Summarizer``); (2) each row's Euclidean distance to
    its own centroid, with the k centroids inlined as a literal array (k x dim
    numbers, model-sized), summed per cluster. CH / DB then need only the k
    cluster rows. CH and DB are NULL with fewer than two clusters or when every
    row is its own cluster.
    """
    from pyspark.ml.stat import Summarizer
    spark = df.sparkSession
    arr = _as_array(df, vec_col)
    per = (df.select(F.col(label_col).alias("_k"), array_to_vector(arr).alias("_v"))
           .groupBy("_k").agg(Summarizer.mean(F.col("_v")).alias("_mean"), F.count(F.lit(1)).alias("_n")))
    rows = per.collect()  # one row per cluster
    labels = [r["_k"] for r in rows]
    means = [[float(x) for x in r["_mean"].toArray()] for r in rows]
    sizes = [int(r["_n"]) for r in rows]
    pos = {lab: i for i, lab in enumerate(labels)}
    cents = F.array(*[F.array(*[F.lit(v) for v in m]) for m in means])
    idx = F.create_map(*[x for lab, i in pos.items() for x in (F.lit(lab), F.lit(i + 1))])
    own = F.element_at(cents, F.element_at(idx, F.col(label_col)))
    d2 = F.aggregate(F.zip_with(arr, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    within = (df.select(F.col(label_col).alias("_k"), d2.alias("_d2"))
              .groupBy("_k").agg(F.sum("_d2").alias("_w"), F.avg(F.sqrt("_d2")).alias("_s"))).collect()
    w_by = {r["_k"]: r["_w"] for r in within}
    s_by = {r["_k"]: r["_s"] for r in within}
    k, n = len(labels), sum(sizes)
    inertia = float(sum(w_by.values())) if w_by else None
    ch = db = None
    if 2 <= k < n:
        dim = len(means[0])
        g = [sum(sizes[i] * means[i][j] for i in range(k)) / n for j in range(dim)]
        between = sum(sizes[i] * sum((means[i][j] - g[j]) ** 2 for j in range(dim)) for i in range(k))
        ch = (between / (k - 1)) / (inertia / (n - k)) if inertia else None
        ratios = []
        for a in range(k):
            best = None
            for b in range(k):
                if a == b:
                    continue
                m = sum((means[a][j] - means[b][j]) ** 2 for j in range(dim)) ** 0.5
                r = (s_by[labels[a]] + s_by[labels[b]]) / m if m else float("inf")
                best = r if best is None else max(best, r)
            ratios.append(best)
        db = sum(ratios) / k
    return spark.createDataFrame([(inertia, k, ch, db)],
                                 "inertia double, clusters_observed bigint, calinski_harabasz double, davies_bouldin double")


def silhouette(df: DataFrame, features_col: str, prediction_col: str, distance: str = "squaredEuclidean") -> float:
    """Spark's distributed silhouette (squared Euclidean or cosine): O(n k), no row pairs.

    Exact plain-Euclidean silhouette needs every row pair and is not offered.
    """
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col, distanceMeasure=distance,
                             metricName="silhouette")
    return ev.evaluate(df)


# ---------------------------------------------------------------- fitting and assignment

def as_vector(df: DataFrame, cols: Sequence[str] | str, out: str = "features") -> DataFrame:
    if isinstance(cols, str):
        return df.withColumn(out, array_to_vector(F.col(cols).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def _pack(df: DataFrame, features_col: str) -> DataFrame:
    """The vectors as rows of packed doubles, at least BLOCK_POINTS in all rows but a task's last: n, points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([b"".join(held)], pa.binary())], ["n", "points"])

        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).tobytes())
            n += batch.num_rows
            if n >= BLOCK_POINTS:
                yield row()
                held, n = [], 0
        if n:
            yield row()

    ship(df.sparkSession)
    return df.select(_as_array(df, features_col).alias("v")).mapInArrow(run, "n int, points binary")


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The packed points, a column each, at most BLOCK_POINTS at a time."""
    for batch in batches:
        for n, blob in zip(batch.column("n").to_pylist(), batch.column("points"), strict=True):
            points = np.frombuffer(blob.as_buffer(), dtype=np.float64).reshape(n, -1)
            for at in range(0, n, BLOCK_POINTS):
                yield np.ascontiguousarray(points[at:at + BLOCK_POINTS].T)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per start the nearest of its centres (start, k, dim) to every point, and the squared distance, by differences."""
    starts, k, dim = centres.shape
    shift = centres.mean(axis=(0, 1))  # products of small numbers keep their digits
    x, centres = x - shift[:, None], centres - shift
    score = (centres ** 2).sum(axis=2)[:, :, None] - 2 * (centres.reshape(-1, dim) @ x).reshape(starts, k, -1)
    best, low = np.zeros((starts, x.shape[1]), dtype=np.int32), score[:, 0].copy()
    for j in range(1, k):
        np.copyto(best, j, where=score[:, j] < low)
        np.minimum(low, score[:, j], out=low)
    return best, np.stack([((x - c.T.take(b, axis=1)) ** 2).sum(axis=0) for c, b in zip(centres, best, strict=True)])


def _seed_starts(blocks: DataFrame, k: int, seeds: Sequence[int]) -> np.ndarray:
    """Centres of every start by k-means++: one pass over the points for each centre, for all starts together.

    A point is drawn with a probability in proportion to its squared distance to the start's centres so far: the
    smallest of exponential variables divided by these. With fewer different points than k there are fewer centres."""
    spark, centres = blocks.sparkSession, None
    for step in range(k):
        chosen = centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rngs = [np.random.default_rng([s, step, TaskContext.get().partitionId()]) for s in seeds]
            keys, picks = [np.inf] * len(seeds), [b""] * len(seeds)
            for x in _points(batches):
                weight = np.ones((len(seeds), x.shape[1])) if chosen is None else _nearest(x, chosen)[1]
                for i, rng in enumerate(rngs):
                    with np.errstate(divide="ignore"):
                        key = rng.standard_exponential(x.shape[1]) / weight[i]
                    at = int(key.argmin())
                    if key[at] < keys[i]:
                        keys[i], picks[i] = float(key[at]), x[:, at].tobytes()
            some = [i for i, v in enumerate(keys) if v < np.inf]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([keys[i] for i in some], pa.float64()),
                                              pa.array([picks[i] for i in some], pa.binary())], ["start", "key", "point"])

        drawn = blocks.mapInArrow(run, "start int, key double, point binary").groupBy("start").agg(F.min_by("point", F.struct("key", "point")).alias("point"))
        rows = {r["start"]: np.frombuffer(r["point"]) for r in drawn.collect()}  # one row per start
        if len(rows) < len(seeds):
            break  # no point is apart from the centres, for every start alike
        found = np.stack([rows[i] for i in range(len(seeds))])[:, None, :]
        centres = found if centres is None else np.concatenate([centres, found], axis=1)
    if centres is None:
        raise ValueError("k-means needs at least one point")
    return centres


def _sums(blocks: DataFrame, centres: np.ndarray) -> np.ndarray:
    """(start, cluster, 2 + dim): points, cost and coordinate sums of every cluster of every start, in one pass."""
    starts, k, dim = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts, k, 2 + dim))
        for x in _points(batches):
            best, low = _nearest(x, centres)
            for i in range(starts):
                member = (best[i] == np.arange(k)[:, None]).astype(np.float64)
                total[i] += member @ np.vstack([np.ones(x.shape[1]), low[i], x]).T
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["place", "total"])

    sums = blocks.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    out = np.zeros(starts * k * (2 + dim))
    for r in sums.collect():  # starts x k x (dim + 2) numbers
        out[r["place"]] = r["total"]
    return out.reshape(starts, k, 2 + dim)


def _fit_starts(blocks: DataFrame, k: int, n_init: int, seed: int, max_iter: int) -> tuple[np.ndarray, float]:
    """(centres, cost) of the best of ``n_init`` starts. A pass over the points serves all starts that still move."""
    centres = _seed_starts(blocks, k, [seed + i for i in range(n_init)])
    moving = np.arange(n_init)
    for _ in range(max_iter):
        sums = _sums(blocks, centres[moving])
        count, old = sums[:, :, :1], centres[moving]
        new = np.where(count > 0, sums[:, :, 2:] / np.maximum(count, 1), old)  # an empty cluster keeps its centre
        centres[moving] = new
        moving = moving[(((new - old) ** 2).sum(axis=2) > TOLERANCE ** 2).any(axis=1)]
        if not len(moving):
            break
    costs = _sums(blocks, centres)[:, :, 1].sum(axis=1)
    best = int(costs.argmin())  # ties: the first seed
    return centres[best], float(costs[best])


def _with_blocks(df: DataFrame, features_col: str, use):
    """``use`` of the packed points, which are cached once for all passes and released afterwards."""
    blocks = _pack(df, features_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return use(blocks)
    finally:
        blocks.unpersist()


def fit_kmeans(df: DataFrame, k: int = DEFAULT_K, n_init: int = DEFAULT_N_INIT, seed: int = DEFAULT_SEED,
               features_col: str = "features", max_iter: int = 50) -> KMeansModel:
    """Best of ``n_init`` seeded k-means++ runs by training cost (ties: the first seed).

    The points are packed and cached once; every pass over them moves the centres of all starts, so the passes do not
    grow with ``n_init`` and nothing is kept per start and point. The model is Spark's: its ``KMeans`` is given the
    centres as its k points, so its summary is of them and not of ``df``."""
    centres, _ = _with_blocks(df, features_col, lambda blocks: _fit_starts(blocks, k, n_init, seed, max_iter))
    rows = as_vector(df.sparkSession.createDataFrame([(c.tolist(),) for c in centres], "c array<double>"), "c", features_col)
    return KMeans(k=k, seed=seed, featuresCol=features_col, initMode="random", maxIter=1).fit(rows)


def elbow(df: DataFrame, ks: Sequence[int], seed: int = DEFAULT_SEED, features_col: str = "features",
          n_init: int = 1, max_iter: int = 50) -> DataFrame:
    """k -> inertia table: the best of ``n_init`` starts per k, on points packed and cached once for all k."""
    rows = _with_blocks(df, features_col, lambda blocks: [(int(k), _fit_starts(blocks, k, n_init, seed, max_iter)[1]) for k in ks])
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def centroid_table(model: KMeansModel, names: Sequence[str] | None = None) -> DataFrame:
    """Centroids (k rows) with feature names (``f0..`` when not given)."""
    centers = model.clusterCenters()
    names = list(names) if names else [f"f{i}" for i in range(len(centers[0]))]
    spark = model.summary.predictions.sparkSession if model.hasSummary else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, ["cluster_id"] + names)


def assign(model: KMeansModel, df: DataFrame, features_col: str = "features") -> DataFrame:
    """Cluster id and Euclidean distance to the assigned centroid, per row.

    The k centroids travel inside the expression as a literal array (k x dim
    numbers), so scoring is a narrow map with no join."""
    centers = model.clusterCenters()
    lit_centers = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
    scored = model.setFeaturesCol(features_col).setPredictionCol("cluster_id").transform(df)
    arr = vector_to_array(F.col(features_col))
    own = F.element_at(lit_centers, F.col("cluster_id") + 1)
    dist = F.sqrt(F.aggregate(F.zip_with(arr, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))
    return scored.withColumn("cluster_id", F.col("cluster_id").cast("int")).withColumn("distance_to_centroid", dist)


def name_segments(centers: DataFrame, accommodates: str, min_nights_log: str) -> DataFrame:
    """Name clusters from their centroid signature instead of raw ids: the
    largest ``accommodates`` centroid is the group segment; of the rest, the
    largest ``minimum_nights_log`` is long-stay; the remainder standard."""
    pdf = centers.toPandas()  # k rows
    order_acc = pdf.sort_values([accommodates, "cluster_id"], ascending=[False, True])
    group_id = int(order_acc.iloc[0]["cluster_id"])
    rest = pdf[pdf["cluster_id"] != group_id].sort_values([min_nights_log, "cluster_id"], ascending=[False, True])
    mapping = {group_id: SEGMENT_NAMES["group"]}
    if len(rest):
        mapping[int(rest.iloc[0]["cluster_id"])] = SEGMENT_NAMES["long_stay"]
    for cid in rest["cluster_id"].iloc[1:]:
        mapping[int(cid)] = SEGMENT_NAMES["standard"]
    spark = centers.sparkSession
    return spark.createDataFrame(sorted(mapping.items()), "cluster_id int, cluster_name string")


def attach_names(assigned: DataFrame, names: DataFrame) -> DataFrame:
    """Map join (k rows, broadcast); unmapped ids -> 'Unknown'."""
    j = assigned.join(F.broadcast(names), "cluster_id", "left")
    return j.withColumn("cluster_name", F.coalesce(F.col("cluster_name"), F.lit(UNKNOWN_SEGMENT)))


def pca_2d(df: DataFrame, features_col: str = "features", k: int = 2) -> DataFrame:
    """Project mean-centred features on the first k principal components."""
    from pyspark.ml.feature import StandardScaler
    centred = StandardScaler(withMean=True, withStd=False, inputCol=features_col, outputCol="_c").fit(df).transform(df)
    model = PCA(k=k, inputCol="_c", outputCol="_pc").fit(centred)
    out = model.transform(centred).withColumn("_pa", vector_to_array("_pc"))
    return out.select(*[c for c in df.columns if c != features_col],
                      *[F.col("_pa")[i].alias(f"pc{i + 1}") for i in range(k)])


def feature_pipeline(categorical=SEGMENT_CATEGORICAL, numeric=SEGMENT_NUMERIC):
    """One-hot categories (unseen -> zeros) + standardised numerics -> ``features``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from staylake.ml.prep import FillAndScale
    stages = [StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__idx" for c in categorical],
                            handleInvalid="keep", stringOrderType="alphabetAsc")]
    stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                                outputCols=[f"{c}__oh" for c in categorical], dropLast=True))
    stages.append(FillAndScale(inputCols=list(numeric), fill=False))
    stages.append(VectorAssembler(inputCols=[f"{c}__oh" for c in categorical] + [f"{c}__imp" for c in numeric],
                                  outputCol="features", handleInvalid="error"))
    return Pipeline(stages=stages)


def fit_segmentation(mart: DataFrame, k: int = DEFAULT_K, n_init: int = DEFAULT_N_INIT, seed: int = DEFAULT_SEED,
                     categorical=SEGMENT_CATEGORICAL, numeric=SEGMENT_NUMERIC):
    """Fit features once, k-means ``n_init`` times on the cached feature vectors;
    returns one PipelineModel (features + best k-means) for persistence / scoring."""
    from pyspark.ml import PipelineModel
    feats = feature_pipeline(categorical, numeric).fit(mart)
    vectors = feats.transform(mart).select("features")
    best = fit_kmeans(vectors, k, n_init, seed)
    return PipelineModel(stages=list(feats.stages) + [best])


def feature_names(model, numeric=SEGMENT_NUMERIC) -> list[str]:
    """Names of the feature vector's slots: ``column=value`` for one-hot slots, then the scaled numeric columns."""
    indexer = model.stages[0]
    slots = [f"{c.removesuffix('__idx')}={v}" for c, values in zip(indexer.getOutputCols(), indexer.labelsArray) for v in values]
    return slots + list(numeric)


def segment_assign(model, mart: DataFrame) -> DataFrame:
    """Apply the fitted feature stages then the k-means stage with distances."""
    from pyspark.ml import PipelineModel
    feats = PipelineModel(stages=model.stages[:-1])
    return assign(model.stages[-1], feats.transform(mart))


def centroid_signature(model, mart: DataFrame, accommodates: str = "accommodates",
                       min_nights_log: str = "minimum_nights_log") -> DataFrame:
    """Per cluster means of the naming features in original units (k rows)."""
    a = segment_assign(model, mart)
    return a.groupBy("cluster_id").agg(F.avg(accommodates).alias(accommodates), F.avg(min_nights_log).alias(min_nights_log))


# ---------------------------------------------------------------- profiles

def segment_profile(df: DataFrame, cluster_col: str, price_col: str, feature_cols: Sequence[str],
                    category_cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Per cluster: count, share of all rows, mean / exact median price, feature
    means and the dominant value of each category column (ties -> smallest)."""
    base = df.groupBy(cluster_col).agg(
        F.count(F.lit(1)).alias("listing_count"), F.avg(price_col).alias("avg_price"),
        *[F.avg(c).alias(f"avg_{c}") for c in feature_cols])
    total = base.agg(F.sum("listing_count").alias("_total"))
    base = base.crossJoin(F.broadcast(total)).withColumn("listing_share", F.col("listing_count") / F.col("_total")).drop("_total")
    med = quantiles(df, price_col, [0.5], [cluster_col], ["median_price"], approx=approx)
    out = _null_safe_join(base, med, [cluster_col])
    for c in category_cols:
        top = top_value(df, c, [cluster_col]).select(cluster_col, F.col("top").alias(f"dominant_{c}"))
        out = _null_safe_join(out, top, [cluster_col], "left")
    return out


def segment_price_summary(df: DataFrame, cluster_col: str, price_col: str, approx: bool = False) -> DataFrame:
    """p25 / median / p75 / mean price per segment (exact, skew-safe)."""
    q = quantiles(df, price_col, [0.25, 0.5, 0.75], [cluster_col], ["p25", "median", "p75"], approx=approx)
    m = df.groupBy(cluster_col).agg(F.avg(price_col).alias("mean"), F.count(F.lit(1)).alias("n"))
    return _null_safe_join(q, m, [cluster_col])


def segment_centre(df: DataFrame, cluster_col: str, coordinates: Sequence[str]) -> DataFrame:
    """The median of each coordinate per cluster (exact, all coordinates in one pass): a centre that outliers do not
    move. NULL and NaN coordinates are skipped; a cluster without any has a NULL centre."""
    centres = quantiles_wide(df, coordinates, [0.5], [cluster_col], ["median"])
    clusters = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n"))
    return _null_safe_join(clusters, centres, [cluster_col], "left")


def segmentation_check(assignments: DataFrame, k: int, key: str = "listing_id") -> DataFrame:
    """One row: rows, duplicate keys, ids outside 0..k-1, NULL names, versions, passed."""
    r = assignments.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(~F.col("cluster_id").between(0, k - 1) | F.col("cluster_id").isNull()).alias("bad_cluster_ids"),
        F.count_if(F.col("cluster_name").isNull()).alias("null_names"),
        F.count_distinct("model_version").alias("versions"))
    return r.withColumn("passed", (F.col("rows") > 0) & (F.col("duplicate_keys") == 0) & (F.col("null_keys") == 0)
                        & (F.col("bad_cluster_ids") == 0) & (F.col("null_names") == 0) & (F.col("versions") == 1))
