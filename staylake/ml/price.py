"""Price regression on log1p(price) with Spark ML, fitted and scored on the cluster.

Preprocessing lives inside the ``Pipeline`` so that every statistic (medians,
category vocabularies, scaling) is fitted on training rows only and travels
with the saved model: median imputation, a missing-indicator for the
natively-missing review score (Spark trees have no missing branch), 'Unknown'
for missing categories, alphabetical indexing with an unseen slot, one-hot
without that slot, scaling of the numeric block, then the regressor.
"""

from __future__ import annotations

import ast
import math
import random
import statistics
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, Sequence

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.cleaning import is_finite
from staylake.ml import boost
from staylake.ml.prep import (MIN_FREQUENCY, UNKNOWN_LABEL, FillAndScale, InfrequentBucketer, MostFrequentFill, hash_split,
                             kfold_assign, spread)
from staylake.operators.errors import regression_metrics
from staylake.operators.ranks import quantiles, stacked_counts

# The selected feature set and its roles.
SELECTED_FEATURES = (
    "neighbourhood", "bedrooms", "room_type", "property_base_group", "host_response_time",
    "bathrooms", "accommodates", "review_scores_location", "host_response_rate",
    "host_listings_count", "calculated_host_listings_count", "host_total_listings_count",
    "host_acceptance_rate", "number_of_reviews_ltm", "minimum_nights",
)
NUMERIC_FEATURES = {"bedrooms", "bathrooms", "accommodates", "host_response_rate", "host_listings_count",
                    "calculated_host_listings_count", "host_total_listings_count", "host_acceptance_rate",
                    "number_of_reviews_ltm", "minimum_nights"}
CATEGORICAL_FEATURES = {"neighbourhood", "room_type", "property_base_group", "host_response_time"}
NATIVE_MISSING_FEATURES = {"review_scores_location"}
TARGET = "log_price"


@dataclass
class PriceConfig:
    features: Sequence[str] = SELECTED_FEATURES
    target: str = TARGET
    key: str = "listing_id"
    algorithm: str = "gbt"
    params: dict = field(default_factory=lambda: {"maxDepth": 5, "maxIter": 40, "stepSize": 0.1, "subsamplingRate": 0.8})
    seed: int = 42
    test_percent: int = 20
    n_folds: int = 5
    parallel_folds: int = 5


ROLE_OF = {c: role for role, names in (("numeric", NUMERIC_FEATURES), ("category", CATEGORICAL_FEATURES),
                                      ("native", NATIVE_MISSING_FEATURES)) for c in names}


def roles(features: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """(numeric, categorical, natively missing) features in name order; names without a role are left out."""
    by_role: dict[str, list[str]] = {"numeric": [], "category": [], "native": []}
    for name in sorted(set(features)):
        if name in ROLE_OF:
            by_role[ROLE_OF[name]].append(name)
    return by_role["numeric"], by_role["category"], by_role["native"]


def regressor(algorithm: str, target: str, params: dict | None = None, seed: int = 42):
    params = dict(params or {})
    if algorithm == "gbt":
        return GBTRegressor(labelCol=target, featuresCol="features", seed=seed, **params)
    if algorithm == "rf":
        return RandomForestRegressor(labelCol=target, featuresCol="features", seed=seed, **params)
    if algorithm == "linear":
        return LinearRegression(labelCol=target, featuresCol="features", elasticNetParam=0.0, **params)
    raise ValueError(f"unknown algorithm {algorithm}")


def build_pipeline(features: Sequence[str], target: str = TARGET, algorithm: str = "gbt", params: dict | None = None,
                   seed: int = 42, min_frequency: int | None = MIN_FREQUENCY, category_fill: str = "unknown") -> Pipeline:
    """``category_fill``: a missing category is 'Unknown', or (``most_frequent``) the training rows' most frequent one."""
    if category_fill not in ("unknown", "most_frequent"):
        raise ValueError("category_fill must be 'unknown' or 'most_frequent'")
    numeric, categorical, native = roles(features)
    stages = []
    source = {c: c for c in categorical}
    if categorical and category_fill == "most_frequent":
        stages.append(MostFrequentFill(inputCols=categorical))
        source = {c: f"{c}__filled" for c in categorical}
    fills = [f"coalesce(CAST({source[c]} AS STRING), '{UNKNOWN_LABEL}') AS {c}__cat" for c in categorical]
    flags = [f"CAST({c} IS NULL AS DOUBLE) AS {c}__missing" for c in native]
    stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
        [f"CAST({c} AS DOUBLE) AS {c}__num" for c in numeric + native] + fills + flags) + " FROM __THIS__"))
    num_cols = [f"{c}__num" for c in numeric + native]
    if num_cols:
        stages.append(FillAndScale(inputCols=num_cols))
        stages.append(VectorAssembler(inputCols=[f"{c}__imp" for c in num_cols], outputCol="_num_scaled"))
    if categorical and min_frequency:
        stages.append(InfrequentBucketer(inputCols=[f"{c}__cat" for c in categorical], minFrequency=min_frequency))
    if categorical:
        # one multi-column indexer: every vocabulary from a single pass over the training rows
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in categorical],
                                    outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                                    outputCols=[f"{c}__oh" for c in categorical], dropLast=True))
    parts = (["_num_scaled"] if num_cols else []) + [f"{c}__oh" for c in categorical] + [f"{c}__missing" for c in native]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    stages.append(regressor(algorithm, target, params, seed))
    return Pipeline(stages=stages)


@dataclass
class Prepared:
    """Feature stages fitted once per fold on its training rows, for a study that fits many models on the same folds.

    A column's statistics do not depend on the model or on the other columns, so fits on any of ``features`` share them."""
    features: Sequence[str]
    by_fold: dict[int, PipelineModel] = field(default_factory=dict)

    def stages(self, train: DataFrame, fold: int) -> PipelineModel:
        """The fold's feature stages, without assemblers."""
        if fold not in self.by_fold:
            shared = build_pipeline(self.features).getStages()[:-1]
            self.by_fold[fold] = Pipeline(stages=[s for s in shared if not isinstance(s, VectorAssembler)]).fit(train)
        return self.by_fold[fold]

    def fit(self, pipeline: Pipeline, train: DataFrame, fold: int) -> PipelineModel:
        """``pipeline`` fitted on ``train``: the fold's feature stages, then the pipeline's own assemblers and regressor."""
        *stages, regression = pipeline.getStages()
        features = PipelineModel(stages=self.stages(train, fold).stages + [s for s in stages if isinstance(s, VectorAssembler)])
        return PipelineModel(stages=features.stages + [regression.fit(features.transform(train))])


def predict(model: PipelineModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    """Adds predicted_log_price and predicted_price = max(expm1(log), 0)."""
    out = model.transform(df).withColumnRenamed("prediction", "predicted_log_price")
    out = out.withColumn("predicted_price", F.greatest(F.expm1("predicted_log_price"), F.lit(0.0)))
    keep = list(df.columns) + ["predicted_log_price", "predicted_price"]
    return out.select(*keep)


def check_predictions(pred: DataFrame, key: str = "listing_id") -> DataFrame:
    """One-row batch prediction check: finite, non-negative, one row per key."""
    return pred.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_finite("predicted_price")).alias("non_finite"),
        F.count_if(F.col("predicted_price") < 0).alias("negative"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"))


def train_evaluate(df: DataFrame, cfg: PriceConfig,
                   split: DataFrame | None = None) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Hash hold-out split, fit on train, evaluate on test.

    Returns (model, metrics one row, test predictions). The frame is spread and cached once
    for the iterative fit; a job that consumes the results passes ``split``
    (``hash_split`` output it cached itself) and releases it when done."""
    split = split if split is not None else hash_split(spread(df, cfg.key), cfg.key, cfg.test_percent).cache()
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    model = build_pipeline(cfg.features, cfg.target, cfg.algorithm, cfg.params, cfg.seed).fit(train)
    pred = predict(model, test, cfg.target)
    metrics = regression_metrics(pred, cfg.target, "predicted_log_price", model.stages[-1].numFeatures)
    return model, metrics, pred


def _used(df: DataFrame, cfg: PriceConfig, features: Sequence[str] | None = None) -> DataFrame:
    """The columns that a fit and its score use."""
    used = {cfg.key, cfg.target, *(features or cfg.features)}
    return df.select(*[c for c in df.columns if c in used])


def cached_folds(df: DataFrame, cfg: PriceConfig, features: Sequence[str] | None = None) -> DataFrame:
    """``kfold_assign`` of the columns used, spread and cached; the caller releases it."""
    return kfold_assign(spread(_used(df, cfg, features), cfg.key), cfg.key, cfg.n_folds).cache()


def cross_validate(df: DataFrame, cfg: PriceConfig, algorithm: str | None = None, params: dict | None = None,
                   features: Sequence[str] | None = None, folds: DataFrame | None = None,
                   prepared: Prepared | None = None) -> tuple[DataFrame, DataFrame]:
    """K-fold CV on the given (training) rows with preprocessing fitted per fold.

    Returns (per-fold metrics with fit and predict seconds, out-of-fold predictions). Folds are fitted by
    ``cfg.parallel_folds`` driver threads over one cached table, each in its own scheduler pool. A fold whose
    data cannot be fitted is recorded with status 'failed'; if none can, it raises. Studies that
    run many CVs pass ``folds`` (``kfold_assign`` output, cached once by the
    caller and released when the study ends) so the training rows are held
    once, not once per trial, and ``prepared``, so that a fold's preprocessing is
    fitted once."""
    folds = folds if folds is not None else cached_folds(df, cfg, features)
    results = fit_folds(folds, cfg, range(cfg.n_folds), algorithm, params, features, prepared)
    preds = [p for _, p, _ in results if p is not None]
    if not preds:
        raise RuntimeError("no fold could be fitted: " + "; ".join(why for _, _, why in results))
    metrics = folds.sparkSession.createDataFrame([row for row, _, _ in results], FOLD_METRICS)
    return metrics, reduce(lambda a, b: a.unionByName(b), preds)


FOLD_METRICS = ("fold int, n bigint, rmse double, mae double, r2 double, adjusted_r2 double, fit_seconds double, "
                "predict_seconds double, status string")


def fit_fold(folds: DataFrame, cfg: PriceConfig, k: int, algorithm: str | None = None, params: dict | None = None,
             features: Sequence[str] | None = None, prepared: Prepared | None = None) -> tuple[tuple, DataFrame | None, str]:
    """Fit on every fold but ``k``, score fold ``k``: (``FOLD_METRICS`` row, predictions, why it failed)."""
    spark, algorithm = folds.sparkSession, algorithm or cfg.algorithm
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{k}")
    train, valid = folds.where(F.col("fold") != k), folds.where(F.col("fold") == k)
    started = time.perf_counter()
    try:
        if algorithm == "median":
            pred, width = median_baseline(train, valid, cfg.target), 0
        else:
            pipeline = build_pipeline(list(features or cfg.features), cfg.target, algorithm, cfg.params if params is None else params, cfg.seed)
            model = prepared.fit(pipeline, train, k) if prepared else pipeline.fit(train)
            pred, width = predict(model, valid, cfg.target), model.stages[-1].numFeatures
        fitted = time.perf_counter()
        m = regression_metrics(pred, cfg.target, "predicted_log_price", width).first()
    except (IllegalArgumentException, AnalysisException) as e:  # what a fold's data can cause; anything else ends the study
        return (k + 1, 0, None, None, None, None, None, None, "failed"), None, f"fold {k + 1}: {e}"
    row = (k + 1, m["n"], m["rmse"], m["mae"], m["r2"], m["adjusted_r2"], fitted - started, time.perf_counter() - fitted, "ok")
    return row, pred.select(cfg.key, F.lit(k + 1).alias("fold"), cfg.target, "predicted_log_price"), ""


def fit_folds(folds: DataFrame, cfg: PriceConfig, ks: Sequence[int], algorithm: str | None = None,
              params: dict | None = None, features: Sequence[str] | None = None,
              prepared: Prepared | None = None) -> list[tuple[tuple, DataFrame | None, str]]:
    """``fit_fold`` for each fold of ``ks``, several at a time."""
    inherit = inheritable_thread_target(folds.sparkSession)
    with ThreadPoolExecutor(max_workers=max(1, min(cfg.parallel_folds, len(ks)))) as pool:
        waiting = [pool.submit(inherit(lambda k=k: fit_fold(folds, cfg, k, algorithm, params, features, prepared))) for k in ks]
        return [w.result() for w in waiting]


def cv_summary(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and sample std of the fold metrics that ``metrics`` has, mean seconds; successful folds only, best first."""
    ok = metrics.where(F.col("status") == "ok")
    shown = [m for m in ("rmse", "mae", "r2", "adjusted_r2") if m in metrics.columns]
    return ok.groupBy(*by).agg(*[F.avg(m).alias(f"{m}_mean") for m in shown],
                               *[F.stddev_samp(m).alias(f"{m}_std") for m in shown],
                               *[F.avg(m).alias(f"{m}_mean") for m in ("fit_seconds", "predict_seconds") if m in metrics.columns],
                               F.count(F.lit(1)).alias("folds")).orderBy("rmse_mean", "mae_mean")


def median_baseline(train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """Dummy model: predict the training median of the target (exact, one-row broadcast)."""
    med = quantiles(train, target, [0.5], [], ["predicted_log_price"])
    return test.crossJoin(F.broadcast(med))


def baselines(df: DataFrame, cfg: PriceConfig, algorithms: Sequence[str] = ("median", "linear", "rf", "gbt"),
              params: dict | None = None) -> DataFrame:
    """Hold-out RMSE / MAE / R^2 per baseline family."""
    split = hash_split(spread(_used(df, cfg), cfg.key), cfg.key, cfg.test_percent).cache()
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    rows = []
    for algo in algorithms:
        if algo == "median":
            pred = median_baseline(train, test, cfg.target)
        else:
            p = (params or {}).get(algo, {"maxIter": 20} if algo == "gbt" else ({"numTrees": 30} if algo == "rf" else {}))
            pred = predict(build_pipeline(cfg.features, cfg.target, algo, p, cfg.seed).fit(train), test, cfg.target)
        rows.append(regression_metrics(pred, cfg.target, "predicted_log_price", 0)
                    .select(F.lit(algo).alias("model"), "n", "rmse", "mae", "r2"))
    table = reduce(lambda a, b: a.unionByName(b), rows)
    # one metric row per family is materialised, then the cached split is released
    out = df.sparkSession.createDataFrame(table.collect(), table.schema)
    split.unpersist()
    return out


def baselines_cv(df: DataFrame, cfg: PriceConfig, algorithms: Sequence[str] = ("median", "linear", "rf", "gbt"),
                 params: dict[str, dict] | None = None) -> DataFrame:
    """Baseline families ranked by k-fold CV on the same cached folds: ``cv_summary`` per model and its rank."""
    folds = cached_folds(df, cfg)
    rows, failures = [], []
    try:
        for algo in algorithms:
            results = fit_folds(folds, cfg, range(cfg.n_folds), algo, (params or {}).get(algo, cfg.params if algo == "gbt" else {}))
            rows += [(algo, *row) for row, _, _ in results]
            failures += [f"{algo}: {why}" for _, _, why in results if why]
    finally:
        folds.unpersist()
    if all(r[-1] == "failed" for r in rows):
        raise RuntimeError("no baseline could be fitted: " + "; ".join(failures))
    ranked = cv_summary(df.sparkSession.createDataFrame(rows, "model string, " + FOLD_METRICS)).collect()  # one row per family
    return df.sparkSession.createDataFrame([(i + 1, *r) for i, r in enumerate(ranked)], "rank int, model string, " + ", ".join(
        f"{c} {'bigint' if c == 'folds' else 'double'}" for c in ranked[0].asDict() if c != "model"))


# The searched ranges of the boosted trees: (scale, low, high), or a list of choices.
SEARCH_SPACE: dict[str, Any] = {
    "stepSize": ("log", 0.01, 0.15), "maxDepth": ("int", 3, 10), "minInstancesPerNode": ("int", 1, 15),
    "subsamplingRate": ("float", 0.6, 1.0), "minInfoGain": ("float", 0.0, 0.05), "maxIter": [20, 40, 80],
}
TRIAL_COLUMNS = "trial int, state string, folds int, params string, cv_rmse double, cv_rmse_std double, last_rmse double"


def draw(rng: random.Random, how: Any) -> Any:
    """One value of a search range."""
    if not isinstance(how, tuple):
        return rng.choice(list(how))
    scale, low, high = how
    if scale == "int":
        return rng.randint(low, high)
    if scale == "float":
        return rng.uniform(low, high)
    if scale == "log":
        return math.exp(rng.uniform(math.log(low), math.log(high)))
    raise ValueError(f"unknown scale {scale!r}")


def random_search(df: DataFrame, cfg: PriceConfig, space: dict[str, Any] = SEARCH_SPACE, n_trials: int = 10,
                  startup_trials: int = 5, warmup_folds: int = 2) -> DataFrame:
    """Seeded study scored by train-only CV RMSE, with early stopping; one row per trial.

    A trial reports the mean RMSE of its folds so far after each fold from ``warmup_folds`` on. It is stopped
    (PRUNED) when that is worse than the median of what the complete trials reported after the same fold, once
    ``startup_trials`` are complete; startup trials and warm-up folds run their folds side by side. A trial
    with a failed fold is FAIL. ``cv_rmse`` is NULL unless COMPLETE; ``last_rmse`` is the last report."""
    rng = random.Random(cfg.seed)
    rows, reports = [], []  # reports: per complete trial its mean after 1, 2, ... folds
    folds, prepared = cached_folds(df, cfg), Prepared(cfg.features)
    try:
        for t in range(n_trials):
            params = {k: draw(rng, v) for k, v in space.items()}
            at_once = cfg.n_folds if len(reports) < startup_trials else max(1, min(warmup_folds, cfg.n_folds))
            scores, state, done = [], "COMPLETE", 0
            while done < cfg.n_folds:
                batch = fit_folds(folds, cfg, range(done, done + (1 if done else at_once)), params=params, prepared=prepared)
                done += len(batch)
                if any(why for _, _, why in batch):
                    state = "FAIL"
                    break
                scores += [row[2] for row, _, _ in batch]
                if done < cfg.n_folds and statistics.fmean(scores) > statistics.median(r[done - 1] for r in reports):
                    state = "PRUNED"
                    break
            if state == "COMPLETE":
                reports.append([statistics.fmean(scores[:i + 1]) for i in range(len(scores))])
            whole = state == "COMPLETE"
            rows.append((t, state, done, str(sorted(params.items())), statistics.fmean(scores) if whole else None,
                         statistics.stdev(scores) if whole and len(scores) > 1 else None,
                         statistics.fmean(scores) if scores else None))
    finally:
        folds.unpersist()
    out = df.sparkSession.createDataFrame(rows, TRIAL_COLUMNS)
    return running_best(out.withColumn("study", F.lit("price")), "study", "trial", "cv_rmse")


def best_params(trials: DataFrame) -> dict:
    """Parameters of the complete trial with the lowest CV RMSE."""
    best = trials.where((F.col("state") == "COMPLETE") & F.col("cv_rmse").isNotNull()).orderBy("cv_rmse", "trial").first()
    if best is None:
        raise RuntimeError("no trial is complete")
    return dict(ast.literal_eval(best["params"]))


def running_best(trials: DataFrame, study: str, order: str | Sequence[str], metric: str) -> DataFrame:
    """Cumulative minimum of a metric per study (one window partition per study)."""
    from pyspark.sql import Window
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(study).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.withColumn("best_so_far", F.min(metric).over(w))


def price_training_check(predictions: DataFrame, metrics: DataFrame, key: str = "listing_id") -> DataFrame:
    """One row: finite RMSE, non-empty, finite non-negative predictions, keys present, one version."""
    m = metrics.select(F.col("rmse").alias("_rmse"))
    p = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_finite("predicted_log_price") | ~is_finite("predicted_price")).alias("non_finite"),
        F.count_if(F.col("predicted_price") < 0).alias("negative"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        (F.count_distinct("model_version") if "model_version" in predictions.columns else F.lit(1)).alias("versions"))
    j = p.crossJoin(m)
    return j.withColumn("passed", is_finite("_rmse") & (F.col("rows") > 0) & (F.col("non_finite") == 0)
                        & (F.col("negative") == 0) & (F.col("null_keys") == 0) & (F.col("versions") == 1)) \
            .withColumnRenamed("_rmse", "rmse")


def evaluate_model(model: PipelineModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    """Score an existing model on labelled rows and return the metric row."""
    return regression_metrics(predict(model, df, target), target, "predicted_log_price", model.stages[-1].numFeatures)


def refit_best(df: DataFrame, cfg: PriceConfig, trials: DataFrame) -> tuple[PipelineModel, PriceConfig]:
    """Refit on all given rows with the best trial's parameters: (model, its configuration)."""
    best = replace(cfg, params=best_params(trials))
    return build_pipeline(best.features, best.target, best.algorithm, best.params, best.seed).fit(df), best


def feature_selection(df: DataFrame, cfg: PriceConfig, ranked_features: Sequence[str],
                      sizes: Sequence[int] = (10, 15, 20, 22, 25), tolerance: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """CV of the top-k features by importance for each k (plus the full set), then
    the smallest set whose CV RMSE is within ``tolerance`` of the full set's.
    Returns (table of (n_features, features, rmse_mean, rmse_std), chosen row)."""
    from staylake.operators.topk import smallest_accepted
    ranked = list(ranked_features)
    ks = sorted({k for k in sizes if k < len(ranked)} | {len(ranked)})
    rows = []
    folds, prepared = cached_folds(df, cfg, ranked), Prepared(ranked)
    try:
        if cfg.algorithm == "gbt" and boost.follows(cfg.params):
            rows = [(k, ",".join(ranked[:k]), *s) for k, s in zip(ks, boosted_cv(folds, cfg, [ranked[:k] for k in ks], prepared), strict=True)]
        else:
            for k in ks:
                feats = ranked[:k]
                metrics, _ = cross_validate(df, cfg, features=feats, folds=folds, prepared=prepared)
                s = metrics.where(F.col("status") == "ok").agg(F.avg("rmse").alias("m"), F.stddev_samp("rmse").alias("s")).first()
                rows.append((k, ",".join(feats), s["m"], s["s"]))
    finally:
        folds.unpersist()
    table = df.sparkSession.createDataFrame(rows, "n_features int, features string, rmse double, rmse_std double")
    return table, smallest_accepted(table, tolerance)


def boosted_cv(folds: DataFrame, cfg: PriceConfig, feature_sets: Sequence[Sequence[str]],
               prepared: Prepared) -> list[tuple[float | None, float | None]]:
    """(mean, sample std) of the folds' RMSE of boosted trees on each feature set: ``cross_validate`` of them all in the same passes.

    Each fold's preprocessing is fitted on its training rows; a fold without any is left out, and if none has, it raises."""
    numeric, categorical, native = roles(prepared.features)
    exact = [(c, f"{c}__num__imp") for c in numeric + native]
    flags = [(c, f"{c}__missing") for c in native]
    sizes = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}  # one row per fold
    used = [k for k in range(cfg.n_folds) if sum(n for fold, n in sizes.items() if fold != k)]
    if not used:
        raise RuntimeError("no fold could be fitted: no training rows")

    # raw values counted once serve every fold: its stages turn each value, and NULL, into the fold's
    bins, names = int(cfg.params.get("maxBins", boost.PARAMS["maxBins"])), [name for _, name in exact + flags]
    counted = stacked_counts(folds, numeric + native, ["fold"]).limit(boost.COUNTED_VALUES + 1).collect() if exact else []
    raw = lambda v: "NaN" if v is not None and v != v else v  # noqa: E731 -- NaN is one value, and unequal to itself
    held = {raw(r["_sl_value"]): r["_sl_value"] for r in counted} if len(counted) <= boost.COUNTED_VALUES else None

    def cut(fitted: PipelineModel, train: DataFrame, k: int) -> dict[str, Any]:
        if held is None:
            return boost.cut_points(fitted.transform(train).select(*names), names, bins)
        values = folds.sparkSession.createDataFrame([(v,) for v in held.values()], "_raw double").select(
            "_raw", *[F.col("_raw").alias(c) for c in numeric + native], *[F.lit(None).cast("string").alias(c) for c in categorical])
        turned = {raw(r["_raw"]): r for r in fitted.transform(values).select("_raw", *names).collect()}  # a row a value
        return {name: boost.cut_counted(((turned[raw(r["_sl_value"])][name], r["n_equal"]) for r in counted if r["_sl_column"] == c and r["fold"] != k), bins)
                for c, name in exact + flags}

    def columns(k: int) -> list[boost.Column]:
        """The fold's columns in the order of the assembled vector."""
        folds.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{k}")
        train = folds.where(F.col("fold") != k)
        fitted = prepared.stages(train, k)
        cuts = cut(fitted, train, k) if exact else {}
        words = {c: labels for s in fitted.stages if isinstance(s, StringIndexerModel) for c, labels in zip(s.getOutputCols(), s.labelsArray, strict=True)}
        return [*[boost.Column(c, name, cuts[name]) for c, name in exact],
                *[boost.Column(c, f"{c}__idx", values=len(words[f"{c}__idx"])) for c in categorical],
                *[boost.Column(c, name, cuts[name]) for c, name in flags]]

    inherit = inheritable_thread_target(folds.sparkSession)
    with ThreadPoolExecutor(max_workers=max(1, min(cfg.parallel_folds, len(used)))) as pool:
        waiting = [pool.submit(inherit(lambda k=k: columns(k))) for k in used]
        by_fold = [w.result() for w in waiting]
    rows = folds.select("fold", F.col(cfg.target).cast("double").alias("y"), F.xxhash64(cfg.key).alias("h"), *prepared.features)
    for i, k in enumerate(used):
        kept = [c for c in rows.columns if c != f"x{i}"]
        rows = prepared.stages(folds, k).transform(rows).select(*kept, F.array(*[F.col(c.name).cast("double") for c in by_fold[i]]).alias(f"x{i}"))
    place = F.create_map(*[x for i, k in enumerate(used) for x in (F.lit(k), F.lit(i))])
    rows = rows.withColumn("fold", F.coalesce(place[F.col("fold")], F.lit(-1))).drop(*prepared.features)
    fits = [boost.Fit(i, [j for j, c in enumerate(by_fold[i]) if c.feature in set(chosen)]) for chosen in feature_sets for i in range(len(used))]
    if not all(f.columns for f in fits):
        raise RuntimeError("no fold could be fitted: a feature set has no feature with a role")
    rmse, out = boost.fit_together(rows, by_fold, fits, cfg.params, cfg.seed), []
    for s in range(len(feature_sets)):
        found = [x for x in rmse[s * len(used):(s + 1) * len(used)] if x is not None]
        out.append((statistics.fmean(found) if found else None, statistics.stdev(found) if len(found) > 1 else None))
    return out
