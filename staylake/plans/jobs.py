"""Batch jobs: raw drop -> bronze -> silver -> gold (+ contracts), model
retraining, and inference. Each step is a lazy DataFrame; tables are written
in dependency order so that later steps read materialised tables (which also
cuts lineage: a lost executor recomputes from the last written table, not
from the raw CSV)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.ml import price as P
from staylake.ml.explain import native_importance
from staylake.ml import registry as REG
from staylake.ml import segment as S
from staylake.operators.errors import error_by_group, error_frame
from staylake.operators.quality import run_suite
from staylake.plans import features, gold, silver
from staylake.plans.contracts import CONTRACTS
from staylake.session import cut_lineage
from staylake.sources.bronze import load_bronze
from staylake.sources.sinks import export_versioned, materialize, replace_staged


def silver_from_bronze(bronze: dict[str, DataFrame], dedup_calendar: bool = True) -> dict[str, DataFrame]:
    return {
        "silver_listings": silver.silver_listings(bronze["listings"]),
        "silver_calendar": silver.silver_calendar(bronze["calendar"], dedup=dedup_calendar),
        "silver_reviews": silver.silver_reviews(bronze["reviews"]),
        "silver_neighbourhoods": silver.silver_neighbourhoods(bronze["neighbourhoods"]),
    }


def gold_from_silver(s: dict[str, DataFrame], city: str = gold.DEFAULT_CITY) -> dict[str, DataFrame]:
    l, c, r = s["silver_listings"], s["silver_calendar"], s["silver_reviews"]
    return {
        "dim_listing": gold.dim_listing(l),
        "dim_host": gold.dim_host(l),
        "dim_location": gold.dim_location(l, city),
        "dim_date": gold.dim_date_from_silver(l, c, r),
        "fact_listing_current_snapshot": gold.fact_listing_current_snapshot(l, city),
        "fact_availability_daily": gold.fact_availability_daily(c, l, city),
        "fact_review": gold.fact_review(r, l, city),
        "gold_price_model_features": features.price_model_features(l),
        "gold_cluster_model_features": features.cluster_model_features(l),
    }


# facts are partitioned by month so date-bounded reads prune whole folders
PARTITIONING = {
    "fact_availability_daily": ("calendar_month", "calendar_date_key"),
    "fact_review": ("review_month", "review_date_key"),
}


def run_contracts(tables: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    results = [run_suite(n, tables[n], CONTRACTS[n], tables) for n in (names or CONTRACTS) if n in tables]
    return reduce(lambda a, b: a.unionByName(b), results)


# silver tables joined on listing_id are bucketed alike: the fact joins need no shuffle
LISTING_BUCKETED = {"silver_listings": None, "silver_calendar": ["calendar_date"], "silver_reviews": ["review_date"]}


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def build_lakehouse(spark: SparkSession, raw_dir: str, city: str = gold.DEFAULT_CITY, dedup_calendar: bool = True,
                    bronze_schema: str = "bronze", silver_schema: str = "silver", gold_schema: str = "gold",
                    buckets: int | None = None) -> DataFrame:
    """Full refresh. Returns the contract results of silver and gold (also written to gold.dq_results). The raw
    tables' own contracts go to bronze.dq_source_results: a raw drop may repeat rows that silver then removes."""
    load_bronze(spark, raw_dir, bronze_schema)
    bronze = {t: spark.table(f"{bronze_schema}.bronze_{t}") for t in ("listings", "calendar", "reviews", "neighbourhoods")}
    materialize(run_contracts({f"bronze_{t}": df for t, df in bronze.items()}), bronze_schema, "dq_source_results")
    n_buckets = buckets or default_buckets(spark)
    written: dict[str, DataFrame] = {}
    for name, df in silver_from_bronze(bronze, dedup_calendar).items():
        if name in LISTING_BUCKETED:
            path = materialize(df, silver_schema, name, bucket_by=("listing_id", n_buckets), sort_by=LISTING_BUCKETED[name])
        else:
            path = materialize(df, silver_schema, name)
        written[name] = spark.table(path)
    for name, df in gold_from_silver(written, city).items():
        part = PARTITIONING.get(name)
        if part:
            df = df.withColumn(part[0], (F.col(part[1]) / 100).cast("int"))
            written[name] = spark.table(materialize(df, gold_schema, name, [part[0]])).drop(part[0])
        else:
            written[name] = spark.table(materialize(df, gold_schema, name))
    results = run_contracts(written)
    return spark.table(materialize(results, gold_schema, "dq_results"))


def run_price_training(spark: SparkSession, mart: DataFrame, artifact_root: str, schema: str | None = None,
                       cfg: P.PriceConfig | None = None, tune_trials: int = 0, space: dict | None = None) -> str:
    """Prepare -> split -> (tune) -> fit -> evaluate -> persist, load check -> predictions -> exports -> records.

    With ``tune_trials`` a study on the training rows chooses the parameters and the model is refitted with
    them. Hold-out rows are ``evaluation`` rows without a run id. The trials, feature importances and errors by
    room type are exported below ``artifact_root/exports/<version>``."""
    cfg = cfg or P.PriceConfig()
    frame = features.modelling_frame(mart)
    split = P.hash_split(P.spread(frame, cfg.key), cfg.key, cfg.test_percent).cache()
    try:
        return _price_training_steps(spark, frame, split, artifact_root, schema, cfg, tune_trials, space)
    finally:
        split.unpersist()  # every result below is written before the split is released


def _price_training_steps(spark: SparkSession, frame: DataFrame, split: DataFrame, artifact_root: str,
                          schema: str | None, cfg: P.PriceConfig, tune_trials: int, space: dict | None) -> str:
    trials = None
    if tune_trials:
        train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
        trials = P.random_search(train, cfg, space or P.SEARCH_SPACE, tune_trials)
        model, cfg = P.refit_best(train, cfg, trials)
        metrics, pred = P.evaluate_model(model, test, cfg.target), P.predict(model, test, cfg.target)
    else:
        model, metrics, pred = P.train_evaluate(frame, cfg, split=split)
    version = REG.new_version("price")
    path = f"{artifact_root.rstrip('/')}/{version}"
    REG.save_model(model, path, {"features": list(cfg.features), "target": cfg.target, "algorithm": cfg.algorithm,
                                 "params": cfg.params}, check_rows=frame, key=cfg.key)
    REG.ensure_tables(spark, schema)
    errs = error_frame(pred, cfg.target, "predicted_log_price")
    rows = errs.select(F.lit(version).alias("model_version"), "listing_id", "actual_price", "predicted_price",
                       "actual_log_price", "predicted_log_price", "residual", "absolute_error",
                       F.current_timestamp().alias("prediction_date"), F.lit(None).cast("string").alias("prediction_run_id"),
                       F.lit("evaluation").alias("prediction_type"), F.current_timestamp().alias("predicted_at"))
    check = P.price_training_check(rows, metrics).first()
    if not check["passed"]:
        raise ValueError(f"price training check failed: {check.asDict()}")
    pre = f"{schema}." if schema else ""
    REG.append_run_once(rows, pre + "gold_price_predictions", ["model_version", "prediction_run_id"], "listing_id")
    exports = f"{artifact_root.rstrip('/')}/exports"
    if trials is not None:
        export_versioned(trials, exports, version, "trials")
    export_versioned(native_importance(model, frame, list(cfg.features)), exports, version, "importance")
    if "room_type" in errs.columns:
        export_versioned(error_by_group(errs, "room_type"), exports, version, "error_by_room_type")
    REG.record_training(spark, schema, version, "price_prediction", f"spark_{cfg.algorithm}", path,
                        REG.metrics_long(metrics, version, "price_prediction", "test"), "tune" if tune_trials else "retrain")
    return version


PROFILE_CATEGORIES = ["room_type", "property_base_group"]


def _segment_rows(assigned: DataFrame, version: str, run_id: str) -> DataFrame:
    return assigned.select("listing_id", F.lit(version).alias("model_version"), "cluster_id", "cluster_name",
                           "distance_to_centroid", F.current_timestamp().alias("assigned_at"),
                           F.lit(run_id).alias("assignment_run_id"))


def run_segmentation(spark: SparkSession, mart: DataFrame, artifact_root: str, schema: str | None = None,
                     k: int = S.DEFAULT_K, n_init: int = S.DEFAULT_N_INIT) -> str:
    model = S.fit_segmentation(mart, k, n_init)
    names = S.name_segments(S.centroid_signature(model, mart), "accommodates", "minimum_nights_log")
    version = REG.new_version("segment")
    path = f"{artifact_root.rstrip('/')}/{version}"
    REG.save_model(model, path, {"k": k, "names": {r.cluster_id: r.cluster_name for r in names.collect()}}, check_rows=mart)
    export_versioned(S.centroid_table(model.stages[-1], S.feature_names(model)).join(names, "cluster_id", "left"),
                     f"{artifact_root.rstrip('/')}/exports", version, "centroids")
    assigned = S.attach_names(S.segment_assign(model, mart), names)
    # the profile joins several aggregates of its rows; in such joins a cached mart is not found again and is computed anew
    scored = cut_lineage(assigned.select("listing_id", "cluster_id", "cluster_name", "distance_to_centroid", "price",
                                         *S.SEGMENT_NUMERIC, *PROFILE_CATEGORIES))
    rows = _segment_rows(scored, version, version)
    check = S.segmentation_check(rows, k).first()
    if not check["passed"]:
        raise ValueError(f"segmentation check failed: {check.asDict()}")
    quality = S.cluster_quality(assigned, "listing_id", "features", "cluster_id") \
        .withColumn("silhouette", F.lit(S.silhouette(assigned, "features", "cluster_id")))
    REG.ensure_tables(spark, schema)
    pre = f"{schema}." if schema else ""
    REG.append_run_once(rows, pre + "gold_listing_segments", "assignment_run_id", "listing_id")
    prof = S.segment_profile(scored, "cluster_id", "price", S.SEGMENT_NUMERIC, PROFILE_CATEGORIES).join(names, "cluster_id", "left")
    REG.guarded_append(prof.select(F.lit(version).alias("model_version"), "cluster_id", "cluster_name", "listing_count",
                                   "median_price", "avg_price", "listing_share",
                                   *[F.col(f"avg_{c}").alias(f"{c}_mean") for c in S.SEGMENT_NUMERIC],
                                   *[f"dominant_{c}" for c in PROFILE_CATEGORIES],
                                   F.current_timestamp().alias("created_at")), pre + "gold_segment_profiles")
    REG.record_training(spark, schema, version, "listing_segmentation", "spark_kmeans", path,
                        REG.metrics_long(quality, version, "listing_segmentation", "train"))
    return version


def run_price_inference(spark: SparkSession, mart: DataFrame, run_id: str, schema: str | None = None,
                        allow_candidate: bool = False) -> DataFrame:
    """Champion lookup -> load -> score the whole table -> check -> idempotent append.

    A listing that the modelling frame leaves out (no positive price) would have no prediction, so
    such a table is refused. Batch rows carry predictions only: actuals and residuals are NULL.
    """
    reg = REG.lookup_model(spark, schema, "price_prediction", allow_candidate)
    model, meta = REG.load_model(reg.artifact_path)
    frame = features.modelling_frame(mart)
    missing = [c for c in meta["features"] if c not in frame.columns]
    if missing:
        raise ValueError(f"missing required features: {missing}")
    pred = P.predict(model, P.spread(frame, "listing_id"), meta["target"])
    check = P.check_predictions(pred).first()
    expected = mart.count()
    if not expected or check["rows"] != expected:
        raise ValueError(f"batch prediction check failed: {check['rows']} of {expected} listings scored")
    if check["non_finite"] or check["negative"] or check["null_keys"] or check["duplicate_keys"]:
        raise ValueError(f"batch prediction check failed: {check.asDict()}")
    rows = pred.select(F.lit(reg.model_version).alias("model_version"), "listing_id",
                       "predicted_price", "predicted_log_price",
                       F.current_timestamp().alias("prediction_date"), F.lit(run_id).alias("prediction_run_id"),
                       F.lit("batch").alias("prediction_type"), F.current_timestamp().alias("predicted_at"))
    pre = f"{schema}." if schema else ""
    REG.append_run_once(rows, pre + "gold_price_predictions", "prediction_run_id", "listing_id")
    return check_row_df(spark, check)


def check_row_df(spark: SparkSession, row) -> DataFrame:
    return spark.createDataFrame([tuple(row)], list(row.asDict().keys()))


def run_segment_inference(spark: SparkSession, mart: DataFrame, run_id: str, schema: str | None = None,
                          allow_candidate: bool = False) -> DataFrame:
    reg = REG.lookup_model(spark, schema, "listing_segmentation", allow_candidate)
    model, meta = REG.load_model(reg.artifact_path)
    missing = [c for c in S.SEGMENT_NUMERIC + S.SEGMENT_CATEGORICAL if c not in mart.columns]
    if missing:
        raise ValueError(f"missing required features: {missing}")
    names = spark.createDataFrame([(int(k), v) for k, v in meta["names"].items()], "cluster_id int, cluster_name string")
    assigned = S.attach_names(S.segment_assign(model, mart), names)
    rows = _segment_rows(assigned, reg.model_version, run_id)
    check = S.segmentation_check(rows, int(meta["k"])).first()
    if not check["passed"] or check["rows"] != mart.count():
        raise ValueError(f"segment assignment check failed: {check.asDict()}")
    pre = f"{schema}." if schema else ""
    REG.append_run_once(rows, pre + "gold_listing_segments", "assignment_run_id", "listing_id")
    written = spark.table(pre + "gold_listing_segments").where(F.col("assignment_run_id") == run_id)
    publish_segments(written, pre + CURRENT_SEGMENTS, mart, int(meta["k"]))
    return written.groupBy("cluster_id", "cluster_name").agg(F.count(F.lit(1)).alias("listings"))


# The view of the latest assignment, one row per listing of the mart.
CURRENT_SEGMENTS = "gold_current_listing_segments"
SEGMENT_TYPES = {"listing_id": "bigint", "cluster_id": "int", "cluster_name": "string", "distance_to_centroid": "double",
                 "assignment_run_id": "string", "model_version": "string", "assigned_at": "timestamp"}


def publish_segments(rows: DataFrame, table: str, mart: DataFrame, k: int) -> dict[str, int]:
    """Replace the current assignment by one run's rows, if they are one row per listing of the mart with a valid cluster."""
    return replace_staged(rows, table, "listing_id", SEGMENT_TYPES, expected_rows=mart.count(), not_null=["cluster_id"],
                          ranges={"cluster_id": (0, k - 1)}, source=mart)


# The four model jobs (retrain / infer for each task); the lakehouse refresh runs before retraining.
JOBS = {
    "price_retraining_job": run_price_training,
    "segmentation_retraining_job": run_segmentation,
    "price_inference_job": run_price_inference,
    "segmentation_inference_job": run_segment_inference,
}
