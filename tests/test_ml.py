"""Model round trips, registry rules and idempotent appends."""

import uuid

import pytest
from pyspark.sql import functions as F

from staylake.ml import registry as REG
from staylake.ml import segment as S
from staylake.ml.price import PriceConfig, predict, train_evaluate
from staylake.plans import binding as B, features, jobs
from staylake.session import ensure_checkpoint_dir
from conftest import SF

CFG = PriceConfig(params={"maxDepth": 3, "maxIter": 5}, n_folds=3)


@pytest.fixture(scope="module")
def mart(spark):
    return features.price_model_features(B.bound_part_listings(spark, SF)).cache()


@pytest.fixture()
def schema(spark):
    name = f"reg_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def test_price_train_save_load_same_predictions(spark, mart):
    frame = features.modelling_frame(mart)
    model, metrics, pred = train_evaluate(frame, CFG)
    m = metrics.first()
    assert m.n > 0 and m.rmse >= 0 and set(metrics.columns) == {"n", "rmse", "mae", "r2", "adjusted_r2"}
    path = ensure_checkpoint_dir(spark) + f"/model_{uuid.uuid4().hex}"
    REG.save_model(model, path, {"features": list(CFG.features)})
    loaded, meta = REG.load_model(path)
    a = predict(model, frame, CFG.target).select("listing_id", "predicted_log_price")
    b = predict(loaded, frame, CFG.target).select("listing_id", F.col("predicted_log_price").alias("p2"))
    assert a.join(b, "listing_id").where(F.abs(F.col("predicted_log_price") - F.col("p2")) > 1e-12).count() == 0
    with pytest.raises(Exception):
        REG.save_model(model, path, {})  # never overwrite a version


def test_segmentation_reload_same_clusters(spark):
    mart = features.cluster_model_features(B.bound_part_listings(spark, SF)).cache()
    model = S.fit_segmentation(mart, 3, 2)
    a = S.segment_assign(model, mart).select("listing_id", "cluster_id")
    path = ensure_checkpoint_dir(spark) + f"/seg_{uuid.uuid4().hex}"
    model.write().save(path)
    from pyspark.ml import PipelineModel
    b = S.segment_assign(PipelineModel.load(path), mart).select("listing_id", F.col("cluster_id").alias("c2"))
    assert a.join(b, "listing_id").where(F.col("cluster_id") != F.col("c2")).count() == 0
    assert {r.cluster_id for r in a.select("cluster_id").distinct().collect()} <= {0, 1, 2}
    q = S.cluster_quality(S.segment_assign(model, mart), "listing_id", "features", "cluster_id").first()
    assert q.clusters_observed >= 2 and q.calinski_harabasz > 0 and q.davies_bouldin > 0


def test_registry_champion_first_and_candidate_opt_in(spark, schema):
    REG.ensure_tables(spark, schema)
    m = REG.metric_records(spark, {"rmse": 1.0}, "v1", "price_prediction", "test")
    REG.record_training(spark, schema, "v1", "price_prediction", "gbt", "/nowhere/v1", m)
    with pytest.raises(RuntimeError):
        REG.lookup_model(spark, schema, "price_prediction")
    assert REG.lookup_model(spark, schema, "price_prediction", allow_candidate=True).model_version == "v1"
    REG.record_training(spark, schema, "v2", "price_prediction", "gbt", "/nowhere/v2",
                        REG.metric_records(spark, {"rmse": 0.9}, "v2", "price_prediction", "test"))
    REG.promote(spark, schema, "price_prediction", "v1")
    assert REG.lookup_model(spark, schema, "price_prediction", allow_candidate=True).model_version == "v1"


def test_run_append_once(spark, schema):
    REG.ensure_tables(spark, schema)
    rows = spark.createDataFrame([(1, "v", 0, "x", 0.1, None, "run1")],
                                 "listing_id bigint, model_version string, cluster_id int, cluster_name string, "
                                 "distance_to_centroid double, assigned_at timestamp, assignment_run_id string")
    t = f"{schema}.gold_listing_segments"
    assert REG.append_run_once(rows, t, "assignment_run_id", "listing_id") == 1
    with pytest.raises(ValueError):
        REG.append_run_once(rows, t, "assignment_run_id", "listing_id")
    with pytest.raises(ValueError):
        REG.guarded_append(rows.limit(0), t)


def test_training_and_inference_jobs(spark, schema, mart):
    root = ensure_checkpoint_dir(spark) + f"/jobs_{uuid.uuid4().hex[:8]}"
    v = jobs.run_price_training(spark, mart, root, schema, CFG)
    REG.promote(spark, schema, "price_prediction", v)
    check = jobs.run_price_inference(spark, mart, "batch1", schema).first()
    assert check.rows == mart.count() and check.non_finite == 0 and check.negative == 0
    rows = spark.table(f"{schema}.gold_price_predictions").where("prediction_run_id = 'batch1'")
    assert rows.where("actual_price is not null or residual is not null or predicted_price is null").count() == 0
    with pytest.raises(ValueError):
        jobs.run_price_inference(spark, mart, "batch1", schema)
    unpriced = mart.withColumn("price", F.when(F.col("listing_id") % 2 == 0, F.col("price")))
    with pytest.raises(ValueError, match="listings scored"):
        jobs.run_price_inference(spark, unpriced, "batch2", schema)


def test_rejected_segmentation_is_not_registered(spark, schema, monkeypatch):
    mart = features.cluster_model_features(B.bound_part_listings(spark, SF))
    root = ensure_checkpoint_dir(spark) + f"/seg_rejected_{uuid.uuid4().hex[:8]}"
    REG.ensure_tables(spark, schema)
    before = spark.table(f"{schema}.gold_ml_model_registry").count()
    check = S.segmentation_check
    monkeypatch.setattr(S, "segmentation_check", lambda rows, k: check(rows, k).withColumn("passed", F.lit(False)))
    with pytest.raises(ValueError):
        jobs.run_segmentation(spark, mart, root, schema, k=3, n_init=1)
    assert spark.table(f"{schema}.gold_ml_model_registry").count() == before


def test_infrequent_bucketer_roundtrip(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from staylake.ml.prep import InfrequentBucketer
    df = spark.createDataFrame([("a",)] * 31 + [("b",)] * 2 + [(None,)], "c string")
    model = Pipeline(stages=[InfrequentBucketer(inputCols=["c"], minFrequency=30)]).fit(df)
    out = sorted(set(r.c for r in model.transform(df).collect()), key=str)
    assert out == ["a", "infrequent", None] or out == [None, "a", "infrequent"]
    path = str(tmp_path / "m")
    model.write().save(path)
    again = PipelineModel.load(path).transform(spark.createDataFrame([("b",), ("a",), ("z",)], "c string"))
    assert [r.c for r in again.collect()] == ["infrequent", "a", "infrequent"]


def test_infrequent_bucketer_literal_and_join_agree(spark, monkeypatch, tmp_path):
    from staylake.ml import prep
    df = spark.range(300).select((F.col("id") % 7).cast("string").alias("c"), F.when(F.col("id") < 250, "x").otherwise(F.col("id").cast("string")).alias("d"))
    one = prep.InfrequentBucketer(inputCols=["c", "d"], minFrequency=43).fit(df)
    expected = sorted(map(tuple, one.transform(df).collect()))
    assert {r[0] for r in expected} == {"0", "1", "2", "3", "4", "5", "infrequent"} and {r[1] for r in expected} == {"x", "infrequent"}
    for limit in (0, 1000):
        monkeypatch.setattr(prep, "BROADCAST_VALUES", limit)
        monkeypatch.setattr(prep, "LITERAL_VALUES", 2)
        one.write().save(str(tmp_path / f"m{limit}"))
        again = prep.InfrequentBucketerModel.load(str(tmp_path / f"m{limit}"))
        assert again.literal is None
        assert sorted(map(tuple, again.transform(df).collect())) == expected


def test_more_categories_than_any_literal_list(spark):
    from staylake.ml.prep import InfrequentBucketer
    df = spark.range(240_000).select((F.col("id") % 120_000).cast("string").alias("c"))
    out = InfrequentBucketer(inputCols=["c"], minFrequency=2).fit(df).transform(df)
    assert out.where(F.col("c") == "infrequent").count() == 0 and out.count() == 240_000


def test_importances_have_the_raw_features(spark, mart):
    from staylake.ml.explain import native_importance, permutation_importance
    frame = features.modelling_frame(mart)
    model, _, _ = train_evaluate(frame, CFG)
    rows = native_importance(model, frame, list(CFG.features)).collect()
    assert {r.feature for r in rows} == set(CFG.features) and sorted(r["rank"] for r in rows) == list(range(1, 16))
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9
    assert max(r.importance for r in rows) < 0.98  # no feature is the target in disguise
    perm = permutation_importance(model, frame, ["accommodates", "neighbourhood"], "listing_id", n_repeats=2).collect()
    assert {r.feature for r in perm} == {"accommodates", "neighbourhood"}


def test_shuffled_columns_is_a_permutation(spark, monkeypatch):
    from staylake.ml import explain
    monkeypatch.setattr(explain, "SHUFFLE_ROWS", 30)
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    out = explain.shuffled_columns(df, "k", ["v"], 1, 200).select("k", "v", F.col("_donor.v").alias("w")).collect()
    assert sorted(r.w for r in out) == sorted(r.v for r in out)
    assert sum(r.v != r.w for r in out) > 150


def test_second_promotion_retires_the_first(spark, schema):
    REG.ensure_tables(spark, schema)
    for v in ("v1", "v2"):
        REG.record_training(spark, schema, v, "price_prediction", "gbt", f"/nowhere/{v}",
                            REG.metric_records(spark, {"rmse": 1.0}, v, "price_prediction", "test"))
        REG.promote(spark, schema, "price_prediction", v)
    assert REG.lookup_model(spark, schema, "price_prediction").model_version == "v2"
    REG.promote(spark, schema, "price_prediction", "v1")
    assert REG.lookup_model(spark, schema, "price_prediction").model_version == "v1"


def test_price_pipeline_one_indexer_for_all_categories():
    from pyspark.ml.feature import StringIndexer
    from staylake.ml.price import CATEGORICAL_FEATURES, build_pipeline
    idx = [s for s in build_pipeline(CFG.features).getStages() if isinstance(s, StringIndexer)]
    assert len(idx) == 1 and len(idx[0].getInputCols()) == len(CATEGORICAL_FEATURES & set(CFG.features))


def test_exactly_four_model_jobs():
    assert set(jobs.JOBS) == {"price_retraining_job", "segmentation_retraining_job", "price_inference_job",
                              "segmentation_inference_job"}


def test_segmentation_jobs_roundtrip(spark, schema):
    mart = features.cluster_model_features(B.bound_part_listings(spark, SF)).cache()
    root = ensure_checkpoint_dir(spark) + f"/seg_jobs_{uuid.uuid4().hex[:8]}"
    v = jobs.run_segmentation(spark, mart, root, schema, k=3, n_init=2)
    segs = spark.table(f"{schema}.gold_listing_segments").where(F.col("model_version") == v)
    assert segs.count() == mart.count()
    assert S.segmentation_check(segs, 3).first()["passed"]
    assert set(r.cluster_name for r in segs.select("cluster_name").distinct().collect()) <= set(S.SEGMENT_NAMES.values())
    prof = spark.table(f"{schema}.gold_segment_profiles").where(F.col("model_version") == v)
    assert prof.agg(F.sum("listing_count")).first()[0] == mart.count()
    means = {r.cluster_id: r.m for r in segs.join(mart, "listing_id").groupBy("cluster_id").agg(F.avg("beds").alias("m")).collect()}
    assert len(prof.columns) == 16 and {r.cluster_id: round(r.beds_mean, 9) for r in prof.collect()} == {c: round(m, 9) for c, m in means.items()}
    assert prof.where("dominant_room_type is null or dominant_property_base_group is null").count() == 0
    with pytest.raises(RuntimeError):
        jobs.run_segment_inference(spark, mart, "batch_seg", schema)  # candidate only, no opt-in
    counts = jobs.run_segment_inference(spark, mart, "batch_seg", schema, allow_candidate=True)
    assert counts.agg(F.sum("listings")).first()[0] == mart.count()


def test_exact_fill_and_scale_as_saved_stage(spark, tmp_path):
    import numpy as np
    from pyspark.ml import Pipeline, PipelineModel
    from staylake.ml.prep import FillAndScale, MostFrequentFill
    nan = float("nan")
    a, b, e = [1.0, 2.0, None, 10.0, nan, 4.0], [5.0] * 5 + [None], [None] * 6
    t = ["x'y", "x'y", None, "\\b", "\\b", "c"]
    df = spark.createDataFrame(list(zip(a, b, e, t)), "a double, b double, e double, t string")
    model = Pipeline(stages=[FillAndScale(inputCols=["a", "b", "e"]), MostFrequentFill(inputCols=["t"])]).fit(df)
    model.write().save(str(tmp_path / "m"))
    want = np.array([1, 2, 3, 10, 3, 4.0])  # the median of 1, 2, 10, 4 lies between two values
    want = (want - want.mean()) / want.std()
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        rows = m.transform(df.repartition(3)).collect()
        assert np.allclose(sorted(r.a__imp for r in rows), sorted(want), atol=1e-12)
        assert {r.b__imp for r in rows} == {0.0} == {r.e__imp for r in rows}  # constant and empty columns
        assert sorted(r.t__filled for r in rows) == sorted(["x'y", "x'y", "\\b", "\\b", "\\b", "c"])  # tie: the smallest
    unfilled = FillAndScale(inputCols=["a"], fill=False).fit(df).transform(df).collect()
    assert sum(r.a__imp is None for r in unfilled) == 2
    again = FillAndScale(inputCols=["a"], scale=False).fit(df).transform(spark.createDataFrame([(None,)], "a double"))
    assert again.first().a__imp == 3.0
    empty = Pipeline(stages=[FillAndScale(inputCols=["a"]), MostFrequentFill(inputCols=["t"])]).fit(df.limit(0))
    row = empty.transform(spark.createDataFrame([(None, None), (2.0, "k")], "a double, t string")).collect()
    assert [(r.a__imp, r.t__filled) for r in row] == [(0.0, "Unknown"), (2.0, "k")]


def test_price_pipeline_fills_like_the_exact_statistics(spark, mart, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    from staylake.ml.explain import slot_features
    from staylake.ml.prep import apply_fill, fit_medians, fit_scaler, apply_scaler
    from staylake.ml.price import build_pipeline
    frame = features.modelling_frame(mart).withColumn("bedrooms", F.when(F.col("listing_id") % 3 > 0, F.col("bedrooms")).cast("double"))
    model = build_pipeline(["bedrooms", "minimum_nights", "room_type"], "log_price", "gbt", {"maxIter": 1, "maxDepth": 1},
                           category_fill="most_frequent").fit(frame)
    model.write().save(str(tmp_path / "p"))
    assert slot_features(model)[:2] == ["bedrooms", "minimum_nights"]
    x = frame.select("listing_id", F.col("bedrooms").cast("double"), F.col("minimum_nights").cast("double"))
    cols = ["bedrooms", "minimum_nights"]
    filled = apply_fill(x, fit_medians(x, cols))
    want = {r.listing_id: (r.bedrooms, r.minimum_nights) for r in apply_scaler(filled, fit_scaler(filled, cols), cols).collect()}
    for m in (model, PipelineModel.load(str(tmp_path / "p"))):
        got = m.transform(frame).select("listing_id", vector_to_array("features").alias("f")).collect()
        assert len(got) == len(want) and all(abs(r.f[i] - want[r.listing_id][i]) < 1e-9 for r in got for i in (0, 1))


def _jobs(spark, work):
    """The result of ``work`` and the number of jobs it ran."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_kmeans_starts_share_their_passes(spark):
    """Centres and inertia of far groups are exact (far from zero too), and ten starts take hardly more jobs than one."""
    import numpy as np
    rows = [(1e6 + 100.0 * g + (i % 7), -50.0 * (g % 2) + (i % 3)) for g in range(4) for i in range(60)]
    points = S.as_vector(spark.createDataFrame(rows, "x double, y double").repartition(3), ["x", "y"])
    groups = np.array(rows).reshape(4, 60, 2)
    one, few = _jobs(spark, lambda: S.fit_kmeans(points, 4, n_init=1))
    model, many = _jobs(spark, lambda: S.fit_kmeans(points, 4, n_init=10))
    assert many <= 1.5 * few
    assert np.allclose(sorted(c.tolist() for c in model.clusterCenters()), groups.mean(axis=1), atol=1e-6)
    inertia = ((groups - groups.mean(axis=1, keepdims=True)) ** 2).sum()
    assert abs(S.elbow(points, [4], n_init=10).first().inertia - inertia) < 1e-6
    sizes = S.assign(model, points).groupBy("cluster_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [60] * 4


def test_kmeans_with_fewer_points_than_clusters(spark):
    points = S.as_vector(spark.createDataFrame([(1.0, 2.0)] * 5 + [(3.0, 4.0)] * 5, "x double, y double"), ["x", "y"])
    model = S.fit_kmeans(points, 4, n_init=3)
    assert sorted(c.tolist() for c in model.clusterCenters()) == [[1.0, 2.0], [3.0, 4.0]]
    assert S.elbow(points, [2, 4]).collect()[1].inertia == 0.0


def test_tables_of_a_fit_are_spread_over_tasks(spark, mart, monkeypatch):
    """One row group of a file is one task; what a fit caches is not, and holds the same rows."""
    from staylake.ml import prep
    from staylake.ml.price import cached_folds
    from staylake.plans.binding import spread_part_listings
    monkeypatch.setattr(prep, "TASK_ROWS", 40)
    frame = features.modelling_frame(mart).coalesce(1)
    folds = cached_folds(frame, CFG)
    try:
        assert folds.rdd.getNumPartitions() >= folds.count() / 40 > 1
        assert set(folds.columns) == {"fold", CFG.key, CFG.target, *CFG.features}
        assert sorted(r.listing_id for r in folds.collect()) == sorted(r.listing_id for r in frame.collect())
    finally:
        folds.unpersist()
    listings = spread_part_listings(spark, SF)
    assert listings.rdd.getNumPartitions() > 1
    assert sorted(map(str, listings.collect())) == sorted(map(str, B.bound_part_listings(spark, SF).collect()))


def test_prepared_folds_fit_as_pipelines_do(spark, mart):
    from pyspark.ml.functions import vector_to_array
    from staylake.ml.price import Prepared, build_pipeline
    frame = features.modelling_frame(mart)
    prepared, names = Prepared(CFG.features), ["accommodates", "bedrooms", "review_scores_location", "room_type"]
    for chosen in (names, ["neighbourhood", "host_response_time"], list(CFG.features)):
        pipeline = build_pipeline(chosen, "log_price", "linear", {})
        rows = [m.transform(frame).select("listing_id", vector_to_array("features").alias("f"), "prediction").orderBy("listing_id").collect()
                for m in (pipeline.fit(frame), prepared.fit(pipeline, frame, 0))]
        assert [(r.listing_id, r.f) for r in rows[0]] == [(r.listing_id, r.f) for r in rows[1]]
        assert all(abs(a.prediction - b.prediction) < 1e-9 for a, b in zip(*rows, strict=True))
    assert list(prepared.by_fold) == [0]  # fitted once


def test_a_segment_profile_does_not_compute_the_mart_again(spark, schema, monkeypatch):
    """Its aggregates are joined with each other, and there Spark does not find a cached mart again."""
    from staylake.plans.catalog import QUERIES
    seen, profile = [], S.segment_profile

    def spy(*args, **kwargs):
        out = profile(*args, **kwargs)
        seen.append("parquet" not in out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(S, "segment_profile", spy)
    mart = features.cluster_model_features(B.bound_part_listings(spark, SF)).cache()
    version = jobs.run_segmentation(spark, mart, ensure_checkpoint_dir(spark) + f"/seg_once_{uuid.uuid4().hex[:8]}", schema, k=3, n_init=2)
    rows = QUERIES["segment_mart_model"](spark, SF).collect()
    assert seen == [True, True]
    assert sum(r.listing_count for r in rows) == mart.count() == spark.table(f"{schema}.gold_listing_segments").where(F.col("model_version") == version).count()


def test_fits_together_are_the_trees_of_one_fit_each(spark, mart, monkeypatch):
    """Same folds, features and parameters: the RMSE of Spark's GBTRegressor, fitted fold by fold."""
    from staylake.ml import boost
    from staylake.ml.price import Prepared, boosted_cv, cached_folds, cross_validate
    chosen = ["accommodates", "review_scores_location", "room_type"]
    beds = F.when(F.col("listing_id") % 7 == 0, None).when(F.col("listing_id") % 11 == 0, float("nan")).otherwise(F.col("accommodates"))
    frame = features.modelling_frame(mart).withColumn("accommodates", beds.cast("double"))
    cfg = PriceConfig(features=chosen, params={"maxDepth": 3, "maxIter": 12}, n_folds=3)
    folds, prepared = cached_folds(frame, cfg), Prepared(chosen)
    try:
        sets = [chosen[:1], chosen]
        found = boosted_cv(folds, cfg, sets, prepared)
        for names, (mean, std) in zip(sets, found, strict=True):
            m = cross_validate(frame, cfg, features=names, folds=folds, prepared=prepared)[0].agg(F.avg("rmse"), F.stddev_samp("rmse")).first()
            assert abs(mean - m[0]) < 1e-9 and abs(std - m[1]) < 1e-9
        monkeypatch.setattr(boost, "COUNTED_VALUES", 8)  # more values than the driver gets: cut at quantiles on the cluster
        for (mean, _), (cut, _) in zip(found, boosted_cv(folds, cfg, sets, prepared), strict=True):
            assert abs(cut / mean - 1) < 0.1
        with pytest.raises(Exception, match="not finite"):
            boosted_cv(folds.withColumn(cfg.target, F.lit(float("nan"))), cfg, sets, prepared)
    finally:
        folds.unpersist()


def test_a_selection_reads_the_rows_as_often_for_many_sets_as_for_one(spark, mart):
    from staylake.ml.price import feature_selection
    frame, jobs_of = features.modelling_frame(mart), {}
    ranked = ["accommodates", "review_scores_location", "room_type", "neighbourhood"]
    for sizes in ((), (1, 2, 3)):
        group = f"selection_{uuid.uuid4().hex[:8]}"
        spark.sparkContext.setJobGroup(group, "feature selection")
        try:
            table, chosen = feature_selection(frame, CFG, ranked, sizes)
            jobs_of[sizes] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [r.n_features for r in table.orderBy("n_features").collect()] == [*sizes, len(ranked)] and chosen.count() == 1
    assert jobs_of[(1, 2, 3)] < 1.5 * jobs_of[()]
