"""Staged replacement, run-partitioned appends, load checks, studies with early stopping, training in tune mode."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF
from staylake.ml import price as P
from staylake.ml import registry as REG
from staylake.operators.joins import one_to_one_left_join, orphans
from staylake.plans import binding as B, features, jobs
from staylake.session import ensure_checkpoint_dir
from staylake.sources import sinks

TYPES = {"id": "bigint", "grp": "int"}
CFG = P.PriceConfig(params={"maxDepth": 2, "maxIter": 3}, n_folds=3)


@pytest.fixture()
def schema(spark):
    name = f"pub_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture(scope="module")
def frame(spark):
    return features.modelling_frame(features.price_model_features(B.bound_part_listings(spark, SF))).cache()


def content(spark, table):
    return sorted(map(tuple, spark.table(table).select("id", "grp").collect()))


def test_failed_audit_keeps_the_old_rows(spark, schema):
    t = f"{schema}.segments"
    rows = spark.createDataFrame([(1, 0), (2, 1)], "id int, grp bigint")
    audit = sinks.replace_staged(rows, t, "id", TYPES, expected_rows=2, ranges={"grp": (0, 1)}, source=rows)
    assert audit == {"rows": 2, "distinct_keys": 2, "null_keys": 0, "outside_grp": 0, "joined_rows": 2}
    assert dict(spark.table(t).dtypes) == TYPES
    bad = {
        "distinct_keys": [(1, 0), (1, 1)], "null_keys": [(None, 0), (2, 1)], "outside_grp": [(1, 0), (2, 7)],
        "null_grp": [(1, 0), (2, None)], "joined_rows": [(1, 0), (9, 1)], "expected rows": [(1, 0)], "rows": [],
    }
    for why, data in bad.items():
        with pytest.raises(ValueError, match=why):
            sinks.replace_staged(spark.createDataFrame(data, "id int, grp bigint"), t, "id", TYPES, expected_rows=2,
                                 not_null=["grp"], ranges={"grp": (0, 1)}, source=rows)
        assert content(spark, t) == [(1, 0), (2, 1)]
    assert len(sinks._versions(spark, t)) == 1  # versions that failed are gone
    with pytest.raises(Exception):  # a value that does not fit its type
        sinks.replace_staged(spark.createDataFrame([(1, 2**40)], "id int, grp bigint"), t, "id", TYPES)
    with pytest.raises(ValueError, match="columns"):
        sinks.replace_staged(rows.withColumn("more", F.lit(1)), t, "id", TYPES)
    assert content(spark, t) == [(1, 0), (2, 1)]


def test_source_with_repeated_keys_fails_the_join_count(spark, schema):
    rows = spark.createDataFrame([(1, 0), (2, 1)], "id int, grp int")
    with pytest.raises(ValueError, match="joined_rows"):
        sinks.replace_staged(rows, f"{schema}.s", "id", TYPES, source=rows.union(rows.limit(1)))


def test_replacing_keeps_one_earlier_version(spark, schema):
    t = f"{schema}.segments"
    sinks.replace_staged(spark.createDataFrame([(7, 7)], "id int, grp int"), f"{schema}.segments_other", "id", TYPES)
    for i in range(4):
        sinks.replace_staged(spark.createDataFrame([(i, i)], "id int, grp int"), t, "id", TYPES)
        assert content(spark, t) == [(i, i)]
    assert len(sinks._versions(spark, t)) == 2
    # rows that read the table they replace
    sinks.replace_staged(spark.table(t).withColumn("grp", F.col("grp") + 1), t, "id", TYPES)
    assert content(spark, t) == [(3, 4)] and content(spark, f"{schema}.segments_other") == [(7, 7)]
    spark.createDataFrame([(1, 1)], "id int, grp int").write.saveAsTable(f"{schema}.plain")
    with pytest.raises(ValueError, match="no published view"):
        sinks.replace_staged(spark.table(t), f"{schema}.plain", "id", TYPES)


def run_rows(spark, run, n, version="v", start=0):
    return spark.range(start, start + n).select(F.col("id").alias("listing_id"), F.lit(version).alias("model_version"),
                                                F.lit(run).cast("string").alias("assignment_run_id"))


def test_append_reads_only_its_run_and_a_retry_changes_nothing(spark, schema):
    REG.ensure_tables(spark, schema)
    t = f"{schema}.gold_listing_segments"
    for r in ("a", "b/'c d"):
        REG.append_run_once(run_rows(spark, r, 5), t, "assignment_run_id", "listing_id")
    runs = run_rows(spark, "b/'c d", 1).select("assignment_run_id").distinct().collect()
    plan = REG.written_runs(spark.table(t), runs)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(assignment_run_id" in plan and "DataFilters: []" in plan, plan
    assert len(REG.written_runs(spark.table(t), runs).inputFiles()) < len(spark.table(t).inputFiles())
    before = sorted(map(str, spark.table(t).collect()))
    with pytest.raises(ValueError, match="already written"):
        REG.append_run_once(run_rows(spark, "b/'c d", 5), t, "assignment_run_id", "listing_id")
    assert sorted(map(str, spark.table(t).collect())) == before
    for _ in range(2):
        assert REG.append_run_once(run_rows(spark, "a", 3, "w"), t, "assignment_run_id", "listing_id", "replace") == 3
        got = {(r.assignment_run_id, r.model_version): r["count"] for r in
               spark.table(t).groupBy("assignment_run_id", "model_version").count().collect()}
        assert got == {("a", "w"): 3, ("b/'c d", "v"): 5}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_runs_need_a_name(spark, schema):
    REG.ensure_tables(spark, schema)
    t = f"{schema}.gold_listing_segments"
    with pytest.raises(ValueError, match="NULL"):
        REG.append_run_once(run_rows(spark, None, 2), t, "assignment_run_id", "listing_id")
    two = ["model_version", "assignment_run_id"]
    REG.append_run_once(run_rows(spark, None, 2), t, two, "listing_id")
    REG.append_run_once(run_rows(spark, None, 2, "w"), t, two, "listing_id")
    with pytest.raises(ValueError, match="already written"):
        REG.append_run_once(run_rows(spark, None, 1, "w", start=9), t, two, "listing_id")
    with pytest.raises(ValueError, match="not partitioned"):
        REG.append_run_once(run_rows(spark, "x", 2), t, two, "listing_id", "replace")
    with pytest.raises(ValueError, match="duplicate"):
        REG.append_run_once(run_rows(spark, "x", 2).union(run_rows(spark, "x", 1)), t, "assignment_run_id", "listing_id")
    assert spark.table(t).count() == 4


def test_a_model_that_reads_back_differently_has_no_metadata(spark, frame, monkeypatch):
    one = P.build_pipeline(CFG.features, CFG.target, "gbt", CFG.params).fit(frame)
    other = P.build_pipeline(CFG.features, CFG.target, "gbt", {"maxDepth": 1, "maxIter": 1}).fit(frame)
    root = ensure_checkpoint_dir(spark) + f"/check_{uuid.uuid4().hex}"
    REG.save_model(one, root + "/good", {"a": 1}, check_rows=frame)
    meta = REG.load_model(root + "/good")[1]
    assert int(meta["load_check"]["rows"]) == min(REG.CHECK_ROWS, frame.count())
    assert {f["name"] for f in meta["input_schema"]["fields"]} == set(frame.columns)
    monkeypatch.setattr(REG.PipelineModel, "load", lambda path: other)
    with pytest.raises(RuntimeError, match="scores differently"):
        REG.save_model(one, root + "/bad", {"a": 1}, check_rows=frame)
    with pytest.raises(Exception):
        REG.load_model(root + "/bad")


def test_study_stops_bad_trials_by_the_median_rule(spark, frame, monkeypatch):
    # RMSE of each trial's three folds; the fifth fails, the sixth draws level with the median
    script = [[1.0] * 3, [2.0] * 3, [3.0] * 3, [2.5, 2.5, 0.1], None, [2.0, 2.0, 0.5], [0.5, 9.0, 9.0]]
    calls, trial = [], [-1]

    def fake(folds, cfg, ks, params=None, **_):
        trial[0] += 0 in ks
        calls.append((trial[0], list(ks)))
        scores = script[trial[0]]
        return [((k + 1, 1, scores[k], 0.0, 0.0, None, 0.0, 0.0, "ok"), None, "") if scores else
                ((k + 1, 0, None, None, None, None, None, None, "failed"), None, "no rows") for k in ks]

    monkeypatch.setattr(P, "fit_folds", fake)
    rows = P.random_search(frame, CFG, n_trials=7, startup_trials=3).orderBy("trial").collect()
    assert [r.state for r in rows] == ["COMPLETE"] * 3 + ["PRUNED", "FAIL", "COMPLETE", "PRUNED"]
    assert [r.folds for r in rows] == [3, 3, 3, 2, 2, 3, 2]
    assert [r.cv_rmse for r in rows] == [1.0, 2.0, 3.0, None, None, 1.5, None]
    assert [r.best_so_far for r in rows] == [1.0] * 7 and rows[3].last_rmse == 2.5
    assert [ks for t, ks in calls if t in (0, 3, 5)] == [[0, 1, 2], [0, 1], [0, 1], [2]]
    best = P.best_params(spark.createDataFrame(rows))
    assert set(best) == set(P.SEARCH_SPACE) and 3 <= best["maxDepth"] <= 10 and 0.01 <= best["stepSize"] <= 0.15
    again = P.random_search(frame, CFG, n_trials=0)
    with pytest.raises(RuntimeError, match="no trial"):
        P.best_params(again)


def test_baselines_are_ranked_by_cross_validation(spark, frame):
    table = P.baselines_cv(frame, CFG, ("median", "gbt")).collect()
    assert [r["rank"] for r in table] == [1, 2] and {r.model for r in table} == {"median", "gbt"}
    assert table[0].rmse_mean <= table[1].rmse_mean and all(r.folds == 3 and r.fit_seconds_mean > 0 for r in table)
    # the same folds, one after the other
    one = P.PriceConfig(params=CFG.params, n_folds=3, parallel_folds=1)
    metrics, oof = P.cross_validate(frame, one)
    gbt = [r for r in table if r.model == "gbt"][0]
    assert abs(metrics.agg(F.avg("rmse")).first()[0] - gbt.rmse_mean) < 1e-9
    assert oof.count() == frame.count() == oof.select("listing_id").distinct().count()
    rmse = oof.groupBy("fold").agg(F.sqrt(F.avg((F.col("log_price") - F.col("predicted_log_price")) ** 2)).alias("r"))
    assert metrics.join(rmse, "fold").where(F.abs(F.col("rmse") - F.col("r")) > 1e-9).count() == 0


def test_training_job_in_tune_mode(spark, schema):
    mart = features.price_model_features(B.bound_part_listings(spark, SF))
    root = ensure_checkpoint_dir(spark) + f"/tune_{uuid.uuid4().hex[:8]}"
    v = jobs.run_price_training(spark, mart, root, schema, CFG, tune_trials=2, space={"maxDepth": [1, 2], "maxIter": [2]})
    trials = spark.read.parquet(f"{root}/exports/{v}/trials")
    meta = REG.load_model(f"{root}/{v}")[1]
    assert trials.count() == 2 and meta["params"] == P.best_params(trials)
    assert spark.read.parquet(f"{root}/exports/{v}/importance").count() == len(CFG.features)
    assert spark.table(f"{schema}.gold_ml_training_runs").first().training_mode == "tune"
    rows = spark.table(f"{schema}.gold_price_predictions")
    assert rows.where("prediction_type <> 'evaluation' or prediction_run_id is not null").count() == 0 < rows.count()


def test_current_segments_are_the_last_run(spark, schema):
    mart = features.cluster_model_features(B.bound_part_listings(spark, SF)).cache()
    root = ensure_checkpoint_dir(spark) + f"/seg_{uuid.uuid4().hex[:8]}"
    v = jobs.run_segmentation(spark, mart, root, schema, k=3, n_init=1)
    centroids = spark.read.parquet(f"{root}/exports/{v}/centroids")
    assert centroids.count() == 3 and {"accommodates", "cluster_name"} <= set(centroids.columns)
    assert any(c.startswith("room_type=") for c in centroids.columns)
    names = {r.metric_name for r in spark.table(f"{schema}.gold_ml_model_metrics").collect()}
    assert "silhouette" in names
    for run in ("one", "two"):
        jobs.run_segment_inference(spark, mart, run, schema, allow_candidate=True)
        now = spark.table(f"{schema}.{jobs.CURRENT_SEGMENTS}")
        assert now.count() == mart.count() and {r[0] for r in now.select("assignment_run_id").distinct().collect()} == {run}


def test_joins_count_unmatched_rows(spark):
    left, right = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    with pytest.raises(ValueError, match="1 left rows"):
        one_to_one_left_join(left, right, "k", require_match=True)
    assert one_to_one_left_join(left.where("k is not null"), right, "k", require_match=True).count() == 2
    assert orphans(left.union(left), right.union(right).where("k = 1"), "k").count() == 2


def test_price_binding_can_be_learnt_but_is_no_leak(spark):
    frame = features.modelling_frame(features.price_model_features(B.bound_part_listings(spark, "/root/testdata/sf0.01")))
    _, metrics, _ = P.train_evaluate(frame, P.PriceConfig(params={"maxDepth": 4, "maxIter": 10, "stepSize": 0.2}))
    assert 0.4 < metrics.first().r2 < 0.95


def test_sql_file_and_formats(spark, tmp_path):
    from staylake.sources import io
    (tmp_path / "q.sql").write_text("SELECT id,\n  :name AS name\nFROM range(:n) WHERE id >= 2")
    assert [tuple(r) for r in io.run_sql_file(spark, str(tmp_path / "q.sql"), {"n": 4, "name": "o'k; --"}).collect()] == [
        (2, "o'k; --"), (3, "o'k; --")]
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,\n')
    t = io.read_any(spark, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in t.collect()] == [("1", "x\ny"), ("2", None)]
    t.write.parquet(str(tmp_path / "t.parquet"))
    assert io.read_any(spark, str(tmp_path / "t.parquet")).count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        io.read_any(spark, str(tmp_path / "t.json"))
    with pytest.raises(ValueError, match="missing required"):
        io.select_available(t, ["a", "z"])
    for bad, kw in (("null_keys", {"key": "b"}), ("at least 3", {"min_rows": 3})):
        with pytest.raises(ValueError, match=bad):
            io.validate_frame(t, ["a"], **kw)
    with pytest.raises(ValueError, match="none of the tables"):
        io.first_existing_table(spark, ["no_such_table_a", "no_such_table_b"])
