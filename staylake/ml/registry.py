"""Model persistence, training-run / registry / metric records, and batch inference.

Result tables are Parquet tables in the session catalog. Parquet has no
multi-table transaction, so a training run appends its run row and metric rows
first and its registry row LAST: readers select models only through the
registry, so a crash in between leaves no half-registered model.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone
from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.operators.topk import bounded_sample, champion_first
from staylake.session import cut_lineage

# Registry statuses.
CHAMPION, CANDIDATE, RETIRED = "CHAMPION", "CANDIDATE", "RETIRED"

# The result tables' columns.
RESULT_TABLES: dict[str, str] = {
    "gold_ml_training_runs": "run_id string, model_version string, model_task string, training_mode string, "
                             "model_name string, started_at timestamp, status string",
    "gold_ml_model_registry": "model_version string, model_task string, model_name string, artifact_path string, "
                              "status string, created_at timestamp",
    "gold_ml_model_metrics": "model_version string, model_task string, dataset_type string, metric_name string, "
                             "metric_value double, metric_std double, evaluated_at timestamp",
    "gold_price_predictions": "model_version string, listing_id bigint, actual_price double, predicted_price double, "
                              "actual_log_price double, predicted_log_price double, residual double, "
                              "absolute_error double, prediction_date timestamp, prediction_run_id string, "
                              "prediction_type string, predicted_at timestamp",
    "gold_listing_segments": "listing_id bigint, model_version string, cluster_id int, cluster_name string, "
                             "distance_to_centroid double, assigned_at timestamp, assignment_run_id string",
    "gold_segment_profiles": "model_version string, cluster_id int, cluster_name string, listing_count bigint, "
                             "median_price double, avg_price double, listing_share double, "
                             "accommodates_mean double, bedrooms_mean double, bathrooms_mean double, beds_mean double, "
                             "amenities_count_mean double, minimum_nights_log_mean double, dominant_room_type string, "
                             "dominant_property_base_group string, created_at timestamp",
}

# Result tables that grow by runs have one partition per run id. Hold-out rows have no run id: their version names them.
RUN_PARTITIONS = {"gold_price_predictions": "prediction_run_id", "gold_listing_segments": "assignment_run_id"}

# a batch names at most this many runs: their ids become literals of a partition filter
MAX_RUNS = 100

# rows that a saved model scores again before it is registered
CHECK_ROWS = 1000

# a table name is one or two plain words; anything that would need quoting is refused
_PLAIN_WORD = re.compile(r"[A-Za-z_]\w*", re.ASCII)


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_version(task: str) -> str:
    return f"{task}_v{now().strftime('%Y%m%d_%H%M%S_%f')}_{uuid.uuid4().hex[:6]}"


def safe_name(table: str) -> str:
    parts = table.split(".")
    if len(parts) > 2 or not all(_PLAIN_WORD.fullmatch(p) for p in parts):
        raise ValueError(f"{table!r} is not a plain [schema.]table name")
    return table


def ensure_tables(spark: SparkSession, schema: str | None = None, tables: dict[str, str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS for each result table, then add any column
    the declared schema has and the table lacks (additive evolution only)."""
    for name, ddl in (tables or RESULT_TABLES).items():
        full = safe_name(f"{schema}.{name}" if schema else name)
        by = f" PARTITIONED BY ({RUN_PARTITIONS[name]})" if name in RUN_PARTITIONS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({ddl}) USING parquet{by}")
        have = {f.name.lower() for f in spark.table(full).schema.fields}
        want = T._parse_datatype_string(ddl)
        missing = [f for f in want.fields if f.name.lower() not in have]
        if missing:
            cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in missing)
            spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({cols})")


def guarded_append(df: DataFrame, table: str, replace_partitions: bool = False) -> int:
    """Append by column name; refuse an empty frame. Returns the appended row count.

    With ``replace_partitions`` the partitions that ``df`` holds are replaced, the others stay."""
    safe_name(table)
    if df.isEmpty():
        raise ValueError(f"{table}: there are no rows to write")
    target = df.sparkSession.table(table).columns
    extra = [c for c in df.columns if c not in target]
    if extra:
        raise ValueError(f"columns {extra} not in {table}")
    # align by NAME to the table's column order, then insert (insertInto itself is positional)
    types = dict(df.sparkSession.table(table).dtypes)
    aligned = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in target])
    obs = Observation("append")
    counted = aligned.observe(obs, F.count(F.lit(1)).alias("rows"))
    if replace_partitions:
        spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            counted.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    else:
        counted.write.insertInto(table)
    return obs.get["rows"]


def written_runs(table: DataFrame, runs: Sequence[Row]) -> DataFrame:
    """Rows of the named runs. The ids are literals, so a table partitioned by them lists only their partitions."""
    named = F.lit(False)
    for run in runs:
        same = F.lit(True)
        for c, v in run.asDict().items():
            same = same & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        named = named | same
    return table.where(named)


def append_run_once(df: DataFrame, table: str, run_cols: str | Sequence[str], key: str, on_existing: str = "reject") -> int:
    """Idempotent run append. A run is named by ``run_cols`` (not all NULL); its rows have distinct keys.

    ``on_existing='reject'``: a run that the table holds already is an error and nothing is written.
    ``'replace'``: the run's partitions are replaced as a whole, so a retry gives the same table whatever an
    earlier attempt left; the table must be partitioned by ``run_cols``.

    The batch is computed once: the checks and the insert read its checkpoint. Of the table only the
    partitions of the batch's runs are read."""
    run_cols = [run_cols] if isinstance(run_cols, str) else list(run_cols)
    if on_existing not in ("reject", "replace"):
        raise ValueError("on_existing must be 'reject' or 'replace'")
    spark = df.sparkSession
    safe_name(table)
    if on_existing == "replace" and {c.name for c in spark.catalog.listColumns(table) if c.isPartition} != set(run_cols):
        raise ValueError(f"{table} is not partitioned by {run_cols}")
    df = cut_lineage(df)
    dup = df.groupBy(*run_cols, key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"batch has duplicate ({', '.join(run_cols)}, {key}) rows")
    runs = df.select(*run_cols).distinct().limit(MAX_RUNS + 1).collect()
    if len(runs) > MAX_RUNS or any(all(v is None for v in r) for r in runs):
        raise ValueError(f"a batch names 1 to {MAX_RUNS} runs, none of them NULL")
    if on_existing == "reject" and runs and not written_runs(spark.table(table), runs).isEmpty():
        raise ValueError(f"{run_cols} already written to {table}")
    return guarded_append(df, table, replace_partitions=on_existing == "replace")


def metric_records(spark: SparkSession, metrics: dict[str, float], model_version: str, model_task: str,
                   dataset_type: str, stds: dict[str, float] | None = None) -> DataFrame:
    """Long (model_version, model_task, dataset_type, metric_name, metric_value, metric_std, evaluated_at)."""
    ts = now()
    rows = [(model_version, model_task, dataset_type, k, None if v is None else float(v),
             None if (stds or {}).get(k) is None else float(stds[k]), ts) for k, v in metrics.items()]
    return spark.createDataFrame(rows, RESULT_TABLES["gold_ml_model_metrics"])


def metrics_long(wide: DataFrame, model_version: str, model_task: str, dataset_type: str) -> DataFrame:
    """One-row metric frame -> long metric records (stack on the cluster)."""
    names = [c for c, t in wide.dtypes if t in ("double", "float", "bigint", "int")]
    long = wide.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "metric_name", "metric_value")
    return long.select(F.lit(model_version).alias("model_version"), F.lit(model_task).alias("model_task"),
                       F.lit(dataset_type).alias("dataset_type"), "metric_name", "metric_value",
                       F.lit(None).cast("double").alias("metric_std"), F.current_timestamp().alias("evaluated_at"))


def scores_checksum(model: PipelineModel, rows: DataFrame, key: str) -> dict:
    """Rows scored and an order-free checksum over (key, prediction), prediction bits included."""
    scored = model.transform(rows).select(F.xxhash64(F.col(key), F.col(model.stages[-1].getPredictionCol())).alias("h"))
    return {k: str(v) for k, v in scored.agg(F.count(F.lit(1)).alias("rows"),
                                             F.sum(F.col("h").cast("decimal(38,0)")).alias("sum"),
                                             F.bit_xor("h").alias("xor")).first().asDict().items()}


def save_model(model: PipelineModel, path: str, metadata: dict, check_rows: DataFrame | None = None,
               key: str = "listing_id") -> str:
    """Persist the fitted pipeline and its metadata; never overwrite an existing version.

    With ``check_rows`` the saved model is read back and has to score the ``CHECK_ROWS`` rows with the smallest
    key hashes exactly as the fitted one does. Their schema and checksum go into the metadata, which is written
    last: an artifact that cannot be read back has none, and ``load_model`` refuses it."""
    model.write().save(path)  # fails if the path exists
    if check_rows is not None:
        sample = cut_lineage(bounded_sample(check_rows, key, CHECK_ROWS))
        fitted, saved = (scores_checksum(m, sample, key) for m in (model, PipelineModel.load(path)))
        if fitted != saved:
            raise RuntimeError(f"the model saved at {path} scores differently: {saved}, fitted: {fitted}")
        metadata = {**metadata, "input_schema": json.loads(check_rows.schema.json()), "load_check": fitted}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "metadata string") \
        .coalesce(1).write.mode("errorifexists").json(path.rstrip("/") + "_metadata")
    return path


def load_model(path: str) -> tuple[PipelineModel, dict]:
    spark = SparkSession.getActiveSession()
    model = PipelineModel.load(path)
    meta = json.loads(spark.read.json(path.rstrip("/") + "_metadata").first()["metadata"])
    return model, meta


def record_training(spark: SparkSession, schema: str | None, model_version: str, model_task: str, model_name: str,
                    artifact_path: str, metrics: DataFrame, training_mode: str = "retrain") -> str:
    """Append run row, metric rows, then the CANDIDATE registry row (the commit marker)."""
    pre = f"{schema}." if schema else ""
    run_id = uuid.uuid4().hex
    ts = now()
    run = spark.createDataFrame([(run_id, model_version, model_task, training_mode, model_name, ts, "SUCCESS")],
                                RESULT_TABLES["gold_ml_training_runs"])
    guarded_append(run, pre + "gold_ml_training_runs")
    guarded_append(metrics, pre + "gold_ml_model_metrics")
    reg = spark.createDataFrame([(model_version, model_task, model_name, artifact_path, CANDIDATE, ts)],
                                RESULT_TABLES["gold_ml_model_registry"])
    guarded_append(reg, pre + "gold_ml_model_registry")
    return run_id


def promote(spark: SparkSession, schema: str | None, model_task: str, model_version: str) -> None:
    """Explicit manual promotion: one append makes an existing version the CHAMPION and retires the task's old one."""
    pre = f"{schema}." if schema else ""
    reg = spark.table(pre + "gold_ml_model_registry")
    row = reg.where((F.col("model_version") == model_version) & (F.col("model_task") == model_task)).limit(1).collect()
    if not row:
        raise ValueError(f"unknown model version {model_version} for {model_task}")
    r = row[0]
    old = current_status(reg).where((F.col("model_task") == model_task) & (F.col("status") == CHAMPION)
                                    & (F.col("model_version") != model_version)).collect()
    ts = now()
    rows = [(x.model_version, x.model_task, x.model_name, x.artifact_path, RETIRED, ts) for x in old]
    rows.append((r.model_version, r.model_task, r.model_name, r.artifact_path, CHAMPION, ts))
    guarded_append(spark.createDataFrame(rows, RESULT_TABLES["gold_ml_model_registry"]).coalesce(1), pre + "gold_ml_model_registry")


def current_status(registry: DataFrame) -> DataFrame:
    """Latest status row per model version (status rows are append-only)."""
    from staylake.operators.dedup import latest_per_key
    return latest_per_key(registry, ["model_version"], [F.col("created_at").desc_nulls_last(), F.col("status")])


def check_one_champion(registry: DataFrame) -> DataFrame:
    """Tasks with more than one current champion (violations)."""
    cur = current_status(registry).where(F.col("status") == CHAMPION)
    return cur.groupBy("model_task").count().where(F.col("count") > 1)


def lookup_model(spark: SparkSession, schema: str | None, model_task: str, allow_candidate: bool = False):
    """Champion first (newest), a candidate only when allowed; errors when none."""
    pre = f"{schema}." if schema else ""
    reg = current_status(spark.table(pre + "gold_ml_model_registry"))
    bad = check_one_champion(reg).limit(1).collect()
    if bad:
        raise RuntimeError(f"more than one CHAMPION for {bad[0].model_task}")
    pick = champion_first(reg, model_task, allow_candidate).collect()  # at most one row
    if not pick:
        wanted = "champion or candidate" if allow_candidate else "champion"
        raise RuntimeError(f"{model_task}: the registry has no {wanted}")
    return pick[0]
