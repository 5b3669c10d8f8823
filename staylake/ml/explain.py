"""Model explanation on the cluster: native importances summed to the raw
features, permutation importance and partial dependence over all rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylake.ml.prep import spread
from staylake.ml.price import predict
from staylake.operators.topk import hash_order

# Fixed value: repeats of permutation importance.
N_REPEATS = 10
# rows that are shuffled among each other in one task
SHUFFLE_ROWS = 100_000


def slot_features(model: PipelineModel) -> list[str]:
    """The raw feature behind every slot of the assembled vector, from the stages' own input lists."""
    assemblers = [s for s in model.stages if isinstance(s, VectorAssembler)]
    numeric = [c.removesuffix("__num__imp") for c in assemblers[0].getInputCols()] if len(assemblers) > 1 else []
    width = {}
    for stage in model.stages:
        if isinstance(stage, OneHotEncoderModel):
            width = {c: n - 1 for c, n in zip(stage.getOutputCols(), stage.categorySizes)}  # the last slot is dropped
    slots = []
    for part in assemblers[-1].getInputCols():
        if part in width:
            slots += [part.removesuffix("__oh")] * width[part]
        else:
            slots += numeric if part == "_num_scaled" else [part.removesuffix("__missing")]
    return slots


def native_importance(model: PipelineModel, df: DataFrame, raw_features: Sequence[str]) -> DataFrame:
    """(feature, importance, rank): importances of the vector slots summed per raw feature; one row for each."""
    est = model.stages[-1]
    weights = est.featureImportances.toArray() if hasattr(est, "featureImportances") else abs(est.coefficients.toArray())
    total = dict.fromkeys(raw_features, 0.0)
    for name, w in zip(slot_features(model), weights, strict=True):
        total[name] += float(w)
    ranked = sorted(total.items(), key=lambda x: (-x[1], x[0]))
    rows = [(name, w, k) for k, (name, w) in enumerate(ranked, 1)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, rank int")


def _rmse(pred: DataFrame, target: str) -> float:
    return pred.agg(F.sqrt(F.avg((F.col(target) - F.col("predicted_log_price")) ** 2))).first()[0]


def shuffled_columns(df: DataFrame, key: str, cols: Sequence[str], seed: int, rows: int) -> DataFrame:
    """``df`` with ``_donor``: the columns of another row, every row giving once.

    Rows are dealt into random groups of about SHUFFLE_ROWS and each takes the values of the next
    row in a seeded hash order of its group, the last those of the first.
    """
    groups = max(1, -(-rows // SHUFFLE_ROWS))
    group = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(groups))
    order = Window.partitionBy("_group").orderBy(hash_order(key, seed), F.col(key))
    donor = F.struct(*cols)
    first = F.first(donor).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("_group", group).withColumn("_donor", F.coalesce(F.lead(donor).over(order), first)).drop("_group")


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], key: str,
                           target: str = "log_price", n_repeats: int = N_REPEATS, seed: int = 42) -> DataFrame:
    """Mean / std RMSE increase when one feature is shuffled over all rows; every repeat scores all features in one job."""
    features = list(features)
    needed = list(dict.fromkeys([key, target, *features, *[c for c in df.columns if c in set(slot_features(model))]]))
    rows = spread(df.select(*needed), key).cache()
    base = _rmse(predict(model, rows, target), target)
    n, found = rows.count(), []
    for r in range(n_repeats):
        donors = shuffled_columns(rows, key, features, seed + 1000 * r + 1, n)
        each = donors.withColumn("_feature", F.explode(F.array(*map(F.lit, features))))
        mixed = each.select("_feature", *[F.when(F.col("_feature") == c, F.col(f"_donor.{c}")).otherwise(F.col(c)).alias(c) if c in features else F.col(c)
                                          for c in needed])
        error = predict(model, mixed, target).groupBy("_feature").agg(F.sqrt(F.avg((F.col(target) - F.col("predicted_log_price")) ** 2)).alias("rmse"))
        found += [(x["_feature"], r, x["rmse"] - base) for x in error.collect()]
    rows.unpersist()
    res = df.sparkSession.createDataFrame(found, "feature string, repeat int, increase double")
    return res.groupBy("feature").agg(F.avg("increase").alias("importance_mean"),
                                      F.stddev_pop("increase").alias("importance_std")).orderBy(F.col("importance_mean").desc())


def partial_dependence(model: PipelineModel, df: DataFrame, feature: str, grid: Sequence[float],
                       target: str = "log_price") -> DataFrame:
    """Average predicted log price over all rows with ``feature`` set to each grid value."""
    values = F.explode(F.array(*[F.lit(float(v)) for v in grid]))
    expanded = spread(df.drop(feature)).withColumn("grid_value", values).withColumn(feature, F.col("grid_value"))
    pred = predict(model, expanded, target)
    return pred.groupBy("grid_value").agg(F.avg("predicted_log_price").alias("avg_predicted_log_price")).orderBy("grid_value")
