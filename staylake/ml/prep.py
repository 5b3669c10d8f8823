"""Leakage-safe feature preparation on the cluster: splits, folds, imputation,
scaling, encoding. Statistics are fitted on the training rows only and applied
as one-row (proven-size) broadcasts or Spark ML models."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.operators.ranks import quantiles, quantiles_wide
from staylake.session import cut_lineage

# Hold-out share, folds, seed, rare-category threshold, fill label.
TEST_PERCENT = 20
N_FOLDS = 5
SEED = 42
MIN_FREQUENCY = 30
UNKNOWN_LABEL = "Unknown"
INFREQUENT_LABEL = "infrequent"
# Rows of a task that reads a spread table.
TASK_ROWS = 50_000


def key_hash(key: str | Column, seed: int | None = None) -> Column:
    """Portable 32-bit hash of a key: first 8 hex digits of md5 (same value in any SQL engine)."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if seed is not None:
        k = F.concat(k, F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, test_percent: int = TEST_PERCENT) -> DataFrame:
    """Adds ``is_test``: a repeatable hold-out by key hash (independent of partitioning)."""
    return df.withColumn("is_test", (key_hash(key) % 100) < test_percent)


def kfold_assign(df: DataFrame, key: str, n_folds: int = N_FOLDS) -> DataFrame:
    return df.withColumn("fold", (key_hash(key) % n_folds).cast("int"))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """The same rows dealt over tasks of about TASK_ROWS rows, by ``key`` (in turn without one), however few files or row groups hold them.

    A table that an iterative fit reads again and again is spread before it is cached: a small Parquet file of millions of
    rows is one task otherwise. The rows are counted first."""
    parts = max(1, -(-df.count() // TASK_ROWS))
    return df.repartition(parts, key) if key else df.repartition(parts)


def fit_medians(train: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row of exact (interpolated) medians; Spark's Imputer does not interpolate."""
    out = None
    for c in cols:
        m = quantiles(train, c, [0.5], [], [c], approx=approx)
        out = m if out is None else out.crossJoin(m)
    return out


def apply_fill(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """coalesce each fitted column with the one-row statistics."""
    stats = fitted.select(*[F.col(c).alias(f"_fit_{c}") for c in fitted.columns])
    j = df.crossJoin(F.broadcast(stats))
    return j.select(*[F.coalesce(F.col(c), F.col(f"_fit_{c}")).alias(c) if c in fitted.columns else F.col(c)
                      for c in df.columns])


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std per column (sklearn StandardScaler convention; 0 std -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return train.agg(*aggs)


def apply_scaler(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    j = df.crossJoin(F.broadcast(fitted))
    out = []
    for c in df.columns:
        if c in cols:
            std = F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
            out.append(((F.col(c) - F.col(f"{c}__mean")) / std).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, cols), cols)


def zscore_profile(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-score each column of a (small) profile matrix across its rows:
    population std, zero std -> 1, NULL -> 0."""
    z = apply_scaler(profile, fit_scaler(profile, cols), cols)
    return z.fillna(0.0, subset=list(cols))


def bucket_infrequent(train: DataFrame, df: DataFrame, col: str, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """Categories seen fewer than ``min_frequency`` times in training become 'infrequent'."""
    frequent = (train.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") >= min_frequency).select(F.col(col).alias("_frequent")))
    j = df.join(frequent, df[col] == frequent["_frequent"], "left")
    return j.withColumn(col, F.when(F.col(col).isNull(), F.col(col))
                        .when(F.col("_frequent").isNull(), F.lit(INFREQUENT_LABEL)).otherwise(F.col(col))).drop("_frequent")


def onehot_pipeline(cols: Sequence[str]) -> Pipeline:
    """Alphabetical index with an extra slot for unseen values, one-hot dropping that
    slot: an unseen category encodes as all zeros (sklearn handle_unknown='ignore')."""
    # one multi-column indexer: all vocabularies come from a single pass over the data
    stages = [StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols], handleInvalid="keep",
                            stringOrderType="alphabetAsc")]
    stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__oh" for c in cols],
                                dropLast=True, handleInvalid="error"))
    return Pipeline(stages=stages)


def hot_position(vec_col: str) -> Column:
    """0-based position of the 1.0 in a one-hot vector, -1 for all zeros."""
    return (F.array_position(vector_to_array(F.col(vec_col)), F.lit(1.0)) - 1).cast("int")


# ---------------------------------------------------------------- in-pipeline infrequent bucketing (M6)

from pyspark import keyword_only  # noqa: E402
from pyspark.ml import Estimator, Model  # noqa: E402
from pyspark.ml.param.shared import HasInputCols, Param, Params, TypeConverters  # noqa: E402
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,  # noqa: E402
                             MLReadable, MLReader, MLWritable, MLWriter)

# a vocabulary of up to this many values is applied as a literal list, a larger one by a join; same result
LITERAL_VALUES = 1000
# ... and is sent to every task only up to this many values
BROADCAST_VALUES = 100_000


class InfrequentBucketer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fit: per input column, the categories seen at least ``minFrequency`` times
    (one distributed group-by, kept as a table). Transform: every other non-NULL value -> 'infrequent'."""

    minFrequency = Param(Params._dummy(), "minFrequency", "minimum training count of a kept category",
                         typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, minFrequency=MIN_FREQUENCY):
        super().__init__()
        self._setDefault(minFrequency=MIN_FREQUENCY)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        cols = self.getInputCols()
        stacked = dataset.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("s")).select("s.*")
        frequent = (stacked.where(F.col("v").isNotNull()).groupBy("c", "v").count()
                    .where(F.col("count") >= self.getOrDefault(self.minFrequency)).select("c", "v"))
        model = InfrequentBucketerModel(inputCols=cols)
        return self._copyValues(model).with_vocabulary(frequent)


class InfrequentBucketerModel(Model, HasInputCols, MLReadable, MLWritable):
    """Holds the frequent categories as a table (c, v), saved as Parquet beside the parameters."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def with_vocabulary(self, vocabulary: DataFrame) -> "InfrequentBucketerModel":
        """A vocabulary that fits a literal list takes one job and no table; a larger one is kept as a checkpoint."""
        head = vocabulary.limit(LITERAL_VALUES + 1).collect()
        if len(head) <= LITERAL_VALUES:
            self.literal, self.size = head, len(head)
            self.vocabulary = vocabulary.sparkSession.createDataFrame(head, vocabulary.schema)
        else:
            self.literal, self.vocabulary = None, cut_lineage(vocabulary)
            self.size = self.vocabulary.count()
        return self

    def _transform(self, dataset):
        cols = self.getInputCols()
        if self.literal is not None:
            kept = {c: [r["v"] for r in self.literal if r["c"] == c] for c in cols}
            return dataset.withColumns({
                c: F.when(F.col(c).isNull() | F.col(c).isin(*v), F.col(c)).otherwise(F.lit(INFREQUENT_LABEL))
                for c, v in kept.items()})
        for c in cols:
            known = self.vocabulary.where(F.col("c") == c).select(F.col("v").alias("_known"))
            known = F.broadcast(known) if self.size <= BROADCAST_VALUES else known
            joined = dataset.join(known, dataset[c] == known["_known"], "left")
            keep = F.col(c).isNull() | F.col("_known").isNotNull()
            dataset = joined.withColumn(c, F.when(keep, F.col(c)).otherwise(F.lit(INFREQUENT_LABEL))).drop("_known")
        return dataset

    def write(self):
        return _BucketerWriter(self)

    @classmethod
    def read(cls):
        return _BucketerReader()


class _BucketerWriter(MLWriter):
    def __init__(self, model: InfrequentBucketerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.vocabulary.write.parquet(path.rstrip("/") + "/vocabulary")


class _BucketerReader(MLReader):
    def load(self, path: str) -> InfrequentBucketerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = InfrequentBucketerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.with_vocabulary(self.sparkSession.read.parquet(path.rstrip("/") + "/vocabulary"))


# ---------------------------------------------------------------- in-pipeline exact statistics (M3, M4)

def _double(v: float | None) -> str:
    """SQL text of a double, read back bit for bit."""
    return "CAST(NULL AS DOUBLE)" if v is None else f"double('{float(v)!r}')"


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the most frequent non-NULL value of each column, ties to the smallest (sklearn's rule); NULL if it has none.

    Counts of (column, value) are shuffled, then the best of each column is a one-row aggregate with map-side combining."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "_c", "_v")
    counts = long.where(F.col("_v").isNotNull()).groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(*[F.min(F.when(F.col("_c") == c, F.struct(-F.col("_n"), F.col("_v")))).getField("_v").alias(c) for c in cols])


class FillAndScale(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact statistics of the training rows as a pipeline stage, ``{c}__imp`` for each numeric ``c``.

    ``fill``: NULL and NaN become the interpolated median (0 where a column has no value), or stay.
    ``scale``: minus the mean, over the population standard deviation (1 if that is 0) of the filled column.
    The fitted stage is a plain ``SQLTransformer`` whose statement holds the numbers, so it is saved and read
    back with the pipeline, and scoring stays one projection. Two passes over the rows, whatever the columns."""

    fill = Param(Params._dummy(), "fill", "replace NULL and NaN by the median", typeConverter=TypeConverters.toBoolean)
    scale = Param(Params._dummy(), "scale", "centre and divide by the population std", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, fill=True, scale=True):
        super().__init__()
        self._setDefault(fill=True, scale=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cols = self.getInputCols()
        value = {c: f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))" for c in cols}
        if self.getOrDefault(self.fill):
            x = df.select(*[F.expr(value[c]).alias(c) for c in cols])
            row = quantiles_wide(x, cols, [0.5], names=["median"]).first()
            value = {c: f"coalesce({value[c]}, {_double(_or(row and row[f'{c}_median'], 0.0))})" for c in cols}
        if self.getOrDefault(self.scale):
            row = df.agg(*[f(F.expr(value[c])).alias(f"{n}{i}") for i, c in enumerate(cols)
                           for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
            value = {c: f"({value[c]} - {_double(_or(row[f'm{i}'], 0.0))}) / {_double(row[f's{i}'] or 1.0)}"
                     for i, c in enumerate(cols)}
        return SQLTransformer(statement="SELECT *, " + ", ".join(f"{value[c]} AS `{c}__imp`" for c in cols) + " FROM __THIS__")


class MostFrequentFill(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """NULL becomes the training rows' most frequent value, as text in ``{c}__filled``; ``UNKNOWN_LABEL`` if there is none."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        top = most_frequent(df, self.getInputCols()).first()
        quoted = {c: "decode(unhex('" + (UNKNOWN_LABEL if top[c] is None else top[c]).encode().hex() + "'), 'UTF-8')"
                  for c in self.getInputCols()}  # any text, whatever quotes it holds
        return SQLTransformer(statement="SELECT *, " + ", ".join(
            f"coalesce(CAST(`{c}` AS STRING), {q}) AS `{c}__filled`" for c, q in quoted.items()) + " FROM __THIS__")


def _or(v: float | None, default: float) -> float:
    return default if v is None else v
