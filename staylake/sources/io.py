"""Format dispatch, optional-column scans, table discovery, parameterised SQL."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions.cleaning import columns_exist


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV (header, all text) or Parquet by suffix; anything else is an error."""
    p = path.lower().rstrip("/")
    if p.endswith(".csv") or p.endswith(".csv.gz"):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if p.endswith(".parquet") or p.endswith(".pq"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported input format: {path}")


def select_available(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Required columns plus the optional ones that exist; error listing missing required ones."""
    missing = columns_exist(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*required, *[c for c in optional if c in df.columns and c not in required])


def first_existing_table(spark: SparkSession, candidates: Sequence[str]) -> str:
    for t in candidates:
        if spark.catalog.tableExists(t):
            return t
    raise ValueError(f"none of the tables exist: {list(candidates)}")


def validation_counts(df: DataFrame, key: str | None = None, finite: Sequence[str] = ()) -> DataFrame:
    """The one-pass validation aggregate: rows, NULL / duplicate keys, non-finite values per column."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key:
        aggs += [F.count_if(F.col(key).isNull()).alias("null_keys"),
                 (F.count(F.col(key)) - F.count_distinct(key)).alias("duplicate_keys")]
    for c in finite:
        x = F.col(c).cast("double")
        aggs.append(F.count_if(x.isNotNull() & (F.isnan(x) | (F.abs(x) == float("inf")))).alias(f"nonfinite_{c}"))
    return df.agg(*aggs)


def validate_frame(df: DataFrame, required: Sequence[str], key: str | None = None, finite: Sequence[str] = (),
                   min_rows: int = 1) -> dict[str, int]:
    """Driver-side schema checks plus ONE aggregate pass for row count, NULL /
    duplicate keys and non-finite features. Raises on the first problem."""
    if not df.columns:
        raise ValueError("frame has no columns")
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("duplicate column names")
    missing = columns_exist(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    res = validation_counts(df, key, finite).first().asDict()
    if res["rows"] < min_rows:
        raise ValueError(f"need at least {min_rows} rows, have {res['rows']}")
    bad = {k: v for k, v in res.items() if k != "rows" and v}
    if bad:
        raise ValueError(f"validation failed: {bad}")
    return res


def run_sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Parameterised SQL (named ``:param`` markers bound by Spark, never string-formatted)."""
    return spark.sql(text, args=args or {})


def run_sql_file(spark: SparkSession, path: str, args: dict[str, Any] | None = None) -> DataFrame:
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())  # one small file
    return run_sql(spark, text, args)
