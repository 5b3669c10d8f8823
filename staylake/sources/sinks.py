"""Writers: layer materialisation, versioned exports, staged table replacement."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Any, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def materialize(df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", bucket_by: tuple[str, int] | None = None,
                sort_by: list[str] | None = None) -> str:
    """Write a model as ``layer.name`` (Parquet table).

    Facts are partitioned for pruning; tables that are joined on the same key
    are bucketed on it with the same bucket count, so later joins read
    co-located buckets instead of shuffling both sides. Rows are brought together
    before the write, so a table has one file per bucket, or per partition value
    as many as its size needs (adaptive execution splits large values), and not
    one per task and value."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    if bucket_by:
        df = df.repartition(bucket_by[1], bucket_by[0])
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[1], bucket_by[0])
        if sort_by:
            w = w.sortBy(*sort_by)
    w.saveAsTable(f"{layer}.{name}")
    return f"{layer}.{name}"


def export_versioned(df: DataFrame, root: str, version: str, name: str, fmt: str = "parquet") -> str:
    """Write ``root/version/name`` and refuse to overwrite an existing version."""
    path = f"{root.rstrip('/')}/{version}/{name}"
    w = df.write.mode("errorifexists")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Versions of a published table, oldest first: their names hold the time they were written."""
    schema, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    return sorted(f"{schema}.{t.name}" for t in spark.catalog.listTables(schema)
                  if not t.isTemporary and t.name.startswith(f"{name}__v"))


def audit_counts(df: DataFrame, key: str, not_null: Sequence[str] = (),
                 ranges: dict[str, tuple[Any, Any]] | None = None) -> DataFrame:
    """One row, one pass: rows, distinct keys, NULL keys, NULLs of other columns, values outside closed ranges."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"),
                  F.count_if(F.col(key).isNull()).alias("null_keys"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
                  *[F.count_if(~F.col(c).between(lo, hi)).alias(f"outside_{c}") for c, (lo, hi) in (ranges or {}).items()])


def replace_staged(df: DataFrame, table: str, key: str, types: dict[str, str], expected_rows: int | None = None,
                   not_null: Sequence[str] = (), ranges: dict[str, tuple[Any, Any]] | None = None,
                   source: DataFrame | None = None, source_key: str | None = None, keep: int = 1) -> dict[str, int]:
    """Replace what ``table`` shows by ``df``, but only if the rows pass their audit once written.

    ``df`` has exactly the columns of ``types`` and is cast to them (ANSI: a value that does not fit is an
    error). It is written as a new version ``table__v...``; the audit reads that version: rows (``expected_rows``
    if given, at least one), a non-NULL unique key, ``not_null`` columns, closed ``ranges``, and as many rows as
    ``df`` has must join ``source``. Only then does the view ``table`` point to it, in one catalog change:
    readers see the old rows or the new ones, and after a failed audit, a failed write or a lost driver still
    the old ones. ``keep`` earlier versions stay for readers in flight. One writer per table. Returns the audit."""
    spark = df.sparkSession
    if len(set(df.columns)) != len(df.columns) or set(df.columns) != set(types):
        raise ValueError(f"{table}: columns must be {list(types)}, not {df.columns}")
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is no published view; move its rows to another name first")
    version = f"{table}__v{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:6]}"
    try:
        df.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]).write.format("parquet").saveAsTable(version)
        written = spark.table(version)
        audit = audit_counts(written, key, not_null, ranges).first().asDict()
        if source is not None:
            keys = source.select(F.col(source_key or key).alias(key))
            audit["joined_rows"] = written.select(key).join(keys, key).count()
        wrong = [c for c, n in audit.items() if (c.startswith("null_") or c.startswith("outside_")) and n]
        wrong += [c for c in ("distinct_keys", "joined_rows") if audit.get(c, audit["rows"]) != audit["rows"]]
        if not audit["rows"] or audit["rows"] != (audit["rows"] if expected_rows is None else expected_rows):
            wrong.append("rows")
        if wrong:
            raise ValueError(f"audit failed for {table} ({', '.join(wrong)}; expected rows: {expected_rows}): {audit}")
        spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for old in _versions(spark, table)[:-1 - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return audit
