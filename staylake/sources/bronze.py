"""Raw CSV drop -> bronze tables (every column read as text)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw drop layout (table -> candidate files in priority order) and required files.
SOURCE_CANDIDATES: dict[str, tuple[str, ...]] = {
    "listings": ("listings.csv", "listings.csv.gz"),
    "calendar": ("calendar.csv", "calendar.csv.gz"),
    "reviews": ("reviews.csv", "reviews.csv.gz"),
    "neighbourhoods": ("neighbourhoods.csv",),
}
# The tables with free text, whose fields can hold line breaks.
FREE_TEXT_TABLES = ("listings", "reviews")
REQUIRED_FILES = ("listings.csv", "calendar.csv", "reviews.csv", "neighbourhoods.csv", "neighbourhoods.geojson")


def list_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(path, name, length) of the files in a folder. Only metadata columns are
    selected, so the binary-file source never reads file contents."""
    files = spark.read.format("binaryFile").load(raw_dir).select("path", "length")
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1))


def missing_required(spark: SparkSession, raw_dir: str, required: Sequence[str] = REQUIRED_FILES,
                     gz_ok: Sequence[str] = ("listings.csv", "calendar.csv", "reviews.csv")) -> DataFrame:
    """Required files absent from the folder (a ``.gz`` twin satisfies the CSVs in ``gz_ok``)."""
    present = list_files(spark, raw_dir).select("name")
    manifest = spark.createDataFrame([(r, r + ".gz" if r in gz_ok else r) for r in required], "name string, alt string")
    hit = manifest.join(present, (manifest["name"] == present["name"]) | (manifest["alt"] == present["name"]), "left_semi")
    return manifest.select("name").subtract(hit.select("name"))


def resolve_sources(spark: SparkSession, raw_dir: str,
                    candidates: dict[str, tuple[str, ...]] = SOURCE_CANDIDATES) -> dict[str, str]:
    """First existing candidate per table; raises when a table has none."""
    files = list_files(spark, raw_dir)
    cand = spark.createDataFrame([(t, n, i) for t, names in candidates.items() for i, n in enumerate(names)],
                                 "table_name string, name string, priority int")
    best = cand.join(files, "name").groupBy("table_name").agg(F.min_by("path", "priority").alias("path"))
    found = {r.table_name: r.path for r in best.collect()}  # one row per table
    missing = [t for t in candidates if t not in found]
    if missing:
        raise FileNotFoundError(f"no source file for {missing} in {raw_dir}")
    return found


def header_columns(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names from the header line only."""
    return spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, partitions: int | None = None, multi_line: bool = True) -> DataFrame:
    """All-text read (no inference): quoted fields with doubled quotes, over several lines if ``multi_line``.
    multi-line and gzip input cannot be split, so the rows are spread right after the read; other
    input is split by Spark itself."""
    cols = header_columns(spark, path, multi_line)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    df = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("quote", '"')
          .option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    if not multi_line and not path.endswith(".gz"):
        return df
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(n)


def load_bronze(spark: SparkSession, raw_dir: str, schema: str = "bronze") -> dict[str, int]:
    """Recreate one bronze table per source; returns the row count of each load,
    observed during the write itself (no second scan)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    counts = {}
    for table, path in resolve_sources(spark, raw_dir).items():
        obs = Observation(f"load_{table}")
        df = read_raw_csv(spark, path, multi_line=table in FREE_TEXT_TABLES).observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.mode("overwrite").saveAsTable(f"{schema}.bronze_{table}")
        counts[table] = obs.get["rows"]
    return counts
