"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylake.llm._ship import ship
from staylake.session import ensure_checkpoint_dir


class Scratch:
    """Parquet tables of one operator call, below the folder named by ``spark.checkpoint.dir``.

    A written table cuts the lineage and survives the loss of executors. ``drop`` removes tables
    that the result no longer reads; the rest stays with the result.
    """

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Ids up to this many are sent to every task; beyond it the join is shuffled.
BROADCAST_IDS = 1_000_000


def small_side(ids: DataFrame, rows: int) -> DataFrame:
    """Marks a table of ids for a broadcast join only if its counted size allows it."""
    return F.broadcast(ids) if rows <= BROADCAST_IDS else ids


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it if a column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
