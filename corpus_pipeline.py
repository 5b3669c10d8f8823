"""A training corpus from ``documents``: quality, near duplicates, repeated passages, mixture, batches.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and
returns a DataFrame; all but the last return the columns of documents. Between stages the documents
are written as Parquet and read again, so a stage is planned on its own and a lost executor costs
only that stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylake.llm import mixing, ngram_join, packing, paragraphs, quality
from staylake.llm._scratch import Scratch, free_name, small_side

#: Documents at or above this probability of good quality stay.
QUALITY = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the byte-level network, fitted on ``labels``, rejects.

    Null and empty texts are scored as padding and may go; repeated rows share their fate. All columns
    stay, whatever their names. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.held_out(F.col("doc_id")))
    net = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    name = free_name(docs, "_quality")
    return quality.score(docs, net, name).where(F.col(name) >= QUALITY).select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each group of near duplicates (five-word shingles, 0.8).

    Documents without words, and documents without id, are in no group and stay. Rows repeated
    under one id are one document: one row of them stays.
    """
    scratch = Scratch(spark)
    groups = scratch.write(ngram_join.jaccard_components(docs, n=5, percent=80).select("doc_id", "component_id"), "groups")
    gone = scratch.write(groups.where("doc_id is not null and doc_id <> component_id").select("doc_id").distinct(), "gone")
    again = scratch.write(groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "again")
    n_again = again.count()
    kept = docs.join(small_side(gone, gone.count()), "doc_id", "left_anti").select(docs.columns)
    if not n_again:
        return kept
    once = kept.join(small_side(again, n_again), "doc_id", "left_anti").select(docs.columns)
    return once.unionByName(kept.join(small_side(again, n_again), "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated paragraphs and passages, wherever their lines end, but for their first place; a document that keeps no word goes.

    Null and empty texts, and rows without doc_id, stay as they are. Rows repeated under one doc_id are
    one document and are cut alike. All columns stay; n_chars follows the text.
    """
    return paragraphs.remove_lines(docs, paragraphs.repeats(docs))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their weights: a document is returned once for each copy that the mix takes.

    Texts without words have no size: they stay with their source's certain copies only. Null is a
    source of its own; repeated rows are taken or left together. All columns stay, whatever their names.
    """
    name = free_name(docs, "_mix")
    mixed = mixing.mix_sources(docs, name=name).where(F.col(name).getField("copies") > 0)
    return mixed.withColumn(name, F.explode(F.sequence(F.lit(1), F.col(name).getField("copies").cast("int")))).select(docs.columns)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and token-budget batches of the mixed documents.

    Every row gets a slot: a null text counts as length 0, and copies are rows of their own.
    """
    return packing.pack(docs, mixing.word_count(F.col("text")))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixture),
    ("packing", length_packing),
]

#: Learned filters, hashed order and optimal boundaries have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written below the shared folder and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
