"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from staylake.llm import (ann, hamming, hard_negatives, language, license_scan, line_dedup, mixing, ngram_join, oracles, packing,
                          paragraphs, quality, token_files, whitening)
from staylake.llm._scratch import Scratch

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, mixing.word_count(F.col("text")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = quality.held_out(F.col("doc_id"))
    langs, prototypes = language.learn_prototypes(docs.where(~held_out))
    return language.identify(docs, langs, prototypes, held_out)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(doc_id))
    net = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = quality.score(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", quality.held_out(doc_id).alias("held_out"), F.col("_quality").alias("score"), (F.col("_quality") >= 0.3).cast("int").alias("predicted"))


def op6_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hamming.top_k(codes, F.col("id") % 20 == 0, k=10).withColumnRenamed("id", "vec_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = Scratch(spark).path("tokens")
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER), special_as_text=False)
    return token_files.read_documents(manifest, folder)


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeats(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.copies") * F.col("_mix.size")).alias("taken"), "source", "_mix.copies")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.kept_texts(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, label = F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    finite = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = table(spark, sf_dir, "embeddings").where(finite & label.isNotNull())
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select(F.col("vec_id").alias("id"), moved.alias("label"), F.transform(v, lambda c: F.floor(c * 256.0).cast("long")).alias("x"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_ngram_join": op3_ngram_join,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_hamming": op6_hamming,
    "op7_token_files": op7_token_files,
    "op8_vectors": op8_vectors,
    "op9_paragraphs": op9_paragraphs,
    "op10_mixing": op10_mixing,
    "op11_line_dedup": op11_line_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op3_ngram_join": oracles.OP3_NGRAM_JOIN,
    "op10_mixing": oracles.OP10_MIXING,
    "op11_line_dedup": oracles.OP11_LINE_DEDUP,
    "op12_hard_negatives": oracles.OP12_HARD_NEGATIVES,
}
