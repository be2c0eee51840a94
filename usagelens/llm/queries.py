"""Registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import (
    alignment,
    compression,
    decontaminate,
    embeddings,
    languages,
    licenses,
    lines,
    minhash,
    mixing,
    negatives,
    pages,
    quality,
    shards,
    toxicity,
)
from usagelens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_classes(table(spark, sf_dir, "documents"))
    return found.drop("row")


def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = compression.held_out(F.col("doc_id"), 4, 2)
    model = languages.fit(documents, ~held)
    predicted = languages.predict(documents, model, ["doc_id"])
    return predicted.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", "class_id", "kept")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = compression.held_out(F.col("doc_id"), 4, 2)
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), ~held)
    scored = toxicity.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.PREDICT_FROM).cast("int").alias("predicted"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "pages")
    found = pages.extract(raw, pages.fit(raw), ["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return shards.write_shards(documents, scratch_path(spark, "shards"), shards.read_vocabulary())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = compression.held_out(F.col("doc_id"), 3, 1)
    model = quality.fit(documents, table(spark, sf_dir, "labels"), ~held)
    scored = quality.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= quality.PREDICT_FROM).cast("int").alias("predicted"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")))
    return found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(
        table(spark, sf_dir, "documents"), alignment.read_vocabularies(), ["doc_id"]
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


QUERIES = {
    "op1_lines": op1_lines,
    "op2_languages": op2_languages,
    "op3_minhash": op3_minhash,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_pages": op7_pages,
    "op8_shards": op8_shards,
    "op9_quality": op9_quality,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_alignment": op12_alignment,
    "op13_licenses": op13_licenses,
}
