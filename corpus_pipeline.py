"""From raw documents to token shards: filter, deduplicate, decontaminate, mix, write.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``docs`` is the stored table
its predecessor returned. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.llm import compression, decontaminate, minhash, mixing, shards, toxicity
from usagelens.llm.common import stored
from usagelens.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the same part of the labels as the
    registered query."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = ~compression.held_out(F.col("doc_id"), 4, 2)
    return toxicity.accepted(docs, toxicity.fit(docs, labels, learn))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their weights."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the shards, which go to the shared folder."""
    return shards.write_shards(docs, scratch_path(spark, "shards"), shards.read_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Classifiers, sketches and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
