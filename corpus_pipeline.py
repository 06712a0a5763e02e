"""A training corpus from raw documents: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import exact, near, packing, suffix, toxicity
from gristmill.llm.common import Steps


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more of their five-word shingles the one with the smallest id stays."""
    return near.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes or more that start earlier in the corpus are cut out."""
    return suffix.drop_repeats(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one row for each piece of a document."""
    import public_tokenizers

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", toxic_documents),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("suffix_dedup", repeated_passages),
    ("packing", packed_sequences),
]

# A trained network and a tokenizer can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Steps(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = steps.keep(name, stage(spark, docs, sf_dir))
    return docs
