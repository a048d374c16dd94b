"""The document pipeline: each stage reads what its predecessor kept, written as Parquet in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmart.llm import decontaminate, jaccard, packing, phrases, toxicity
from parcelmart.llm.common import small_batches, table
from parcelmart.llm.queries import vocabulary
from parcelmart.shared import written


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the field trained on ``labels`` scores at its threshold or above go."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, folder, "documents"), table(spark, folder, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents connected by a likeness of 0.8 over shingles of five words one stays."""
    return jaccard.keep_one(docs, size=5, likeness=80)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Passages of 35 words or more that recur go from the texts, and documents that consist of them."""
    return phrases.drop_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a window of ten words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents left and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

# The first stage is a trained model, which SQL cannot express; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, folder)
        if number < len(STAGES):
            docs = written(docs, name)
    return docs
