"""A training corpus from raw documents: clean, dedup, mask secrets, mix, tokenize.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet
to the shared work folder and reads again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bagminhash import one_of_each
from sluice.llm.common import WorkFolder, table, with_file_order
from sluice.llm.mixing import training_order
from sluice.llm.quality_rules import cleaned_documents
from sluice.llm.secret_scan import redacted_documents
from sluice.llm.sentencepiece_codec import encode_documents, piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines and refused documents go."""
    return cleaned_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place."""
    return redacted_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes, in training order."""
    return training_order(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row and its place in training order: ascending (training_part, training_row)."""
    place = ("training_part", "training_row")
    return encode_documents(with_file_order(docs, ["doc_id", "text"], *place), piece_model(), keep=place)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

# Similarity classes and token ids are beyond SQL; tests compare a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = WorkFolder(spark, "corpus_pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = folder.write(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            folder.drop(f"stage-{i - 1}")
    return docs
