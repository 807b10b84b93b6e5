"""Training-corpus pipeline: each stage takes all documents its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's documents.
Every stage but the last returns the columns of ``documents``; the last replaces the
text by its pieces.  ``run`` applies all stages to the table ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.llm.common import materialise, table
from tabforge.llm.line_dedup import drop_repeated_lines
from tabforge.llm.quality_llr import keep_good
from tabforge.llm.sentencepiece_scan import encode_documents
from tabforge.llm.simhash_dedup import keep_first
from tabforge.llm.spaced_seed import drop_contaminated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the quality rules reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: lines repeated from an earlier document go; every document stays."""
    return drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group stays, that with the smallest id."""
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a benchmark passage go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the text becomes SentencePiece ids."""
    return encode_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", pieces),
]

#: Fingerprints, hashed n-grams and pieces have no SQL form: tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
