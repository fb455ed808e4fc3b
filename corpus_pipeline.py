"""A corpus from raw documents: quality, repeated lines, near copies, source weights, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and gives it to the next.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import jaccard_join, line_dedup, mixing, quality, sentencepiece_bpe
from tablekit.llm.common import with_text
from tablekit.llm.queries import piece_model
from tablekit.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or that the weighed votes call bad, go."""
    return quality.judge(docs, rows=True).where("kept").select("row.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return with_text(line_dedup.dedup_lines(docs), "kept", "text", docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a likeness of 0.8 or more, the one with the smallest id stays."""
    groups = jaccard_join.near_groups(docs, k=5, threshold=Fraction(8, 10))
    gone = groups.where("id <> component_id").select(F.col("id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of the text decoded from them."""
    return sentencepiece_bpe.encode_digests(docs, piece_model()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", repeated_lines),
    ("jaccard_join", near_copies),
    ("source_mix", source_weights),
    ("sentencepiece", tokens),
]

#: Expectation-maximisation is no SQL; tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
