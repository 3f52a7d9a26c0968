"""A training-data pipeline over the documents, of five of the operators.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm import decontaminate, linededup, neardup, pieces, rows, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return toxicity.drop_toxic(docs, rows.table(spark, sf_dir, "labels"))


def dedupe_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated lines; documents of nothing else go."""
    return linededup.drop_emptied(docs)


def dedupe_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly benchmark go."""
    return decontaminate.remove_contamination(docs, rows.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the texts that are left."""
    ids = pieces.encode_column(spark, F.col("text")).alias("ids")
    return docs.select("doc_id", ids).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedupe_lines),
    ("near_dedup", dedupe_documents),
    ("decontamination", remove_benchmark),
    ("sentencepiece", encode),
]

# Learned scores, sketches and piece ids can't be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = rows.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
