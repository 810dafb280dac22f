"""Corpus pipeline: documents -> quality, line dedup, near dedup, decontamination, mix.

Each stage takes the documents that its predecessor kept, reread from Parquet, and returns the
columns of ``documents``; the last adds what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import stage, table
from shelfcast.llm.decontaminate import drop_contaminated
from shelfcast.llm.knn_quality import keep_quality
from shelfcast.llm.lines import dedup_document_lines
from shelfcast.llm.mixing import mix_documents
from shelfcast.llm.near_dups import keep_one


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote rejects go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its documents; every document stays."""
    return dedup_document_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the least doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with size, source_size, target and taken (words, repeats counted);
    a document of which nothing is taken goes."""
    return mix_documents(docs).where(F.col("taken") > 0)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
]
#: The classifier, the signatures and the flow are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and reread as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
