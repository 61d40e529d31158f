"""Corpus pipeline: toxicity, language, repeated lines, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's input.  All stages but the last return the columns of
``documents``.  No stage can be expressed in SQL, so there is no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensoria.llm import language, line_dedup, minhash, packing, toxicity
from sensoria.session import configure, cut_lineage

def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not reject; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_harmless(docs, toxicity.train(docs, labels))


def of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: neither without letters nor ambiguous."""
    return language.keep_identified(docs, language.train(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one."""
    return line_dedup.drop_repeated_lines(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return minhash.keep_first(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences, sources mixed in the corpus's own proportions."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("language", of_known_language),
    ("line_dedup", without_repeated_lines),
    ("minhash", without_near_duplicates),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next begins."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
    return docs
