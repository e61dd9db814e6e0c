"""A corpus pipeline from the operators of ``flowmart.llm``: each stage works on the written result of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowmart.llm import decontamination, exact, language, packing, simhash
from flowmart.llm.common import read_table, write_out
from flowmart.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or several learned languages; those without a letter go."""
    return language.keep_known(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints of three-word shingles that differ in 3 bits or fewer) the document with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in token sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenizing and packing cannot be said in SQL; tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spark.read.parquet(write_out(stage(spark, docs, sf_dir), "pipeline", name))
    return docs
