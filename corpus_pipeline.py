"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadfeat.llm.mixing import mixed_documents
from roadfeat.llm.packing import pack
from roadfeat.llm.quality import good_documents
from roadfeat.llm.queries import GOOD_FROM, table, tokenizer
from roadfeat.llm.shared import new_path
from roadfeat.llm.simhash import one_of_each_group
from roadfeat.llm.suffix_dedup import deduplicated_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of those that are not held out."""
    return good_documents(docs, table(spark, sf_dir, "labels"), GOOD_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each_group(docs, width=3, radius=2)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long strings that occur twice; those of which no word is left go."""
    return deduplicated_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document; a second row has those that it takes twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each training sequence, with its ids."""
    return pack(docs, tokenizer("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("mixture", mixture),
    ("packing", packing),
]
#: The classifier, the fingerprints and the tokens have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
