"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir), works on all that the one
before it kept, and hands on the columns of ``documents``; the last returns the
packed pieces. Between stages the documents are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftlens.llm import classifier, packing, quality_rules, simhash, suffix_dedup
from driftlens.llm.common import table, written
from driftlens.llm.queries import vocabulary


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.keep(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_text(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("best_fit_packing", pack),
]

#: Neither the classifier nor the packing can be told in SQL; the stages are
#: tested against plain versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
