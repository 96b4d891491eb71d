"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftlens.llm import bpe, classifier, codes, filter_audit, fingerprints, html, packing, quality_rules, simhash, suffix_dedup, token_files, urls, warc
from driftlens.llm.common import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The tokenizer file that the queries use, on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary())


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


QUERIES = {
    "op1_document_fingerprints": fingerprints.query,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": html.query,
    "op4_bpe": op4_bpe,
    "op5_suffix_array_dedup": suffix_dedup.query,
    "op6_simhash": simhash.query,
    "op7_url_filters": op7_url_filters,
    "op8_warc": op8_warc,
    "op9_quality_classifier": classifier.query,
    "op10_quality_rules": quality_rules.query,
    "op11_vector_codes": codes.query,
    "op12_filter_audit": filter_audit.query,
    "op13_token_files": op13_token_files,
}

ORACLE = {
    "op1_document_fingerprints": fingerprints.ORACLE,
    "op7_url_filters": urls.oracle_sql(),
    "op8_warc": warc.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_vector_codes": codes.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}
