"""Registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from poolwright.llm import (
    bpe, decontaminate, fill_in_middle, hard_negatives, html_extract, jaccard_join, kneser_ney, language_id, ratio_rules, suffix_dedup, toxic_passages, url_lists, warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_documents(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.filter_pages(table(spark, sf_dir, "pages"))


def op7_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratio_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op13_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_passages.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_bpe, op3_html_extract, op4_jaccard_join, op5_kneser_ney, op6_url_lists, op7_ratio_rules, op8_decontamination, op9_warc, op10_suffix_dedup,
        op11_fill_in_middle, op12_hard_negatives, op13_toxic_passages,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op4_jaccard_join": jaccard_join.DOCUMENTS_SQL, "op6_url_lists": url_lists.PAGES_SQL, "op9_warc": warc.PAGES_SQL,
    "op11_fill_in_middle": fill_in_middle.DOCUMENTS_SQL, "op12_hard_negatives": hard_negatives.EMBEDDINGS_SQL,
}
