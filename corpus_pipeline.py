"""A corpus from language identification to tokens, stage by stage.

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last returns one row of digests per document.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.llm import bpe, decontaminate, jaccard_join, language_id, suffix_dedup
from poolwright.llm.common import column
from poolwright.session import scratch, work_folder


def settle(spark: SparkSession) -> None:
    """Rows of documents are large: smaller batches to Python bound a task's memory, and shuffle files go with their query."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null text, no letter); sets ``lang`` where it is null."""
    settle(spark)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), column(docs, "text", "string").alias("text"))
    found = language_id.identify(rows, language_id.fit(docs), keep=("row",)).filter(F.col("lang_pred") != language_id.UNKNOWN)
    names = [(c, F.col("row").getField(c)) for c in docs.columns]
    return found.select(*[(F.coalesce(value, F.col("lang_pred")) if c == "lang" else value).alias(c) for c, value in names])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles join at 0.8: the smallest id, of equal ids one row.

    Documents without a word stay.
    """
    settle(spark)
    return jaccard_join.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out byte strings of 200 bytes and more that repeat, at every place; no copy stays.

    Documents that have nothing left but white space go.
    """
    settle(spark)
    return suffix_dedup.without_repeats(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    settle(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), whole=True)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document and the digest of their decoded text."""
    settle(spark)
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("decontaminate", drop_benchmark),
    ("bpe", encode_tokens),
]

#: Suffix automata, signatures and tokens have no counterpart in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
