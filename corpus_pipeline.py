"""From raw documents to token ids: rules, copies, secrets, mixing, encoding. Part of the starloom.llm subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe_words, mixing, near_dup, quality_rules, secrets
from starloom.llm.common import find_package, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules keeps."""
    return quality_rules.applied(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group on five-word shingles, similarity 0.8 or more."""
    find_package(spark)
    return near_dup.deduplicated(docs, width=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text."""
    marked = secrets.redacted(docs)
    return marked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each document and pass of the mix over it."""
    find_package(spark)
    return mixing.texts(mixing.mixed(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): ids of each text; round_trip is the digest of the bytes they decode to."""
    find_package(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe_words.encoded(docs, path, public_tokenizers.PATTERN)
    rows = bpe_words.decoded(ids, path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("round_trip"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixing", mixture),
    ("tokens", tokens),
]

# Byte-level BPE and the mix's draws have no SQL form; tests hold every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
