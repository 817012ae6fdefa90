"""The corpus operators as queries over the sample tables: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe_words, compression_quality, conversation_trie, hard_negatives, html_blocks, licenses, mixing, near_dup, quality_rules, secrets, token_files, url_filters, vector_search
from starloom.llm.common import find_package, new_path, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mixing.words_taken(mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "n_shards")


@query
def op2_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.scaled(table(spark, sf_dir, "embeddings"))
    return vector_search.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents")).drop("spans")


@query
def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = compression_quality.fitted(docs.filter(~held_out).join(labels, "doc_id"))
    rows = compression_quality.scored(docs, model)
    return rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(table(spark, sf_dir, "documents"))
    counts = [secrets.counted("base", name).alias(f"n_{name}") for name in secrets.KINDS[:3]]
    return found.select(F.col("doc.doc_id").alias("doc_id"), *counts, F.sha2(secrets.listed("base"), 256).alias("base_sha256"), secrets.listed("spans").alias("spans"))


@query
def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.groups(table(spark, sf_dir, "documents"), width=2, percent=80)


@query
def op7_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rows = html_blocks.extracted(pages, html_blocks.fitted(pages))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe_words.encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    rows = bpe_words.decoded(ids, path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected("base-1").alias("base_failed"), (~quality_rules.rejected()).alias("kept"), "failures",
    )


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2, added=True)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    # A page shows the document whose number ends its path: /en/853, /en/853/ or /en/853.html.
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[^/?#]*/([0-9]{1,18})(?:[/.?#]|$)', 1) AS BIGINT)")
    rows = url_filters.judged(pages, url_filters.outcomes(pages, labels, number))
    return rows.select(F.col("page.page_id").alias("page_id"), "host", "path", "rule", "verdict", "n_labelled", "n_bad", "bad_rate", "bad_bound")


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.whole_numbers(table(spark, sf_dir, "embeddings"), 256.0)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors.withColumn("label", moved.cast("int")), F.col("vec_id") % 100 == 0, positives=5, negatives=5, percent=80)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
