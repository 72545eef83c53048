"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterstar.llm import (
    clusters,
    fingerprints,
    importance,
    lexical,
    mixing,
    near_dup,
    outliers,
    packing,
    shards,
    substring,
    token_codes,
    topk,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS = {shard: 1.0 for shard in range(16)}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), 0.85)


@register
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_texts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), True, 1, 2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op4_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_codes.write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), False, 2)
    read = token_codes.read_tokens(manifest)
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


@register
def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.selection(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register
def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(documents(spark, sf_dir)).drop("distance")


@register
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


@register
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(documents(spark, sf_dir), SHARDS, {**SHARDS, len(SHARDS): 1.0})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    page = lambda c: F.regexp_extract(c, r"(-?[0-9]+)$", 1).try_cast("bigint")  # noqa: E731  a page without an id has none
    response = F.col("record_type") == "response"
    return records.select(
        page("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("bigint").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", F.when(~response, page("refers_to")).alias("refers_to"),
    )


@register
def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5, 256)


@register
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(documents(spark, sf_dir))
    return lexical.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 16, 3, 64, 64, 1)
