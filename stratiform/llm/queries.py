"""Registered queries of the operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    chat_repair,
    conversation_trie,
    decontaminate,
    html_text,
    jaccard_join,
    license_scan,
    packing,
    quality_rules,
    quality_trees,
    sharding,
    url_filter,
    warc,
)
from .common import table


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of the corpus's own mixture."""
    return packing.piece_digest(table(spark, sf_dir, "documents"))


def op2_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the n-gram model's verdict on every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op3_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL by longest match in the rule trie."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document by patience alignment with the templates."""
    return license_scan.license_digest(table(spark, sf_dir, "documents"))


def op6_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired and rendered turns of every conversation."""
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words found in every document."""
    return decontaminate.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_trees.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sampled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of near equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.page_digest(table(spark, sf_dir, "pages"))


def op11_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archive_digest(table(spark, sf_dir, "pages"))


def op12_centroid_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding."""
    return centroids.centroid_digest(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie.node_digest(table(spark, sf_dir, "conversations"))


CATALOG = {
    "op1_mixture_packing": (op1_mixture_packing, None),
    "op2_ngram_rules": (op2_ngram_rules, None),
    "op3_url_trie": (op3_url_trie, url_filter.ORACLE),
    "op4_patience_licenses": (op4_patience_licenses, None),
    "op6_chat_repair": (op6_chat_repair, None),
    "op5_jaccard_join": (op5_jaccard_join, None),
    "op7_decontaminate": (op7_decontaminate, None),
    "op8_quality_trees": (op8_quality_trees, None),
    "op9_sampled_shards": (op9_sampled_shards, None),
    "op10_host_suffixes": (op10_host_suffixes, None),
    "op11_warc_salvage": (op11_warc_salvage, warc.ORACLE),
    "op12_centroid_bounds": (op12_centroid_bounds, centroids.ORACLE),
    "op13_conversation_trie": (op13_conversation_trie, conversation_trie.ORACLE),
}
