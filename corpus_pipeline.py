"""Corpus pipeline over ``documents``: quality classifier, quality rules, near
copies, benchmark decontamination, packing.

Each stage is called as ``stage(spark, docs, sf_dir)`` on what its predecessor
kept, and all but the last return rows of ``docs`` unchanged:

- ``quality_classifier`` drops documents the boosted trees score below their threshold;
- ``quality_rules`` drops documents that fail the base rules or the n-gram model;
- ``jaccard_join`` keeps the smallest doc_id of each component of near copies;
- ``decontamination`` drops documents with benchmark words in at least one word of 20;
- ``packing`` returns the pieces of the rest with their place in the windows.

The two models learn from all labelled rows of the input folder's own tables,
not from what earlier stages left, so that rejected documents still teach.
Nulls, empty tables and extra columns behave as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm import decontaminate, jaccard_join, packing, quality_rules, quality_trees
from stratiform.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest = quality_trees.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_trees.keep_quality(docs, forest)


def quality_rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_passing(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digest(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rule_filter),
    ("jaccard_join", near_copies),
    ("decontamination", decontamination),
    ("packing", pack_windows),
]

#: Trained models and tokenizers are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
