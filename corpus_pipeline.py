"""A training corpus from raw documents: quality classifier, quality rules, near-duplicates, packing.

``STAGES`` lists (name, function) in order; each function gets what its predecessor kept, and the directory for the
tables that it needs besides.  ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.llm import near_duplicates, packing, quality_classifier, quality_rules
from tapelake.llm.common import cut, table
from tapelake.llm.queries import vocabulary_file

#: Least similarity of near-duplicates in hundredths.
LINK_PERCENT = 80


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality_classifier.filter_documents(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cascade."""
    return quality_rules.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked at similarity 0.8 or more."""
    return near_duplicates.deduplicate(docs, percent=LINK_PERCENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, vocabulary_file("word_bpe_49k.json"))


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: A network's scores and retrieval packing can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage keeps is cut from its lineage, since later stages read it often."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
