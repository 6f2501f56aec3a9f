"""From raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import (
    cuckoo_dedup,
    mixing,
    near_jaccard,
    quality_pu,
    queries,
    simhash_anchors,
)
from pairloom.llm.common import Scratch, table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = queries.trained_quality(spark, docs, sf_dir)
    return quality_pu.without_rejected(docs, model, queries.QUALITY_THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return cuckoo_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: first by SimHash, and of what is left by
    Jaccard similarity 0.8 of five-word shingles, which two differing bits cannot cover."""
    return near_jaccard.without_similar(simhash_anchors.without_near_copies(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of rarer sources up to twice."""
    return mixing.mixed(docs, queries.MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return queries.packed(spark, docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on what the one before has written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
