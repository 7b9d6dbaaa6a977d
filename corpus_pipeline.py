"""Corpus pipeline: documents in, sharded training documents out.

``STAGES`` lists the stages in order; each takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabscope.llm import decontam, mixing, near_dedup, quality, sharding
from tabscope.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the NB-SVM scores under 0.3 go; labels are learned from rows that aren't held out."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each near-duplicate group stays, the one with the smallest doc_id."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix takes them, sorted by ranges of training position."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the shard and slot of every document that the mix took (a row for each time)."""
    return sharding.shards(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("mixing_to_target_weights", mix),
    ("sharding", shard),
]

#: Classifiers and iterative grouping have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
