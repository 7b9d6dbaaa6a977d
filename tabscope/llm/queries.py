"""The registered queries of the operators (``opN_<name>``) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm import (decontam, fingerprints, lexical_search, license_scan, mixing, near_dedup, ngram_join, periodic_runs, quality,
                          sharding, suffix_dedup, toxicity, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_minhash_near_dedup(spark, sf):
    """Bottom-k sketches, inverted lists, exact Jaccard on whole sets: one row per document."""
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


@query
def op7_counterfactual_toxicity(spark, sf):
    """Counterfactual-regularised classifier: one score per document."""
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_nbsvm_quality(spark, sf):
    """Naive Bayes support vectors: one score per document."""
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_curriculum_mixing(spark, sf):
    """Mix of all documents by schedules with integrals 1, 2, 3, repeating: targets, what the mix takes of each document
    and the training position of its first copy, sorted by ranges of position."""
    x = mixing.plan(table(spark, sf, "documents"))
    return x.select("doc_id", "size", "source_size", F.round("target", 2).alias("target"), "taken", "copies",
                    F.round("first_position", 6).alias("first_position"))


SQL["op5_curriculum_mixing"] = mixing.PLAN_SQL


@query
def op9_label_propagation_sharding(spark, sf):
    """Sixteen shards of even counts; documents with equal texts go together where the quotas allow it."""
    return sharding.shards(table(spark, sf, "documents"))


@query
def op3_license_diagonals(spark, sf):
    """License phrases and notices by diagonal voting: one row per document."""
    return license_scan.scan(table(spark, sf, "documents"))


@query
def op4_simhash_decontamination(spark, sf):
    """Documents that hold a benchmark item in an item-sized window: one row per document and item."""
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op6_warc_revisits(spark, sf):
    """Archives of all pages with equal payloads stored once, read back: one row per page."""
    return warc.digest_rows(table(spark, sf, "pages"))


SQL["op6_warc_revisits"] = warc.ROWS_SQL


@query
def op2_suffix_array_dedup(spark, sf):
    """Bytes covered by 100-byte strings that start earlier, removed from all documents."""
    return suffix_dedup.without_repeats(table(spark, sf, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


@query
def op1_spotsigs_fingerprints(spark, sf):
    """SpotSigs of every text, of its edited text and of the next document."""
    return fingerprints.compared(table(spark, sf, "documents"))


@query
def op11_blockmax_search(spark, sf):
    """The 50 best documents of each benchmark item by Block-Max MaxScore."""
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


SQL["op11_blockmax_search"] = lexical_search.SEARCH_SQL


@query
def op12_periodic_runs(spark, sf):
    """Runs of repeated words of every text (with the planted repeats of the contract): one row per document."""
    docs = periodic_runs.with_planted_repeats(table(spark, sf, "documents"))
    return periodic_runs.digests(periodic_runs.runs(docs))


@query
def op13_parity_sketch_join(spark, sf):
    """Documents whose 3-word shingle sets have Jaccard similarity 0.9: one row per document with its component."""
    return ngram_join.joined(table(spark, sf, "documents"))


SQL["op13_parity_sketch_join"] = ngram_join.components_sql(ngram_join.WORDS, ngram_join.PERCENT)
SQL["op10_minhash_near_dedup"] = ("SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM ("
                                  + ngram_join.components_sql(near_dedup.WORDS, 75) + ")")
