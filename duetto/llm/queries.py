"""Registered queries of this package, one ``opN_<name>`` for each operator.

Each reads its whole table and returns the operator's result in the columns that
the query's contract names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duetto.llm import (bpe, centroids, decontam, language, licenses, neardup, packing, prefixtrie, quality, secrets,
                        topk, toxicity, urls)
from duetto.llm.common import table
from duetto.llm.oracle import SQL  # noqa: F401

WORD_BPE = "word_bpe_49k.json"
OP3_PERCENT = 85            # of the union, by the query's contract


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), OP3_PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.vocabulary_file(WORD_BPE))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of several lengths."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdict of every document."""
    return quality.judge_quality(table(spark, sf_dir, "documents")).drop("failed", "host_rate")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations."""
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_language, op2_secrets, op3_neardup, op4_bpe, op5_urls,
                                   op6_packing, op7_quality, op8_topk, op9_licenses, op10_toxicity,
                                   op11_prefix_trie, op12_centroids, op13_decontamination)}
