"""The dealt operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm import (
    centroids,
    chat,
    decontaminate,
    html_text,
    licences,
    line_dedup,
    mixing,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    toxicity,
    whitening,
)
from crowdpulse.llm.oracle import ORACLE  # noqa: F401
from crowdpulse.llm.tables import held_out, ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.protected(table(spark, sf_dir, "documents")))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), bits=3, size=3, seed=42)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text as it stays, and the words it lost (0: none)."""
    kept = line_dedup.remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", F.coalesce("removed_words", F.lit(0)).alias("removed_words"))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.allocation(table(spark, sf_dir, "documents"), (3, 1, 2), share=1.5, most=2.0))


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn and inserted turn of every conversation, with its piece of the rendered text."""
    return chat.render(table(spark, sf_dir, "conversations"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.3)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item, their similarity and its first word."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word")


@query
def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    counts = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select("doc_id", *(f"licences.{c}" for c in counts))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=16)


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5)
