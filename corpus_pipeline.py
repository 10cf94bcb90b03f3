"""From raw documents to a mixed training corpus: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the
shared folder and read again as the next one's documents. All but the last return the columns of
documents; the last adds shard, position, pass and words of the mix. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crowdpulse.llm import decontaminate, line_dedup, mixing, quality_classifier, simhash
from crowdpulse.llm.tables import release, ship, staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier scores 0.3 or more."""
    return quality_classifier.keep_good(docs, table(ship(spark), sf_dir, "labels"), threshold=0.3)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents but those of which nothing is left: repeated passages stay only where they are first."""
    ship(spark)
    count = "_removed"
    while count in docs.columns:
        count += "_"
    kept = line_dedup.remove_repeated(docs, count=count)
    return kept.where(kept[count].isNull() | (kept["text"] != "")).select(*[kept[f"`{c}`"] for c in docs.columns])


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents that link by SimHash."""
    ship(spark)
    return simhash.keep_one(docs, bits=3, size=3, seed=42)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; items of under five words count as whole documents only."""
    return decontaminate.remove(docs, table(ship(spark), sf_dir, "benchmark"), least_words=decontaminate.SHINGLE)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies the mix takes, with their place in its shards."""
    ship(spark)
    return mixing.mixture(docs, weights=(3, 1, 2), share=1.5, most=2.0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_passages),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
]

# Learned scores, SimHash and hashed orders have no SQL form; tests hold the rows against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
