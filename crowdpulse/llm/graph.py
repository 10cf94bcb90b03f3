"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.tables import staged


def _size(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that isn't its component's smallest; edges has longs a and b.

    Alternates two rounds until nothing changes: each node links its larger neighbours to the
    smallest of its neighbourhood, then itself and its smaller neighbours to their smallest. Both
    keep the number of edges, so a node with very many neighbours is a hot key on the many side
    of a join only; the minimum per node is merged before its shuffle.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = staged(edges.where("a <> b").select(high, low).distinct(), "edges")
    before = _size(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.union(smallest).distinct(), "edges")
        now = _size(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
