"""SimHash near-dedup against a brute-force version."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from crowdpulse.llm import graph, simhash
from crowdpulse.llm.queries import QUERIES


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    runs = [words[k : k + 3] for k in range(len(words) - 2)] or [words]
    hashes = [xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """rows of (doc_id, fp): the smallest doc_id reachable, per fp."""
    fps = np.array(sorted({fp for _, fp in rows}), np.uint64)
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for f in fps:
        for g in fps[np.bitwise_count(fps ^ f) <= 3]:
            root[find(int(f))] = find(int(g))
    least = {}
    for d, fp in rows:
        if d is not None:
            least[find(fp)] = min(least.get(find(fp), d), d)
    return {int(f): least.get(find(int(f))) for f in fps}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    least = brute_components(rows)
    got = sorted(tuple(r) for r in QUERIES["op5_simhash_near_dedup"](spark, d).collect())
    assert got == sorted((i, f"{fp:016x}", least[fp]) for i, fp in rows)


def test_clustered_fingerprints_and_split_anchors(spark):
    rng = np.random.default_rng(7)
    centers = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = [0, 1, 3, 7, 15]
    for c in centers:
        for _ in range(60):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                x ^= 1 << int(b)
            fps.append(x - (1 << 64) if x >= 1 << 63 else x)
    rows = list(enumerate(fps))
    least = brute_components([(d, f & (1 << 64) - 1) for d, f in rows])
    marked = spark.createDataFrame(rows, "doc_id long, fp long")
    for residents in (4096, 5):
        got = {r.fp & (1 << 64) - 1: r.component_id for r in simhash.groups(marked, 3, residents).collect()}
        assert got == least


@pytest.mark.parametrize("bits", [1, 5])
def test_other_distances(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(-(1 << 62), 1 << 62, 30, dtype=np.int64)
    pairs = []
    for c in base:
        x = int(c)
        for b in rng.choice(63, bits, replace=False):
            x ^= 1 << int(b)
        pairs.append((int(c), x))
    nodes = spark.createDataFrame([(v,) for p in pairs for v in p], "fp long").distinct()
    found = {frozenset((r.a, r.b)) for r in simhash.links(nodes, bits).collect()}
    assert {frozenset(p) for p in pairs} <= found


def test_long_chain_and_star(spark):
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 400)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, **{1000 + k: 1000 for k in range(1, 400)}}
    assert graph.components(edges.limit(0)).count() == 0


def test_edges_of_the_table(spark):
    rows = [
        (3, "same words in this text here", "x"),
        (1, "same words in this text here", "y"),
        (1, "same words in this text here", "y"),
        (None, "same words in this text here", None),
        (5, None, "x"),
        (6, "", "x"),
        (7, " \t\n", "x"),
        (None, "lonely null identity row", "x"),
        (None, "another lonely null identity row", "x"),
        (9, "one two", "x"),
        (10, "very long text " * 60000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    marked = simhash.near_duplicates(docs)
    assert marked.count() == len(rows)
    by = {(r.doc_id, r.fp): r.component_id for r in marked.collect()}
    assert {v for (d, f), v in by.items() if f == 0} == {5}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:12]) for r in kept.collect()) == sorted(
        [(1, "same words i"), (5, ""), (0, "lonely null "), (0, "another lone"), (9, "one two"), (10, "very long te")]
    )
    empty = docs.where(F.lit(False))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
