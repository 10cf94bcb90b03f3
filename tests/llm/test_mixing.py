"""Mixing: targets against a plain filling, exact quotas and draws, and the edges of the table."""

import random
from collections import Counter, defaultdict
from math import comb

import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import mixing
from crowdpulse.llm.queries import QUERIES


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        out = {s: most * sizes[s] if s in full else rest * w[s] / sum(w[x] for x in open_) for s in sizes}
        over = {s for s in open_ if out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def check(rows, docs):
    """rows of (doc_id, size, source_size, target, taken) against the documents (doc_id, text, source)."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    source = {d: s for d, _, s in docs}
    taken = Counter()
    for doc_id, size, source_size, target, took in rows:
        s = source[doc_id]
        assert source_size == sizes[s] and target == pytest.approx(want[s]) and 0 <= took <= 2 * size
        taken[s] += took
    assert len(rows) == len(docs)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_meets_its_targets_and_reruns_agree(spark, sf):
    d = f"/root/testdata/{sf}"
    documents = spark.read.parquet(f"{d}/documents.parquet")
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    rows = sorted(map(tuple, QUERIES["op7_source_mixing"](spark, d).collect()))
    check(rows, docs)
    shuffled = mixing.digest(mixing.allocation(documents.orderBy(F.rand(3)).repartition(5)))
    assert rows == sorted(map(tuple, shuffled.collect()))


def odd_documents(spark):
    rng = random.Random(1)
    docs = [(k, "w " * rng.randrange(0, 60), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for k in range(400)]
    docs += [(500, "w " * 30_000, "b"), (501, None, "void"), (502, "", "void"), (503, "only one", "tiny")]
    return docs


def test_small_blocks_shards_and_the_mix(spark):
    docs = odd_documents(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns(
        {"shard": F.lit("x"), "copies": F.lit(1), "text_hash": F.lit("h"), "size": F.lit(0), "rank": F.lit(2)}
    )
    options = {"block_words": 300, "shard_words": 9000}
    allocated = mixing.allocation(df, **options)
    check(sorted(map(tuple, mixing.digest(allocated).collect())), docs)
    mix = mixing.mixture(df, **options)
    assert mix.columns == [*df.columns, "mix_shard", "mix_position", "mix_pass", "mix_words"]
    rows = mix.collect()
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.mix_words
    assert taken == {r.doc_id: r.taken for r in mixing.digest(allocated).collect() if r.taken}
    assert len({(r.doc_id, r.mix_pass) for r in rows}) == len(rows)
    places = defaultdict(list)
    for r in rows:
        places[r.mix_shard].append(r.mix_position)
    assert len(places) > 3 and all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    empty = df.where(F.lit(False))
    assert mixing.allocation(empty).count() == 0 and mixing.mixture(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.digest(mixing.allocation(nothing)).collect()] == [0, 0]


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, "w " * 10, "a")] * 7 + [(None, "v " * 12, None)] * 3 + [(2, "x " * 9, "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.digest(mixing.allocation(df)).collect()
    assert len(rows) == len(docs) and abs(sum(r.taken for r in rows) - 1.5 * 115) <= 1.5 and all(r.taken <= 2 * r.size for r in rows)
    mix = mixing.mixture(df).collect()
    assert sum(r.mix_words for r in mix) == sum(r.taken for r in rows)


def test_quotas_are_exact(spark):
    draws = spark.createDataFrame([("a", 1000), ("b", 37), (None, 260), ("c", 1)], "source string, draws long")
    rows = mixing.quotas(draws, 7).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        assert r.quota >= 0
        by_source[r.source] += r.quota
        by_shard[r.shard] += r.quota
    assert by_source == {"a": 1000, "b": 37, None: 260, "c": 1}
    assert set(by_shard) == set(range(7)) and max(by_shard.values()) - min(by_shard.values()) <= 3
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.quotas(draws, 7).collect()))


@pytest.mark.parametrize("total, good, drawn", [(10, 4, 5), (50, 7, 20), (6, 6, 3), (9, 0, 4), (5, 2, 0), (40, 39, 38)])
def test_hypergeometric_distribution(spark, total, good, drawn):
    n = 4000
    u = spark.range(n).select(((F.col("id") + 0.5) / n).alias("u"))
    x = mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(drawn), F.col("u"))
    counts = Counter(r.x for r in u.select(x.alias("x")).collect())
    for k in range(max(0, drawn + good - total), min(good, drawn) + 1):
        share = comb(good, k) * comb(total - good, drawn - k) / comb(total, drawn)
        assert abs(counts.pop(k, 0) / n - share) <= 1.5 / n
    assert not counts
