"""Centroid clustering against plain loops in whole numbers."""

import hashlib
import itertools
import math

import numpy as np
import pytest

from crowdpulse.llm import centroids as C
from crowdpulse.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int"


def plain(rows, k=40, rounds=5, scale=256):
    """rows of (vec_id, vector of floats)."""
    x = [[math.floor(scale * c) for c in v] for _, v in rows]
    names = [hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "null" for i, _ in rows]
    centroids = [v for _, v in sorted(zip(names, x))[:k]]

    def assign():
        out = []
        for v in x:
            away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for v, (n, _) in zip(x, own) if n == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    inertia = [sum(d for n, d in own if n == c) for c in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia), shas[c]) for (i, _), (c, d) in zip(rows, own)]


def test_query_equals_plain_loops(spark):
    d = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    expected = plain([(r.vec_id, r.embedding) for r in vectors])
    got = [tuple(r) for r in QUERIES["op13_centroid_clustering"](spark, d).collect()]
    assert sorted(got) == sorted(expected)


def test_clumps_copies_and_bad_rows(spark, monkeypatch):
    """A third of all rows are copies, clumps make small boxes, and blocks rule centroids out."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(6, 4)) * 5
    rows = [(int(k), [float(np.float32(c)) for c in middles[k % 6] + rng.normal(size=4) / 50]) for k in range(400)]
    rows += [(int(k), rows[0][1]) for k in range(400, 600)] + [rows[5], rows[5], (None, rows[7][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [math.nan] * 4), (903, []), (904, [1.0] * 5), (905, [-math.inf] * 4)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], KIND).withColumnRenamed("label", "cluster")
    monkeypatch.setattr(C, "BLOCK", 32)
    got = [tuple(r) for r in C.clustered(df, k=8, dims=4).collect()]
    assert sorted(got, key=str) == sorted(plain(rows, k=8), key=str)


def test_box_keeps_every_nearest_centroid():
    rng = np.random.default_rng(8)
    kept = 0
    for _ in range(200):
        centroids = rng.integers(-4, 5, (7, 3))
        x = rng.integers(-6, 7, 3) + rng.integers(0, 3, (20, 3))
        own = C.candidates(x.min(0), x.max(0), centroids)
        away = ((x[:, None] - centroids) ** 2).sum(2)
        assert set(away.argmin(1)) <= set(own.tolist())
        kept += len(own)
        number, distance = C.nearest(x, x.min(0), x.max(0), centroids)
        assert (number == away.argmin(1)).all() and (distance == away.min(1)).all()
    assert kept < 200 * 7 * 0.8


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = C.hilbert(cells, bits)
    path = cells[np.argsort(place)]
    assert len(set(place.tolist())) == len(cells)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("size", [2.0**15, 2.0**21, 2.0**60, 3e38])
def test_large_entries_stay_exact(spark, size):
    rng = np.random.default_rng(6)
    rows = [(k, [float(np.float32(c * size)) for c in rng.uniform(-1, 1, 2)]) for k in range(40)]
    got = sorted(tuple(r) for r in C.clustered(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND), k=3, dims=2).collect())
    cut = [tuple(None if isinstance(c, int) and c >= 1 << 63 else c for c in r) for r in sorted(plain(rows, k=3))]
    assert got == cut


def test_few_rows_and_none(spark):
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0, 4.0])]
    got = sorted(tuple(r) for r in C.clustered(spark.createDataFrame([(*r, 0) for r in few], KIND), dims=2).collect())
    assert got == sorted(plain(few))
    assert C.clustered(spark.createDataFrame([], KIND)).collect() == []
