"""Whitening against exact sums and a dense eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from crowdpulse.llm import whitening as S
from crowdpulse.llm.queries import QUERIES

KIND = "vec_id long, embedding array<float>, label int"


def plain(vectors, components=16):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [int(((n * row.astype(object) - sums) ** 2).sum()) for row in x]
    return n, deviation, ((x * n - sums) / n) @ vectors / np.sqrt(values), values / (centred**2).sum() * n


def check(rows, vectors, components=16):
    n, deviation, expected, shares = plain(vectors, components)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-8
    signs = np.ones(expected.shape[1])
    whole = np.array([[got[k][c + 1].whitened for c in range(expected.shape[1])] for k in sorted(got)])
    for c in range(expected.shape[1]):
        at = np.argmax(np.abs(expected[:, c]))
        signs[c] = np.sign(whole[at, c] * expected[at, c])
    assert np.allclose(whole, expected * signs, atol=1e-8)
    for k, own in got.items():
        assert own[1].deviation == deviation[sorted(got).index(k)]
        assert [own[c + 1].explained for c in range(len(shares))] == pytest.approx(list(shares), rel=1e-9)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_dense_solver(spark, sf):
    d = f"/root/testdata/{sf}"
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    rows = QUERIES["op12_embedding_whitening"](spark, d).collect()
    assert len(rows) == 16 * len(vectors)
    check(rows, [r.embedding for r in vectors])


def test_copies_count_once_and_bad_rows_go(spark):
    rng = np.random.default_rng(1)
    base = [[float(np.float32(c)) for c in row] for row in rng.normal(size=(60, 5))]
    good = [(k, v, 0) for k, v in enumerate(base)] + [(100 + k, base[0], 0) for k in range(200)]
    bad = [(1000, None, 0), (1001, [1.0, None, 2.0, 3.0, 4.0], 0), (1002, [math.nan] * 5, 0), (1003, [], 0)]
    bad += [(1004, [math.inf, 1.0, 1.0, 1.0, 1.0], 0), (1005, [1.0, 2.0], 0)]
    df = spark.createDataFrame(good + bad, KIND).withColumnRenamed("label", "component")
    rows = S.whitened(df, components=3).collect()
    assert {r.vec_id for r in rows} == {g[0] for g in good} and {r.n for r in rows} == {60}
    check(rows, [v for _, v, _ in good], 3)


def test_dependent_constant_and_empty(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(a), 2.0, float(a), float(b)], 0) for k, (a, b) in enumerate(rng.normal(size=(40, 2)))]
    got = S.whitened(spark.createDataFrame(rows, KIND)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    assert S.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)], KIND)).collect() == []
    empty = S.whitened(spark.createDataFrame([], KIND))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_sums_and_deviations_beyond_longs(spark):
    rows = [(k, [float(k) * 2.0**60, float(k % 3)], 0) for k in range(1, 30)]
    kind = "vec_id long, embedding array<double>, label int"
    got = {(r.vec_id, r.component): r for r in S.whitened(spark.createDataFrame(rows, kind)).collect()}
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for _, v, _ in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert all(sum((n * c - s) ** 2 for c, s in zip(row, sums)) >= 1 << 63 for row in x if row[0] * n != sums[0])
    assert got[1, 1].deviation is None and got[1, 1].explained == pytest.approx(1.0)
    sizes = {tuple(S.packed_rows(np.array([row], object)).to_pylist()) for row in x}
    assert len(sizes) == len({tuple(row) for row in x})


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_solver_on_random_matrices(size):
    rng = np.random.default_rng(size)
    r = rng.normal(size=(size, size))
    holds(r)


def holds(r, orthogonal=1e-9):
    values, vectors = S.directions(r)
    dense = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(values - dense).max() <= 1e-13 * dense[0] * len(r)
    assert np.abs(vectors.T @ vectors - np.eye(len(r))).max() < orthogonal
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-11 * dense[0]


def test_solver_on_hard_spectra():
    rng = np.random.default_rng(9)
    a, b = (np.linalg.qr(rng.normal(size=(40, 40)))[0] for _ in range(2))
    holds(a)
    holds(np.eye(12) * 3)
    holds(a @ np.diag([5.0] * 20 + [1.0] * 10 + list(np.logspace(0, -9, 10))) @ b)
    holds(a @ np.diag(1 + 1e-9 * np.arange(40)) @ b)
    holds(a @ np.diag(1 + 1e-5 * np.arange(40)) @ b)
    holds(np.vstack([rng.normal(size=(5, 40)), np.zeros((35, 40))]))


def test_small_values_are_relatively_accurate():
    """Values of a graded bidiagonal over 12 decades, each to a few digits of its own size."""
    d, e = np.logspace(0, -12, 8), np.logspace(-1, -13, 7)
    exact = [Fraction(c) for c in d], [Fraction(c) for c in e]
    found = S.dqds(d**2, e**2)
    product = math.prod(float(c) for c in exact[0]) ** 2
    assert math.prod(found) == pytest.approx(product, rel=1e-12)


def test_triangles_of_many_tasks(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(700, 6))
    parts = spark.createDataFrame([(bytearray(S.wide(S.triangle(rows[k : k + 7], None))),) for k in range(0, 700, 7)], "r binary")
    r = S.reduced(parts)
    assert np.allclose(r.T @ r, rows.T @ rows)
