"""Whitening of embeddings: blockwise QR, bidiagonal form, dqds values, twisted directions.

Entries become whole numbers, and every distinct vector is fitted once. Tasks centre their rows and
reduce them block by block to a triangle R; triangles of many tasks are reduced together in rounds,
so that no task or driver holds more than a few. R has the size of a vector squared: the driver
brings it to bidiagonal form by Householder reflections, finds its singular values with dqds (no
squares are formed, so small values are as accurate as large ones), and each direction from the
twisted factorisation whose pivot is least; directions of values that almost coincide are made
orthogonal. Rows are then projected where they lie.

Rows whose vector is null, has a null or non-finite entry, or not the table's most frequent length
(ties: the longer) are dropped; so are empty vectors. Repeated rows each get their result; copies of
a vector count once in the fit. Directions without variance (constant or dependent entries) can't
be scaled to one and are left out; a table without variance, or an empty one, gives no rows. A null
vec_id is kept. Entries may be up to 1e150. Columns other than vec_id and the vector are not read, whatever their names. Sums
are exact. ``deviation`` is null where it doesn't fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.numbers import limbs, shape, summed
from crowdpulse.llm.tables import staged

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Rows of one QR step; triangles merged by one task of a merging round.
BLOCK_ROWS, FAN_IN = 1024, 32
EPS = np.finfo(float).eps
LONG = 1 << 63


class Fit(NamedTuple):
    n: int
    sums: tuple[int, ...]  # of each entry over the fit list
    values: np.ndarray  # variances, falling
    directions: np.ndarray  # one column per value
    total: float  # trace of the covariance


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with a whole, finite vector of the most frequent length, as doubles."""
    v = F.col(column).cast("array<double>")
    # A comparison with null is null, which is not true: such rows go.
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull()).where(finite & (F.size(v) > 0)).select("vec_id", v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["dims"] if sizes else -1))


def whole(column: pa.Array) -> np.ndarray:
    """x = floor(64 c) + 1000000 for a batch, as longs, or as Python numbers where longs can't hold them."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if values.size and np.abs(values).max() >= 1 << 53:  # as whole as a double gets
        rows = [[math.floor(c * SCALE) if abs(c) < 1 << 53 else int(c) * SCALE for c in row] for row in values.tolist()]
        return np.array(rows, object) + OFFSET
    return np.floor(values * SCALE).astype(np.int64) + OFFSET


def packed_rows(x: np.ndarray) -> pa.Array:
    """Each row as bytes: equal rows have equal bytes, whatever batch they come in."""
    out = []
    for row in x:
        low, high = (min(row), max(row)) if len(row) else (0, 0)
        if -LONG <= low and high < LONG:
            narrow = -(1 << 31) <= low and high < 1 << 31
            out.append(row.astype("<i4" if narrow else "<i8").tobytes())
        else:
            out.append(",".join(map(str, row)).encode() + b",big")
    return pa.array(out, pa.binary())


def unpacked_rows(column: pa.Array, dims: int) -> np.ndarray:
    rows = []
    for value in column:
        data = value.as_py()
        if data.endswith(b",big"):
            rows.append(np.array([int(c) for c in data[:-4].split(b",")], object))
        else:
            rows.append(np.frombuffer(data, "<i4" if len(data) == 4 * dims else "<i8").astype(np.int64))
    return np.array(rows) if rows else np.zeros((0, dims), np.int64)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """n x - S as whole numbers, and x - S / n as doubles."""
    if n * (int(np.abs(x).max()) if x.size else 0) < 1 << 61 and max(map(abs, sums), default=0) < 1 << 61:
        scaled = x.astype(np.int64) * n - np.array(sums, np.int64)
    else:
        scaled = x.astype(object) * n - np.array(sums, object)
    return scaled, (scaled / n).astype(float)


def fit_list(rows: DataFrame) -> DataFrame:
    """(x): every distinct vector of whole numbers once, packed. Copies merge before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([packed_rows(whole(batch.column("v")))], ["x"])

    return staged(rows.select("v").mapInArrow(run, "x binary").distinct(), "fit-list")


def totals(fit: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """Rows of the fit list and the exact sum of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, object)
        for batch in batches:
            x = unpacked_rows(batch.column("x"), dims)
            n += len(x)
            fits = x.dtype != object and len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
            sums = sums + (x.sum(0) if fits else x.astype(object).sum(0))
        if n:
            yield limbs([(k,) for k in range(-1, dims)], [n, *sums], ["k"])

    total = summed(fit.mapInArrow(run, shape(["k"])), ["k"])
    return (total[-1,], tuple(total[k,] for k in range(dims))) if total else (0, ())


def triangle(rows: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    return np.linalg.qr(rows if before is None else np.vstack([before, rows]), mode="r")


def reduced(parts: DataFrame) -> np.ndarray | None:
    """One triangle from (r), many: FAN_IN of them per task and round, the last few on the driver."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for value in batch.column("r"):
                out = triangle(square(value.as_py()), out)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([wide(out)], pa.binary())], ["r"])

    parts = staged(parts, "triangles")
    left = parts.count()
    while left > FAN_IN:
        parts = staged(parts.repartition(math.ceil(left / FAN_IN)).mapInArrow(merge, "r binary"), "triangles")
        left = parts.count()
    out = None
    for row in parts.toLocalIterator():
        out = triangle(square(bytes(row.r)), out)
    return None if out is None else square(wide(out))


def wide(r: np.ndarray) -> bytes:
    """A triangle of few rows, filled up with zeros to a square, as bytes."""
    full = np.zeros((r.shape[1], r.shape[1]))
    full[: len(r)] = r
    return full.tobytes()


def square(data: bytes) -> np.ndarray:
    side = math.isqrt(len(data) // 8)
    return np.frombuffer(data).reshape(side, side)


def gathered(fit: DataFrame, dims: int, n: int, sums: tuple[int, ...]) -> np.ndarray | None:
    """The triangle of all centred rows of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for k in range(0, len(batch), BLOCK_ROWS):
                x = unpacked_rows(batch.column("x").slice(k, BLOCK_ROWS), dims)
                out = triangle(centred(x, n, sums)[1], out)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([wide(out)], pa.binary())], ["r"])

    return reduced(fit.mapInArrow(run, "r binary"))


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, diagonal above it, and P of B = U' r P, by Householder reflections."""
    a, size = r.copy(), len(r)
    p = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        v[0] += math.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(v)
        return v / norm if norm else v

    for k in range(size):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < size - 2:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def dqds(q: Sequence[float], e: Sequence[float], moved: float = 0.0) -> np.ndarray:
    """Eigenvalues of L R with R = (q, 1), L = (1, e): squares of the singular values, falling.

    Each sweep moves the array by a shift below the least value; a shift that was too large shows as
    a negative entry and the sweep is done again with less, at last with none, which can't fail.
    ``moved`` is what earlier shifts have taken off.
    """
    q, e = [float(x) for x in q], [float(x) for x in e]
    found: list[float] = []
    sweeps, most = 0, 100 * len(q)
    while q:
        size = len(q)
        if size == 1:
            found.append(moved + q[0])
            break
        split = next((k for k in range(size - 2, -1, -1) if e[k] <= EPS * EPS * (moved + q[k])), None)
        if split is not None and split == size - 2:
            found.append(moved + q.pop())
            e.pop()
            continue
        if split is not None:
            found += [*dqds(q[: split + 1], e[:split], moved), *dqds(q[split + 1 :], e[split + 1 :], moved)]
            break
        sweeps += 1
        if sweeps > most:
            raise ArithmeticError("dqds does not converge")
        for shift in shifts(q, e):
            out = sweep(q, e, shift)
            if out:
                moved += shift
                q, e = out
                break
    return np.sort(np.array(found))[::-1]


def shifts(q: list[float], e: list[float]) -> tuple[float, ...]:
    """Guesses of the least value, falling to 0: the last 2 x 2 corner's, less its tie to the rest."""
    above = e[-2] if len(e) > 1 else 0.0
    total = q[-2] + above + q[-1] + e[-1]
    product = q[-2] * q[-1] + above * (q[-1] + e[-1])
    corner = 2 * product / (total + math.sqrt(max(0.0, total * total - 4 * product))) if total else 0.0
    corner = min(corner, min(q)) * (1 - 4 * EPS)
    tie = math.sqrt(q[-3] * e[-2]) if len(e) > 1 else 0.0
    return corner, max(0.0, corner - tie), 0.75 * corner, 0.25 * corner, 0.0


def sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One step of dqds, or nothing if the shift passes the least value."""
    d = q[0] - shift
    new_q, new_e = [], []
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        new_q.append(total)
        ratio = q[k + 1] / total if total else 0.0
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


class Twisted(NamedTuple):
    """Factors of B'B - value: from the top, from the bottom, and the pivots where they meet."""

    top: np.ndarray  # multipliers below the diagonal
    top_pivots: np.ndarray
    bottom: np.ndarray
    bottom_pivots: np.ndarray
    meeting: np.ndarray


def twisted(d: np.ndarray, e: np.ndarray, value: float) -> Twisted:
    """Stationary and progressive differential transforms of the bidiagonal's B'B - value."""
    size = len(d)
    tiny = EPS * EPS * max(1.0, float(np.max(d * d, initial=0)))
    q, link = d * d, e / np.where(d[:-1], d[:-1], tiny)  # B'B = L D L' with D = q, L below = e / d
    top, top_pivots = np.zeros(size - 1), np.zeros(size)
    s = np.zeros(size)
    s[0] = -value
    for k in range(size - 1):
        top_pivots[k] = s[k] + q[k] or tiny
        top[k] = q[k] * link[k] / top_pivots[k]
        s[k + 1] = top[k] * link[k] * s[k] - value
    top_pivots[-1] = s[-1] + q[-1] or tiny
    bottom, bottom_pivots = np.zeros(size - 1), np.zeros(size)
    p = np.zeros(size)
    p[-1] = q[-1] - value
    for k in range(size - 2, -1, -1):
        bottom_pivots[k + 1] = q[k] * link[k] ** 2 + p[k + 1] or tiny
        ratio = q[k] / bottom_pivots[k + 1]
        bottom[k] = link[k] * ratio
        p[k] = p[k + 1] * ratio - value
    bottom_pivots[0] = p[0] or tiny
    return Twisted(top, top_pivots, bottom, bottom_pivots, s + p + value)


def solve(t: Twisted, at: int, b: np.ndarray) -> np.ndarray:
    """x of (B'B - value) x = b by the factorisation twisted at ``at``."""
    size = len(b)
    y = b.astype(float).copy()
    for k in range(at):
        y[k + 1] -= t.top[k] * y[k]
    for k in range(size - 1, at, -1):
        y[k - 1] -= t.bottom[k - 1] * y[k]
    x = np.zeros(size)
    x[at] = y[at] / (t.meeting[at] or EPS)
    for k in range(at - 1, -1, -1):
        x[k] = y[k] / t.top_pivots[k] - t.top[k] * x[k + 1]
    for k in range(at + 1, size):
        x[k] = y[k] / t.bottom_pivots[k] - t.bottom[k - 1] * x[k - 1]
    return x


def block_directions(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for its (falling) values; B has no zero above its diagonal."""
    size = len(d)
    out = np.zeros((size, len(values)))
    group = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-5 * abs(values[j - 1]):
            group = j
        t = twisted(d, e, float(value))
        at = int(np.argmin(np.abs(t.meeting)))
        z = np.zeros(size)
        z[at] = 1
        for k in range(at - 1, -1, -1):
            z[k] = -t.top[k] * z[k + 1]
        for k in range(at + 1, size):
            z[k] = -t.bottom[k - 1] * z[k - 1]
        near = out[:, group:j]
        for step in range(3 if j > group else 0):
            # Values that almost coincide: iterate within what the earlier ones leave.
            z = z - near @ (near.T @ z)
            if np.linalg.norm(z) < 1e-3 and step == 0:
                z = np.cos(np.arange(1, size + 1) * (j + 1.0))
                z = z - near @ (near.T @ z)
            z = z / np.linalg.norm(z)
            z = solve(t, at, z)
            z = z / np.linalg.norm(z)
        z = z - near @ (near.T @ z)
        out[:, j] = z / np.linalg.norm(z)
    return out


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of r, falling, and its right singular vectors as columns."""
    size = r.shape[1]
    biggest = float(np.abs(r).max(initial=0))
    if not biggest:
        return np.zeros(size), np.eye(size)
    d, e, p = bidiagonal(r / biggest)
    norm = max(float(np.abs(d).max()), float(np.abs(e).max(initial=0)))
    # Zeros split the matrix; a zero on the diagonal is moved by less than rounding.
    d = np.where(np.abs(d) < EPS * norm, EPS * norm, d)
    cuts = [0, *(np.flatnonzero(np.abs(e) <= EPS * norm) + 1).tolist(), size]
    values, vectors = np.zeros(size), np.zeros((size, size))
    for a, b in zip(cuts, cuts[1:]):
        own_d, own_e = d[a:b], e[a : b - 1]
        values[a:b] = dqds(own_d**2, own_e**2)
        vectors[a:b, a:b] = block_directions(own_d, own_e, values[a:b])
    order = np.argsort(-values, kind="stable")
    return values[order] * biggest**2, p @ vectors[:, order]


def fitted(rows: DataFrame) -> tuple[Fit, DataFrame] | None:
    """The fit over the distinct vectors of ``usable`` rows, and the fit list; nothing without rows."""
    first = rows.select(F.size("v").alias("dims")).first()
    if not first:
        return None
    dims = first.dims
    fit = fit_list(rows)
    n, sums = totals(fit, dims)
    r = gathered(fit, dims, n, sums)
    values, vectors = directions(r)
    values = np.maximum(values / n, 0)
    # What rounding leaves of a direction without variance is far below this.
    real = values > (values[0] * (dims * EPS) ** 2 + (EPS * OFFSET / SCALE) ** 2)
    real &= np.sqrt(values) > np.sqrt(values[0]) * dims * EPS * 8
    return Fit(n, sums, values[real], vectors[:, real], float(values.sum())), fit


def whitened_rows(x: np.ndarray, own: Fit, components: int) -> np.ndarray:
    return centred(x, own.n, own.sums)[1] @ (own.directions[:, :components] / np.sqrt(own.values[:components]))


def identity_error(fit: DataFrame, own: Fit, components: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    dims, width = len(own.sums), min(components, len(own.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((width + 1, width))
        for batch in batches:
            w = whitened_rows(unpacked_rows(batch.column("x"), dims), own, components)
            out[:width] += w.T @ w
            out[width] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int32()), pa.array(out.ravel())], ["k", "part"])

    found = fit.mapInArrow(run, "k int, part double").groupBy("k").agg(F.sum("part").alias("s")).collect()
    total = np.zeros((width + 1) * width)
    for row in found:
        total[row.k] = row.s
    total = total.reshape(width + 1, width) / own.n
    spread = total[:width] - np.outer(total[width], total[width])
    return float(np.abs(spread - np.eye(width)).max())


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors, column)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fitted(rows)
    if not found or not len(found[0].values):
        return vectors.sparkSession.createDataFrame([], columns)
    own, fit = found
    width = min(components, len(own.values))
    error = identity_error(fit, own, components)
    shares = own.values[:width] / own.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(k, BLOCK_ROWS)
                x = whole(part.column("v"))
                if not len(x):
                    continue
                rows = len(x)
                far = apart(centred(x, own.n, own.sums)[0])
                owner = np.repeat(np.arange(rows), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(owner)),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * width, own.n)),
                        far.take(pa.array(owner)),
                        pa.array(whitened_rows(x, own, components).ravel()),
                        pa.array(np.tile(shares, rows)),
                        pa.array(np.full(rows * width, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, columns)


def apart(scaled: np.ndarray) -> pa.Array:
    """Sum of squares of each row, exact; null where a long can't hold it."""
    peak = max((abs(int(scaled.min())), abs(int(scaled.max()))) if scaled.size else (0, 0))
    if peak * peak * scaled.shape[1] < LONG:
        own = scaled.astype(np.int64)
        return pa.array((own * own).sum(1))
    sums = (scaled.astype(object) ** 2).sum(1)
    return pa.array([int(s) if s < LONG else None for s in sums], pa.int64())
