"""Centroid clustering of vectors in Hilbert order, with zone maps that rule centroids out by blocks.

Vectors become whole numbers and are dealt by their place on a Hilbert curve over the entries that
vary most, so that a block of neighbours lies in a small box; the box (least and largest value of
each entry) is kept beside the block. Per round a block compares the bounds of its box's distance to
every centroid: a centroid that is farther than another one at every point of the box is no candidate
of the block. The test is on the difference of the two squared distances, which is linear in the
vector, so its least value over the box is exact. Rows are then compared with the candidates only, in
whole numbers, so no rounding decides a tie (ties: the smaller number).

Start: the ``k`` vectors with the smallest sha256 of ``2:<vec_id>`` (ties of repeated ids: the smaller
vector; a null id comes last). Each round assigns every vector, then replaces each non-empty centroid
by the floored mean of its vectors; a last assignment follows. With fewer than ``k`` vectors there are
as many centroids as vectors; an empty table gives no rows.

Rows whose vector is null, has not exactly ``dims`` entries, or has a null or non-finite one are
dropped; repeated rows each count and each get a result. Copies of a vector are spread over blocks by
a hash of their id and row, so none makes a hot task. Columns other than vec_id and the vector are not
read, whatever their names. Entries of any size are exact; a distance or an inertia that doesn't fit a
long is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.numbers import limbs, shape, sortable, summed
from crowdpulse.llm.tables import staged

SCALE, CENTROIDS, ROUNDS, DIMS, SEED = 256, 40, 5, 64, 2
#: Entries the curve runs through and its bits for each; vectors in a block.
CURVE_DIMS, CURVE_BITS, BLOCK = 15, 4, 512
LONG = 1 << 63
#: Sums of squares of entries below these bounds are exact in doubles and in longs.
IN_DOUBLE, IN_LONG = 1 << 22, 1 << 27


def usable(vectors: DataFrame, column: str, dims: int) -> DataFrame:
    """(vec_id, v): rows with ``dims`` finite entries, as doubles."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(v.isNotNull() & (F.size(v) == dims)).where(finite).select("vec_id", v.alias("v"))


def whole(values: np.ndarray, dims: int) -> np.ndarray:
    """floor(256 x), as longs or, where those can't hold it, as Python numbers."""
    values = values.reshape(-1, dims)
    if values.size and np.abs(values).max() >= 1 << 53:  # as whole as a double gets
        return np.array([[math.floor(c * SCALE) if abs(c) < 1 << 53 else int(c) * SCALE for c in row] for row in values.tolist()], object)
    return np.floor(values * SCALE).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (whole numbers below 2 ** bits), as unsigned longs.

    Axes are turned into the curve's transposed form bit plane by bit plane, from the highest: where
    a bit is set the lower bits of the first axis flip, elsewhere they change places with that axis;
    a Gray code over the axes follows. Columns times bits may be 63 at most.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    for plane in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << plane), np.uint64((1 << plane) - 1)
        for k in range(n):
            is_set = (x[k] & bit) > 0
            change = np.where(is_set, np.uint64(0), (x[0] ^ x[k]) & low)
            x[0] ^= np.where(is_set, low, change)
            x[k] ^= change
    for k in range(1, n):
        x[k] ^= x[k - 1]
    gray = np.zeros(x.shape[1], np.uint64)
    for plane in range(bits - 1, 0, -1):
        bit = np.uint64(1 << plane)
        gray ^= np.where((x[n - 1] & bit) > 0, bit - np.uint64(1), np.uint64(0))
    x ^= gray
    place = np.zeros(x.shape[1], np.uint64)
    for plane in range(bits - 1, -1, -1):
        for k in range(n):
            place = place << np.uint64(1) | (x[k] >> np.uint64(plane)) & np.uint64(1)
    return place


def extent(rows: DataFrame, dims: int) -> list[tuple[int, float, float]]:
    """The entries that vary most: (number, least, largest value)."""
    at = rows.select(F.posexplode("v").alias("d", "c")).groupBy("d")
    found = at.agg(F.min("c").alias("low"), F.max("c").alias("high"), F.var_pop("c").alias("spread")).collect()
    # An overflowing variance counts as the largest.
    spread = {r.d: r.spread if r.spread is not None and r.spread == r.spread else float("inf") for r in found}
    found = sorted(found, key=lambda r: (-spread[r.d], r.d))[: min(CURVE_DIMS, dims)]
    return [(r.d, r.low, r.high) for r in found]


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(ids, x, low, high): blocks of neighbouring vectors, packed, with the box of each."""
    curve = extent(rows, dims)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = [d for d, _, _ in curve]
        low = np.array([a for _, a, _ in curve])
        high = np.array([b for _, _, b in curve])
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            # Halves first: the width of a column may be more than a double holds.
            width = np.maximum(high / 2 - low / 2, np.finfo(float).tiny)
            cells = (v[:, at] / 2 - low / 2) / width * (1 << CURVE_BITS)
            cells = np.clip(cells, 0, (1 << CURVE_BITS) - 1)
            key = hilbert(cells, CURVE_BITS).astype(np.int64)
            x = whole(v, dims)
            packed = [pack(row) for row in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(key)], ["vec_id", "x", "key"]
            )

    def pile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), BLOCK):
                part = batch.slice(k, BLOCK)
                x = unpack([v.as_py() for v in part.column("x")], dims)
                ids = pa.ListArray.from_arrays([0, len(part)], part.column("vec_id"))
                flat = pack(x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([b], pa.binary()) for b in (flat, pack(x.min(0)), pack(x.max(0))))],
                    ["ids", "x", "low", "high"],
                )

    placed = rows.mapInArrow(place, f"vec_id {kind}, x binary, key long")
    # Copies of a vector have one key; the hash deals them over several ranges.
    dealt = staged(placed.withColumn("spread", F.xxhash64("vec_id", F.monotonically_increasing_id())), "placed")
    ordered = dealt.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread")
    columns = f"ids array<{kind}>, x binary, low binary, high binary"
    return staged(ordered.select("vec_id", "x").mapInArrow(pile, columns), "blocks")


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes: a letter for the width, then the numbers."""
    low, high = int(values.min()), int(values.max())
    for letter, width in (("h", 15), ("i", 31), ("q", 63)):
        if -(1 << width) <= low and high < 1 << width:
            return letter.encode() + values.astype(f"<i{(width + 1) // 8}").tobytes()
    return b"," + ",".join(map(str, values)).encode()


def unpack(rows: list[bytes], dims: int) -> np.ndarray:
    out = []
    for data in rows:
        letter = data[:1].decode()
        if letter == ",":
            out.append(np.array([int(c) for c in data[1:].split(b",")], object))
        else:
            out.append(np.frombuffer(data[1:], {"h": "<i2", "i": "<i4", "q": "<i8"}[letter]).astype(np.int64))
    return np.concatenate(out).reshape(-1, dims)


def start(found: DataFrame, k: int, dims: int) -> np.ndarray:
    """The first centroids, in the order of their hashes."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, str, bytes]] = []
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("x")):
                x = unpack([data.as_py()], dims)
                own = []
                for n, value in enumerate(ids.values):
                    name = value.as_py()
                    # A null id has no hash and sorts after all hexadecimal ones.
                    own.append(("null" if name is None else hashlib.sha256(f"{SEED}:{name}".encode()).hexdigest(), n))
                own = sorted(own)
                last = own[min(k, len(own)) - 1][0]
                best += [(d, ",".join(map(sortable, x[n])), pack(x[n])) for d, n in own if d <= last]
                best = sorted(best)[:k]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*best)], ["digest", "name", "x"])

    # Each task sends its k best.
    rows = found.select("ids", "x").mapInArrow(digests, "digest string, name string, x binary")
    rows = rows.orderBy("digest", "name").limit(k).collect()
    return exact(unpack([bytes(r.x) for r in rows], dims)) if rows else np.zeros((0, dims), np.int64)


def exact(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if not x.size or np.abs(x).max() < 1 << 62 else x


def peak(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector of the box.

    Against the centroid p that is nearest to the box's middle, c is out if at every point of the box
    |x - c|^2 - |x - p|^2 > 0, or = 0 at the least and p has the smaller number.
    """
    if max(map(peak, (low, high, centroids))) >= IN_LONG:
        low, high, centroids = (a.astype(object) for a in (low, high, centroids))
    middle = (low + high) // 2
    away = ((centroids - middle) ** 2).sum(1)
    pivot = int(np.argmin(away))
    p = centroids[pivot]
    slope = -2 * (centroids - p)
    norms = (centroids * centroids).sum(1)
    least = np.minimum(slope * low, slope * high).sum(1) + norms - norms[pivot]
    numbers = np.arange(len(centroids))
    kept = (least < 0) | ((least == 0) & (numbers < pivot))
    kept[pivot] = True
    return np.flatnonzero(kept)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance to it, exact, for each row of a block."""
    numbers = candidates(low, high, centroids)
    own = centroids[numbers]
    bound = max(peak(x), peak(own))
    if bound < IN_DOUBLE:  # all terms and sums are whole numbers below 2 ** 53
        a, b = x.astype(float), own.astype(float)
        apart = (b * b).sum(1) - 2 * (a @ b.T)
        best = apart.argmin(1)
        distance = apart[np.arange(len(x)), best] + (a * a).sum(1)
        return numbers[best], distance.astype(np.int64)
    kind = np.int64 if bound < IN_LONG else object
    a, b = x.astype(kind), own.astype(kind)
    apart = np.stack([((a - c) ** 2).sum(1) for c in b], 1)
    best = np.array([int(np.argmin(row)) for row in apart])
    return numbers[best], apart[np.arange(len(x)), best]


def assigned(batch: pa.RecordBatch, centroids: np.ndarray, dims: int):
    """Per block of a batch: its ids, vectors, clusters and distances."""
    for ids, *packs in zip(*(batch.column(c) for c in ("ids", "x", "low", "high"))):
        x, low, high = (unpack([b.as_py()], dims) for b in packs)
        yield ids.values, x, *nearest(x, low[0], high[0], centroids)


def totals(found: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """Vectors, summed distance and summed entries of each cluster, exact: one row per cluster."""
    k, names = len(centroids), ["cluster", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 2), object)
        for batch in batches:
            for _, x, cluster, distance in assigned(batch, centroids, dims):
                small = peak(x) < IN_LONG
                for c in np.unique(cluster):
                    own = cluster == c
                    entries = x[own].sum(0) if small else x[own].astype(object).sum(0)
                    sums[c] += np.array([int(own.sum()), sum(map(int, distance[own])), *entries], object)
        at = np.flatnonzero(sums[:, 0]).tolist()
        keys = [(c, d) for c in at for d in range(dims + 2)]
        yield limbs(keys, [sums[key] for key in keys], names)

    out = np.zeros((k, dims + 2), object)
    for key, value in summed(found.mapInArrow(run, shape(names)), names).items():
        out[key] = value
    return out


def moved(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floored means of the clusters; an empty one stays."""
    rows = [own[2:] // own[0] if own[0] else c.astype(object) for c, own in zip(centroids, sums)]
    return exact(np.array(rows, object).reshape(centroids.shape))


def clustered(
    vectors: DataFrame,
    column: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    found = blocks(usable(vectors, column, dims), dims)
    centroids = start(found, k, dims)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], columns)
    for _ in range(rounds):
        centroids = moved(centroids, totals(found, centroids, dims))
    inertias = totals(found, centroids, dims)[:, 1].tolist()
    digests = [hashlib.sha256(",".join(str(int(c)) for c in row).encode()).hexdigest() for row in centroids]
    inertia = sum(inertias)

    def long(value: int) -> int | None:
        return int(value) if value < LONG else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, cluster, distance in assigned(batch, centroids, dims):
                own = cluster.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(own, pa.int32()),
                        pa.array([long(v) for v in distance], pa.int64()),
                        pa.array([long(inertias[c]) for c in own], pa.int64()),
                        pa.array([long(inertia)] * len(own), pa.int64()),
                        pa.array([digests[c] for c in own]),
                    ],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return found.mapInArrow(run, columns)
