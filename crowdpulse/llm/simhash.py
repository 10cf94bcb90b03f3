"""Near-duplicate documents by SimHash, compared at the anchors of a covering code.

A fingerprint has 64 bits; two link at up to ``bits`` differing bits. It is split into blocks, so
few that one of them differs in at most one bit (3 bits: two halves). Within a block the anchors
are the words of a code with covering radius 1: a Hamming code on the first 2^r - 1 bits, the other
bits free. Every fingerprint has one home anchor within the radius, and visits every anchor within
radius plus threshold, 2: 17 of the 2^27 anchors of a half. If two fingerprints differ in at most
one bit of a block, each visits the other's home, so comparing visitors with residents at every
anchor misses no pair. A code for all 64 bits at once would need several hundred visits each.

Only distinct fingerprints take part. An anchor with very many residents is split: residents by
hash, visitors to every part. Each comparison batch sends on a spanning forest of the links it
found, never all pairs.

Null and empty texts have fingerprint 0 and link like others. A null doc_id is no component's
name unless it stands alone; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from xxhash import xxh64_intdigest

from crowdpulse.llm.graph import components
from crowdpulse.llm.tables import packed, staged, text_of, unpacked

WIDTH = 64
#: Residents of an anchor from which it is split, and pairs compared at a time.
RESIDENTS, PAIRS = 4096, 1 << 20


def shingle_hashes(text: str, size: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, or of all words if there are fewer."""
    words = text.encode().lower().split()  # on bytes: A-Z, and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    ends = list(accumulate(map((1).__add__, map(len, words)), initial=0))
    n = len(words) - size + 1
    runs = (xxh64_intdigest(joined[s : e - 1], seed) for s, e in zip(ends, ends[size:]))
    return np.fromiter(runs, np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    votes = np.zeros(WIDTH, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, size: int = 3, seed: int = 42) -> Column:
    @arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([majority(shingle_hashes(t.as_py() or "", size, seed)) for t in texts], pa.int64())

    return run(text)


def _blocks(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the fewest blocks of which one has at most one differing bit."""
    n = max(2, bits // 2 + 1)
    edges = [WIDTH * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _syndrome(x: Column, r: int) -> Column:
    """Which of the 2^r - 1 bits is off the nearest code word, counted from 1; 0: none."""
    total = F.lit(0)
    for k in range(r):
        mask = sum(1 << (place - 1) for place in range(1, 1 << r) if place >> k & 1)
        total = total + (F.bit_count(x.bitwiseAND(F.lit(mask))) % 2) * (1 << k)
    return total.cast("long")


def _flip(x: Column, place: Column) -> Column:
    """x with the bit of this place turned over; places count from 1, and 0 turns none."""
    return F.when(place > 0, x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int")))).otherwise(x)


def _anchors(fp: Column, shift: int, width: int) -> tuple[Column, Column]:
    """The home anchor of a block, and all anchors within distance 2, the home included."""
    x = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
    r = (width + 1).bit_length() - 1
    n = (1 << r) - 1
    s = _syndrome(x, r)
    home = _flip(x, s)
    places = F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))
    # Two turned bits whose places differ by the syndrome lead to another code word.
    second = F.filter(places, lambda i: (s > 0) & (i < i.bitwiseXOR(s)))
    pairs = F.transform(second, lambda i: _flip(_flip(x, i), i.bitwiseXOR(s)))
    free = [home.bitwiseXOR(F.lit(1 << k)) for k in range(n, width)]
    return home, F.concat(F.array(home, *free), pairs)


def _key(block: int, anchor: Column, part: Column) -> Column:
    """Block, part and anchor in one long; anchors have at most 32 bits."""
    part = F.call_function("shiftleft", part.cast("long"), F.lit(33))
    return anchor.bitwiseOR(part).bitwiseOR(F.lit(block << 58))


def _visits(nodes: DataFrame, bits: int, residents: int) -> DataFrame:
    """(key, visitor, fp): residents of each anchor (visitor 0) and its visitors (1)."""
    out = None
    for k, (shift, width) in enumerate(_blocks(bits)):
        home, near = _anchors(F.col("fp"), shift, width)
        homes = nodes.select("fp", home.alias("anchor"))
        full = homes.groupBy("anchor").count().where(F.col("count") > residents)
        full = full.select("anchor", F.ceil(F.col("count") / residents).alias("parts"))
        parts = F.coalesce("parts", F.lit(1))
        stay = homes.join(full, "anchor", "left").select(
            _key(k, F.col("anchor"), F.pmod(F.xxhash64("fp"), parts)).alias("key"), F.lit(0).alias("visitor"), "fp"
        )
        come = nodes.select("fp", F.explode(near).alias("anchor")).join(full, "anchor", "left")
        come = come.select("fp", "anchor", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
        come = come.select(_key(k, F.col("anchor"), F.col("part")).alias("key"), F.lit(1).alias("visitor"), "fp")
        both = stay.union(come)
        out = both if out is None else out.union(both)
    return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges with the same components as the edges (a, b)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def compare(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links between visitors and residents; rows come by key, residents first."""
    kept_key, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        if not len(batch):
            continue
        key, visitor, fp = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "visitor", "fp"))
        home = visitor == 0
        home_key, home_fp = np.concatenate([kept_key, key[home]]), np.concatenate([kept_fp, fp[home]])
        key_v, fp_v = key[~home], fp[~home]
        low, high = np.searchsorted(home_key, key_v, "left"), np.searchsorted(home_key, key_v, "right")
        met = high > low
        low, fp_v, n = low[met], fp_v[met], (high - low)[met]
        total, at = np.cumsum(n), 0
        while at < len(n):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            m = n[at:to]
            first = np.cumsum(m) - m
            own = np.repeat(fp_v[at:to], m)
            other = home_fp[np.repeat(low[at:to] - first, m) + np.arange(m.sum())]
            near = (np.bitwise_count(np.bitwise_xor(own, other).view(np.uint64)) <= bits) & (own != other)
            if near.any():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(own[near], other[near])], ["a", "b"])
            at = to
        last = home_key == key[-1]
        kept_key, kept_fp = home_key[last], home_fp[last]


def links(nodes: DataFrame, bits: int = 3, residents: int = RESIDENTS) -> DataFrame:
    """Edges (a, b) with the same components as all links between the distinct fingerprints ``fp``."""
    rows = _visits(nodes, bits, residents)
    dealt = rows.repartition("key").sortWithinPartitions("key", "visitor")
    return dealt.mapInArrow(lambda batches: compare(batches, bits), "a long, b long")


def groups(marked: DataFrame, bits: int = 3, residents: int = RESIDENTS) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of ``marked`` (doc_id, fp), a staged table."""
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(nodes.select("fp"), bits, residents))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, bits: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id, the smallest doc_id it reaches over links."""
    marked = staged(docs.select("doc_id", fingerprint(text_of(), size, seed).alias("fp")), "marked")
    return marked.join(groups(marked, bits), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, bits: int = 3, size: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id, and of its rows the smallest text hash."""
    own = docs.select("doc_id", F.xxhash64(text_of()).alias("_hash"), fingerprint(text_of(), size, seed).alias("fp"))
    marked = staged(own, "marked")
    named = marked.join(groups(marked, bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = named.groupBy("root", "component_id").agg(F.min("_hash").alias("_first"), F.count("*").alias("_n"))
    first = staged(first, "kept")
    rows = packed(docs, "doc_id", F.xxhash64(text_of()).alias("_of"))

    def chosen(of: DataFrame) -> DataFrame:
        return rows.join(of, F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("_of") == F.col("_first")))

    # Only rows that repeat both id and text are left in more than one copy; they are few.
    once = chosen(first.where("_n = 1")).select("_doc")
    more = chosen(staged(first.where("_n > 1"), "repeated")).dropDuplicates(["root"]).select("_doc")
    return once.union(more).select(*unpacked(docs))
