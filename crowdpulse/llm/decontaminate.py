"""Benchmark passages in documents, found by SimHash over windows and proved by exact similarity.

Texts are lower-cased (A-Z), words are runs of non-blanks, shingles have five words (an item with
fewer words is one shingle). A benchmark item is fingerprinted over windows of its own size class
and over smaller ones all along it, each at as many offsets as the stride of that class. Documents
are fingerprinted over windows of the same sizes at that stride, which some offset always meets:
an unchanged passage is hit at distance 0 wherever it starts. Edits within a similarity of 0.8 leave
a run of shingles whole, and the smaller windows lie so close that one of them is within it.

Fingerprints have 64 bits in four blocks of 16. Within a radius of 7 bits one block differs in at
most one bit, so a table per block of all values within one bit of a benchmark fingerprint finds
every fingerprint within the radius. A candidate is proved by the weighted Jaccard similarity of
the item and the best item-sized window nearby, on the words themselves: each shingle counts as
often as it occurs, with weight 1 / (different item texts it occurs in), or with weight 1 where that
gives more: an edit of a passage that many items share costs no more than any other. Matches have 0.8
or more.

A short item ("yes") is in very many texts. ``short_items`` reports those below a length, and with
``least_words`` they only match documents that consist of them alone; without it they match anywhere.

The benchmark is the query set: it goes to the tasks in blocks of bounded size, each a pass over
all documents. Null and empty texts and items, and an empty table, match nothing; a repeated row gives
repeated matches. Of equally similar places the first one counts. A very long text is fingerprinted
in overlapping slices of words. Columns other than the id and the text are only carried along.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm import words as W
from crowdpulse.llm.tables import packed, text_of, unpacked

SHINGLE, SIMILARITY, RADIUS, BITS = 5, 0.8, 7, 64
#: Bytes of benchmark text in one block.
BLOCK_BYTES = 4 << 20
#: Windows that an edit elsewhere in the item leaves whole have at most so many shingles.
PART = 28
#: Words of a text fingerprinted at a time, besides those a window reaches over the end.
SLICE_WORDS = 1 << 16
#: Window sizes in shingles: each half as large again as the one before.
SIZES = (1, 2, 3, 4, 6, 9, 13, 19, 28, 42, 63, 94, 141, 211, 316, 474, 711, 1066, 1599, 2398, 3597)


def stride(size: int) -> int:
    return max(1, size // 6)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def runs(words: list[bytes], size: int) -> list[bytes]:
    return [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)]


def lost(shingles: int) -> int:
    """Shingles of an item that a window of its size can lack at a similarity of 0.8: (n - d) / (n + d)."""
    return int(shingles * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)


def whole_run(shingles: int) -> int:
    """A run of an item's shingles that stays whole: a cut inside the item costs four shingles at least."""
    d = lost(shingles)
    return -(-(shingles - d) // (d // (SHINGLE - 1) + 1))


def fits(shingles: int) -> list[tuple[int, int]]:
    """(window size, offset) at which an item is fingerprinted.

    The size meets the whole item at any stride. Smaller windows lie at both ends, and all along the
    item so that every run of ``whole_run`` shingles holds one.
    """
    sizes = [s for s in SIZES if s + stride(s) - 1 <= shingles]
    if not sizes:
        return []
    out = {(sizes[-1], k) for k in range(stride(sizes[-1]))}
    parts = [s for s in sizes if s <= PART and s + stride(s) - 1 <= (shingles - SHINGLE) // 2]
    for size in parts[-1:]:
        span = size + stride(size) - 1
        inner = range(0, shingles - span, span) if shingles > 4 * PART else [0]
        out |= {(size, at + k) for at in [*inner, shingles - span] for k in range(stride(size))}
    run = whole_run(shingles)
    if run < shingles:
        most = run if lost(shingles) < SHINGLE - 1 else (run + 1) // 2
        size = max(s for s in SIZES if s + stride(s) - 1 <= most)
        span = size + stride(size) - 1
        starts = range(0, shingles - span + 1, run - span + 1)
        out |= {(size, at + k) for at in starts for k in range(stride(size))}
    return sorted(out)


def prefix_votes(hashes: np.ndarray) -> np.ndarray:
    """Running counts of set bits, modulo 2^16: (n + 1, 64)."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Sums run within stripes of rows side by side, then over the stripes: whole rows at a time.
    rows = 32
    n = -(-len(hashes) // rows)
    sums = np.zeros((n, rows, BITS), np.uint16)
    sums.reshape(-1, BITS)[: len(hashes)] = bits
    for k in range(1, rows):
        sums[:, k] += sums[:, k - 1]
    before = np.zeros((n, 1, BITS), np.uint16)
    np.cumsum(sums[:-1, -1], axis=0, dtype=np.uint16, out=before[1:, 0])
    sums += before
    out = np.zeros((len(hashes) + 1, BITS), np.uint16)
    out[1:] = sums.reshape(-1, BITS)[: len(hashes)]
    return out


def window_prints(votes: np.ndarray, size: int, step: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles that start at 0, step, 2 step, ..."""
    n = max(0, len(votes) - size)
    counts = votes[size::step][: (n + step - 1) // step] - votes[:n:step]
    return np.packbits(counts > size // 2, axis=1, bitorder="little").view(np.uint64).ravel()


class Prints:
    """Fingerprints of windows of one size, by the values of their blocks and all values one bit away."""

    def __init__(self, prints: list[int], rows: list[tuple[int, int]]):
        self.prints, self.rows = np.array(prints, np.uint64), np.array(rows)
        near = np.array([0, *(1 << b for b in range(16))], np.uint16)
        self.blocks = []
        for b in range(BITS // 16):
            values = ((self.prints >> np.uint64(16 * b)).astype(np.uint16)[:, None] ^ near).ravel()
            order = np.argsort(values, kind="stable")
            ends = np.searchsorted(values[order], np.arange((1 << 16) + 1)).astype(np.int32)
            self.blocks.append((ends, (order // len(near)).astype(np.int32)))

    def near(self, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index in got, index in prints) of all pairs within the radius."""
        found = []
        for b, (ends, order) in enumerate(self.blocks):
            value = got.view(np.uint16)[b :: BITS // 16].astype(np.int32)
            n = ends[value + 1] - ends[value]
            at = np.flatnonzero(n)
            n, first = n[at], ends[value[at]]
            which = order[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            at = np.repeat(at, n)
            close = np.bitwise_count(got[at] ^ self.prints[which]) <= RADIUS
            found.append((at[close], which[close]))
        return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """The index of one block of items: (item_id, words, weights by shingle)."""

    def __init__(self, items: list[tuple], least_words: int = 1):
        self.items = items
        self.whole_only = np.array([len(words) < least_words for _, words, _ in items])
        self.size = np.array([len(words) for _, words, _ in items])
        found: dict[tuple[int, int], list[tuple]] = {}
        for k, (_, words, _) in enumerate(items):
            own = min(SHINGLE, len(words))
            if not own:
                continue
            part = next(W.texts(pa.array([b" ".join(words).decode()]), 1 << 40))
            votes = prefix_votes(W.shingles(W.words(part).hash, own))
            for size, offset in fits(len(words) - own + 1):
                p = window_prints(votes[offset : offset + size + 1], size, 1)[0]
                found.setdefault((own, size), []).append((int(p), (k, offset)))
        self.classes = [(*key, Prints(*zip(*rows))) for key, rows in sorted(found.items())]

    def candidates(self, part: W.Texts) -> set[tuple[int, int, int]]:
        """(text, item, first word) where an item may start."""
        w = W.words(part, lower=True)
        if not len(w.hash):
            return set()
        first = np.searchsorted(w.text, np.arange(len(part.starts)))
        out: set[tuple[int, int, int]] = set()
        long = np.bincount(w.text, minlength=len(part.starts))
        reach = max((size + stride(size) + own for own, size, _ in self.classes), default=0)
        for low in range(0, len(w.hash), SLICE_WORDS):
            hash = w.hash[low : low + SLICE_WORDS + reach]
            made: dict[int, np.ndarray] = {}
            for own, size, prints in self.classes:
                if own not in made:
                    made[own] = prefix_votes(W.shingles(hash, own))
                step = stride(size)
                at, which = prints.near(window_prints(made[own], size, step))
                start = low + at * step
                item = prints.rows[which, 0]
                inside = w.text[start] == w.text[start + size + own - 2]
                inside &= ~self.whole_only[item] | (long[w.text[start]] == self.size[item])
                start, rows = start[inside], prints.rows[which[inside]]
                text = w.text[start]
                out.update(zip(text.tolist(), rows[:, 0].tolist(), (start - first[text] - rows[:, 1]).tolist()))
        return out

    def matches(self, part: W.Texts, similarity: float) -> Iterator[tuple[int, int, float, int]]:
        """(text, item, similarity, first word): the best place of each matching item in each text."""
        places: dict[tuple[int, int], set[int]] = {}
        for text, item, at in self.candidates(part):
            # Words put in or taken out before the window move the item's start by up to so many.
            reach = max(2, lost(len(self.items[item][1])))
            places.setdefault((text, item), set()).update(range(at - reach, at + reach + 1))
        words: dict[int, list[bytes]] = {}
        for (text, item), starts in sorted(places.items()):
            if text not in words:
                words = {text: part.bytes[part.starts[text] : part.ends[text]].tobytes().lower().split()}
            best = max(self.similarities(words[text], item, sorted(starts)), default=(0.0, 0))
            if best[0] >= similarity:
                yield text, item, best[0], -best[1]

    def similarities(self, words: list[bytes], item: int, starts: list[int]) -> Iterator[tuple[float, int]]:
        _, own_words, weights = self.items[item]
        size = min(SHINGLE, len(own_words))
        own = Counter(runs(own_words, size))
        for at in starts:
            window = words[max(0, at) : max(0, at + len(own_words))]
            if len(window) < size:
                continue
            other = Counter(runs(window, size))
            # A shingle no item has weighs as much as one that a single item has.
            both = sum(weights[s] * min(n, other[s]) for s, n in own.items() if s in other)
            either = sum(weights.get(s, 1.0) * max(own[s], other[s]) for s in own.keys() | other.keys())
            same = sum(min(n, other[s]) for s, n in own.items() if s in other)
            plain = same / (own.total() + other.total() - same)
            yield max(both / either, plain), -at


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Items with their shingles' weights, in blocks of up to ``limit`` bytes of text."""
    items = benchmark.select("item_id", text_of().alias("text")).distinct()

    def shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                words = tokens(text)
                own = sorted(set(runs(words, min(SHINGLE, len(words))))) if words else []
                at = pa.array([k] * len(own), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(at), batch.column("text").take(at), pa.array(own, pa.binary())],
                    ["item_id", "text", "shingle"],
                )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = items.mapInArrow(shingle_rows, f"item_id {kind}, text string, shingle binary")
    counts = rows.groupBy("shingle").agg(F.countDistinct(F.xxhash64("text")).alias("items"))
    weighed = rows.join(counts, "shingle").groupBy("item_id", "text")
    weighed = weighed.agg(F.collect_list(F.struct("shingle", (1 / F.col("items")).alias("weight"))).alias("weights"))
    block, total = [], 0
    for row in weighed.orderBy("item_id", "text").toLocalIterator():
        block.append((row.item_id, tokens(row.text), {bytes(s): w for s, w in row.weights}))
        total += len(row.text.encode())
        if total >= limit:
            yield block
            block, total = [], 0
    if block:
        yield block


def short_items(benchmark: DataFrame, least_words: int = SHINGLE) -> DataFrame:
    """(item_id, words) of the items with fewer words than that."""
    words = F.size(F.filter(F.split(text_of(), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    return benchmark.select("item_id", words.alias("words")).where(F.col("words") < least_words)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    limit: int = BLOCK_BYTES,
    least_words: int = 1,
) -> DataFrame:
    """One row per document and item it holds: doc_id, text_hash, item_id, similarity, first_word."""
    own = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    kinds = [docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"doc_id {kinds[0]}, text_hash long, item_id {kinds[1]}, similarity double, first_word int"
    out = None
    for items in blocks(benchmark, limit):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = Block(sent.value, least_words)
            ids = pa.array([item[0] for item in block.items])
            for batch in batches:
                for part in W.texts(batch.column("text")):
                    found = list(block.matches(part, similarity))
                    if not found:
                        continue
                    text, item, score, at = zip(*found)
                    rows = pa.array([t + part.first for t in text])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(rows),
                            batch.column("text_hash").take(rows),
                            ids.take(pa.array(item)),
                            pa.array(score, pa.float64()),
                            pa.array(at, pa.int32()),
                        ],
                        ["doc_id", "text_hash", "item_id", "similarity", "first_word"],
                    )

        found = own.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def remove(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, least_words: int = 1
) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    hit = find(docs, benchmark, similarity, least_words=least_words).select("doc_id", "text_hash").distinct().toDF("_id", "_hash")
    rows = packed(docs, "doc_id", F.xxhash64(text_of()).alias("_of"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_hash"))
    return rows.join(hit, same, "left_anti").select(*unpacked(docs))
