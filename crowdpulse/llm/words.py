"""Words of a batch of texts as arrays: places, owners and 64-bit hashes, without a Python loop.

A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D. Hashes are polynomials over
the bytes, taken from prefix sums and mixed; equal words have equal hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 18
#: Bytes whose prefix sums are taken at once; they stay in a core's cache.
SUM_BYTES = 1 << 15
BASE = np.uint64(0x9E3779B97F4A7C15)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


UP = powers(int(BASE), SLICE_BYTES + 1)
DOWN = powers(pow(int(BASE), -1, 1 << 64), SLICE_BYTES + 1)
#: What a word's length adds to its hash: a power for each byte, as bytes count from 1, and the length.
SIZES = np.concatenate([[np.uint64(0)], np.cumsum(UP, dtype=np.uint64)]) + np.arange(SLICE_BYTES + 2, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits so that every bit depends on all of them."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Texts(NamedTuple):
    """Texts ``first`` to ``last`` of a column, their bytes in one array."""

    first: int
    last: int
    bytes: np.ndarray
    starts: np.ndarray  # of each text, in ``bytes``
    ends: np.ndarray


class Words(NamedTuple):
    text: np.ndarray  # index of the owner within the slice
    start: np.ndarray  # in the slice's bytes
    end: np.ndarray
    hash: np.ndarray


def texts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Runs of texts with up to ``limit`` bytes together; a longer text comes alone."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        own = offsets[first : last + 1] - offsets[first]
        yield Texts(first, last, data[offsets[first] : offsets[last]], own[:-1], own[1:])
        first = last


def words(part: Texts, lower: bool = False, blank: np.ndarray = BLANK) -> Words:
    data = SMALL[part.bytes] if lower else part.bytes
    # Comparisons of whole arrays take a tenth of the time of a look at the table.
    inside = (data != 0x20) & (data - np.uint8(9) > 4) if blank is BLANK else ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    filled = part.ends > part.starts
    begins[part.starts[filled]] = inside[part.starts[filled]]
    finishes[part.ends[filled] - 1] = inside[part.ends[filled] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    # An empty text begins where the next one does, and has no words.
    owner = np.repeat(np.arange(len(part.starts)), np.diff(np.searchsorted(start, part.starts), append=len(start)))
    return Words(owner, start, end, hashes(data, start, end))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for each word; words are in order and apart."""
    out = np.zeros(len(start), np.uint64)
    k = 0
    while k < len(start):
        origin = start[k]
        to = int(np.searchsorted(end, origin + SUM_BYTES, "right"))
        if to == k:
            to = int(np.searchsorted(end, origin + SLICE_BYTES, "right"))
        if to == k:  # one word longer than a slice
            out[k] = xxhash.xxh64_intdigest(data[origin : end[k]].tobytes())
            k += 1
            continue
        s, e = start[k:to] - origin, end[k:to] - origin
        sums = np.zeros(e[-1] + 1, np.uint64)
        np.cumsum(data[origin : end[to - 1]] * UP[: e[-1]], out=sums[1:])
        own = sums[e]
        own -= sums[s]
        own *= DOWN[s]
        own += SIZES[e - s]
        out[k:to] = mix(own)
        k = to
    return out


def shingles(hash: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; the caller drops runs over the end of a text."""
    n = max(0, len(hash) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out * BASE + hash[k : k + n])
    return out
