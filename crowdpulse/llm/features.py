"""Dense features of texts: rates of symbols, capitals, repeats, marks and lines. Computed per batch
of whole texts with array operations; an empty text has zeros."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from crowdpulse.llm import words as W

NAMES = (
    "log_words", "word_length", "long_words", "short_words", "symbol_words", "symbol_chars", "bar_words",
    "exclaimed_words", "mark_words", "digit_chars", "capital_chars", "capital_words", "first_capitals",
    "repeated_words", "adjacent_repeats", "repeated_triples", "distinct_words", "line_words",
    "repeated_lines", "ended_lines", "url_words", "other_chars",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOL = _class(b"#*$%&|<>{}[]\\^~=_@+/")
CAPITAL = _class(bytes(range(65, 91)))
LETTER = _class(bytes([*range(65, 91), *range(97, 123)]))
DIGIT = _class(b"0123456789")
MARK = _class(b".,;:?!")
OTHER = _class(bytes(range(0x80, 0x100)))
FEED = _class(b"\n")


def counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of flags[start:end] are set, for each pair."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[end] - sums[start]


def repeats(owner: np.ndarray, hash: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: occurrences beyond the first of equal hashes, and distinct hashes."""
    key = hash ^ W.mix(owner.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(key, return_index=True)
    distinct = np.bincount(owner[first], minlength=n)
    return np.bincount(owner, minlength=n) - distinct, distinct


def of_texts(part: W.Texts) -> np.ndarray:
    """(texts, features)."""
    n, data = len(part.starts), part.bytes
    w = W.words(part)
    size = np.bincount(w.text, minlength=n).astype(float)
    words, length = np.maximum(size, 1), w.end - w.start
    chars = np.maximum(np.bincount(w.text, length, minlength=n), 1)

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(w.text, values.astype(float), minlength=n)

    symbol, capital, letter = (counts(c[data], w.start, w.end) for c in (SYMBOL, CAPITAL, LETTER))
    last = data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    first = data[w.start] if len(w.end) else np.zeros(0, np.uint8)
    letters = np.maximum(per_text(letter), 1)
    again, distinct = repeats(w.text, w.hash, n)
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    triple = W.shingles(w.hash, 3)
    own = w.text[: len(triple)] == w.text[len(w.text) - len(triple) :]
    triples, _ = repeats(w.text[: len(triple)][own], triple[own], n)
    feeds = np.concatenate([[0], np.cumsum(FEED[data])])
    new_line = np.ones(len(w.hash), bool)
    new_line[1:] = (w.text[1:] != w.text[:-1]) | (feeds[w.start[1:]] > feeds[w.end[:-1]])
    at = np.flatnonzero(new_line)
    lines = np.maximum(np.bincount(w.text[at], minlength=n), 1)
    if len(at):
        rank = np.arange(len(w.hash)) - at[np.cumsum(new_line) - 1]
        line = np.add.reduceat(w.hash * W.UP[1 + rank % 4096], at)
        ended = MARK[last[np.append(at[1:], len(w.hash)) - 1]]
    else:
        line, ended = np.zeros(0, np.uint64), np.zeros(0, bool)
    line_again, _ = repeats(w.text[at], line, n)
    return np.column_stack(
        [
            np.log1p(size),
            np.minimum(chars / words, 40) / 10,
            per_text(length > 14) / words,
            per_text(length <= 3) / words,
            per_text(symbol > 0) / words,
            per_text(symbol) / chars,
            per_text((length == 1) & (first == ord("|"))) / words,
            per_text(last == ord("!")) / words,
            per_text(MARK[last]) / words,
            per_text(counts(DIGIT[data], w.start, w.end)) / chars,
            per_text(capital) / letters,
            per_text((capital > 1) & (2 * capital > letter)) / words,
            per_text(CAPITAL[first]) / words,
            again / words,
            per_text(same) / words,
            triples / words,
            distinct / words,
            np.log1p(size / lines),
            line_again / lines,
            np.bincount(w.text[at], ended.astype(float), minlength=n) / lines,
            per_text(counts(_class(b"/")[data], w.start, w.end) > 1) / words,
            per_text(counts(OTHER[data], w.start, w.end)) / chars,
        ]
    )


def of_column(column: pa.Array) -> np.ndarray:
    parts = [of_texts(part) for part in W.texts(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
