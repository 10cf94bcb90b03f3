"""Licence phrases and notices in texts, by matching statistics against a suffix automaton.

The words of all phrases and notices make one generalised suffix automaton. A text is streamed
through it: after each word the automaton is in the state of the longest run of words that ends
there and stands in some notice. A phrase is found where its state lies on the suffix links of the
current one. Matches of ``seed`` words or more that can't be extended are seeds; seeds of one notice
that follow each other in the text and in the notice, at most ``gap`` words apart, are chained, and
a chain that covers at least ``cover`` of its notice's words is a span with the notice's label. Of
overlapping spans the one with most matched words stays (ties: the first by place and notice).

Words are runs of ASCII letters, ASCII digits and all characters beyond ASCII, with A-Z in lower
case. Only runs of words whose neighbouring pairs stand in some notice reach the automaton: any
other pair ends a match, so nothing is lost, and the rest of the work is on arrays.

A null or empty text has no words, no finds and score 0. Texts of any length are read in slices,
with four bytes a word and the chains of the last words in memory. Repeated rows get equal results;
there is no order among rows and no shuffle. An empty table gives an empty result. Other columns of
the input, whatever their names, pass unchanged beside the struct ``licences``.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm import words as W
from crowdpulse.llm.licence_texts import PHRASES, TEMPLATES
from crowdpulse.llm.tables import text_of

SEED, GAP, COVER = 3, 12, 0.75
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = np.ones(256, bool)
BLANK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
KIND = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,"
    "labels:string,score:double,spans:array<struct<label:string,start:bigint,stop:bigint,covered:double>>>"
)


class Span(NamedTuple):
    template: int
    start: int  # words of the text, stop exclusive
    stop: int
    covered: float


def words_of(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


class Automaton:
    """Generalised suffix automaton over lists of numbers; state 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for token in sequence:
                last = self._extend(last, token)
        #: (sequence, words up to the end) of all places where a state's runs end.
        self.places: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for k, sequence in enumerate(sequences):
            state = 0
            for n, token in enumerate(sequence, 1):
                state = self.next[state][token]
                self.places[state].append((k, n))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, token: int) -> int:
        """The state of the runs of p with token, apart from longer runs that shared it."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        self.link[new] = self._split(p, token) if p >= 0 else 0
        return new

    def walk(self, tokens: list[int]) -> int:
        state = 0
        for token in tokens:
            state = self.next[state][token]
        return state

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest known run that ends at each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            yield state, length


class Chains:
    """Streaming chains of seeds for every notice; what is older than ``gap`` words is settled."""

    def __init__(self, sizes: list[int], gap: int, cover: float):
        self.sizes, self.gap, self.cover = sizes, gap, cover
        self.live: dict[int, deque[list]] = {}  # [end in text, end in notice, words, start, followed]
        self.open: dict[int, Span] = {}
        self.spans: list[Span] = []
        self.best = 0.0

    def add(self, end: int, length: int, places: list[tuple[int, int]]) -> None:
        for template, at in places:
            live = self.live.setdefault(template, deque())
            while live and live[0][0] < end - length - self.gap:
                self._settle(template, live.popleft())
            words, start, before = length, end - length, None
            for node in live:
                gain = min(length, end - node[0], at - node[1])
                skipped = max(end - gain - node[0], at - gain - node[1])
                if gain > 0 and skipped <= self.gap and node[2] + gain > words:
                    words, start, before = node[2] + gain, node[3], node
            if before:
                before[4] = True
            live.append([end, at, words, start, False])

    def _settle(self, template: int, node: list) -> None:
        end, _, words, start, followed = node
        if followed:
            return
        covered = words / self.sizes[template]
        self.best = max(self.best, covered)
        if covered < self.cover:
            return
        span, last = Span(template, start, end, covered), self.open.get(template)
        if last and span.start < last.stop:
            self.open[template] = max(last, span, key=lambda s: s.covered)
        else:
            if last:
                self.spans.append(last)
            self.open[template] = span

    def close(self) -> list[Span]:
        for template, live in self.live.items():
            for node in live:
                self._settle(template, node)
        self.spans += self.open.values()
        self.live, self.open = {}, {}
        kept: list[Span] = []
        for span in sorted(self.spans, key=lambda s: (s.start, s.stop, s.template)):
            # Of spans that overlap the one with most words of its notice stays.
            if not kept or span.start >= kept[-1].stop:
                kept.append(span)
            elif self._words(span) > self._words(kept[-1]):
                kept[-1] = span
        return kept

    def _words(self, span: Span) -> float:
        return span.covered * self.sizes[span.template]


class Scanner:
    """One library of phrases and notices, ready to read texts."""

    def __init__(self, phrases: tuple, templates: tuple, seed: int, gap: int, cover: float):
        self.seed, self.gap, self.cover = seed, gap, cover
        own = [words_of(text) for text, _ in (*phrases, *((t, label) for label, t in templates))]
        vocabulary = sorted({w for ws in own for w in ws})
        numbers = {w: k for k, w in enumerate(vocabulary)}
        sequences = [[numbers[w] for w in ws] for ws in own]
        self.automaton = Automaton(sequences)
        self.phrase_labels = [label for _, label in phrases]
        self.sizes = [len(s) for s in sequences]
        self.labels = [*self.phrase_labels, *(label for label, _ in templates)]
        # Seeds are kept for notices only; a phrase is found or not.
        self.seeds = [[(t, n) for t, n in p if t >= len(phrases)] for p in self.automaton.places]
        self.ends: list[list[int]] = [[] for _ in self.automaton.next]
        at = {}
        for k in range(len(phrases)):
            at.setdefault(self.automaton.walk(sequences[k]), []).append(k)
        for state in sorted(range(1, len(self.ends)), key=self.automaton.length.__getitem__):
            self.ends[state] = self.ends[self.automaton.link[state]] + at.get(state, [])
        joined = np.frombuffer(" ".join(vocabulary).encode(), np.uint8)
        stops = np.append(np.flatnonzero(joined == 32), len(joined))
        starts = np.append(0, stops[:-1] + 1)
        hashes = W.hashes(joined, starts, stops)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order.astype(np.int32)
        self.bytes = [w.encode() for w in vocabulary]
        self.base = len(vocabulary) + 1
        self.pairs = np.unique([a * self.base + b for s in sequences for a, b in zip(s, s[1:])])

    def known(self, part: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Owner and number of each word of a slice; -1 for a word in no notice."""
        found = W.words(part, lower=True, blank=BLANK)
        place = np.minimum(np.searchsorted(self.hashes, found.hash), len(self.hashes) - 1)
        number = np.where(self.hashes[place] == found.hash, self.numbers[place], np.int32(-1))
        # Equal hashes are checked by their bytes, where the word is part of a known pair or at an edge.
        pair = self.paired(found.text, number)
        edge = np.zeros(len(number), bool)
        edge[:1] = edge[-1:] = True
        near = edge | np.append(pair, False) | np.insert(pair, 0, False) if len(number) else edge
        data = W.SMALL[part.bytes].tobytes() if near.any() else b""
        for k in np.flatnonzero(near & (number >= 0)).tolist():
            if data[found.start[k] : found.end[k]] != self.bytes[number[k]]:
                number[k] = -1
        return found.text, number

    def paired(self, owner: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether each word and the next one stand side by side in some notice."""
        first, second = number[:-1].astype(np.int64), number[1:].astype(np.int64)
        code = first * self.base + second
        place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
        return (first >= 0) & (second >= 0) & (owner[:-1] == owner[1:]) & (self.pairs[place] == code)

    def slices(self, part: W.Texts) -> Iterator[W.Texts]:
        """A long text in pieces that end between two words."""
        data, at = part.bytes, 0
        if len(part.starts) > 1 or len(data) <= W.SLICE_BYTES:
            yield part
            return
        while at < len(data):
            to = min(len(data), at + W.SLICE_BYTES)
            while to < len(data):
                gaps = np.flatnonzero(BLANK[W.SMALL[data[to : to + 4096]]])
                if len(gaps):
                    to += int(gaps[0])
                    break
                to = min(len(data), to + 4096)
            yield W.Texts(part.first, part.last, data[at:to], np.array([0]), np.array([to - at]))
            at = to

    def read(self, part: W.Texts) -> list[dict]:
        """The finds of each text of a slice."""
        found = [self.known(p) for p in self.slices(part)]
        owner = np.concatenate([o for o, _ in found])
        number = np.concatenate([n for _, n in found])
        pair = self.paired(owner, number)
        n_texts = len(part.starts)
        first = np.searchsorted(owner, np.arange(n_texts + 1))
        out = [{"n_words": int(n), "places": [], "base": set(), "chains": None} for n in np.diff(first)]
        # Runs of known pairs: from the first word of the first pair to the second of the last.
        edge = np.diff(np.concatenate([[0], pair.astype(np.int8), [0]])) if len(number) else np.zeros(0, int)
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            own = out[owner[a]]
            self._run(own, a - int(first[owner[a]]), number[a : b + 1].tolist())
        return out

    def _run(self, own: dict, origin: int, tokens: list[int]) -> None:
        before = (0, 0)
        for k, now in enumerate(self.automaton.statistics(tokens)):
            if now[1] != before[1] + 1:
                self._seed(own, origin + k, *before)
            for phrase in self.ends[now[0]]:
                own["places"].append(origin + k + 1 - self.sizes[phrase])
                own["base"].add(self.phrase_labels[phrase])
            before = now
        self._seed(own, origin + len(tokens), *before)

    def _seed(self, own: dict, end: int, state: int, length: int) -> None:
        if length >= self.seed and self.seeds[state]:
            if own["chains"] is None:
                own["chains"] = Chains(self.sizes, self.gap, self.cover)
            own["chains"].add(end, length, self.seeds[state])

    def row(self, own: dict) -> dict:
        spans = own["chains"].close() if own["chains"] else []
        labels = own["base"] | {self.labels[s.template] for s in spans}
        score = 1.0 if own["base"] else own["chains"].best if own["chains"] else 0.0
        return {
            "n_words": own["n_words"],
            "n_base": len(own["places"]),
            "first_word": min(own["places"], default=None),
            "last_word": max(own["places"], default=None),
            "base_labels": ",".join(sorted(own["base"])),
            "labels": ",".join(sorted(labels)),
            "score": min(1.0, score),
            "spans": [dict(zip(("label", "start", "stop", "covered"), (self.labels[s[0]], *s[1:]))) for s in spans],
        }


@lru_cache(4)
def scanner(phrases: tuple, templates: tuple, seed: int, gap: int, cover: float) -> Scanner:
    """One scanner per worker process and library."""
    return Scanner(phrases, templates, seed, gap, cover)


TYPE = pa.struct(
    [
        *((n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("covered", pa.float64())]
                )
            ),
        ),
    ]
)


def scanned(
    text: Column,
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    seed: int = SEED,
    gap: int = GAP,
    cover: float = COVER,
) -> Column:
    """The finds of a text as a struct: counts, labels, score and spans (words from 0, stop exclusive).

    ``score`` is 1 with a phrase, else the largest share of a notice that a chain covers.
    """
    library = (tuple(phrases.items()), tuple(templates), seed, gap, cover)

    @arrow_udf(KIND)
    def run(texts: pa.Array) -> pa.Array:
        own = scanner(*library)
        return pa.array([own.row(f) for part in W.texts(texts) for f in own.read(part)], TYPE)

    return run(text)


def scan(docs: DataFrame, **library) -> DataFrame:
    """``docs`` with one more column, the struct ``licences`` (see ``scanned``).

    A column of that name is an error of the caller, named as such.
    """
    if "licences" in docs.columns:
        raise ValueError("the input has a column named licences; rename it first")
    return docs.select("*", scanned(text_of(), **library).alias("licences"))
