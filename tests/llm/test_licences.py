"""License scans against plain versions: patterns, longest matches, chains."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from crowdpulse.llm import licences as L
from crowdpulse.llm import words as W
from crowdpulse.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    words = plain_words(text)
    found = []
    for phrase, label in L.PHRASES.items():
        own = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    places = sorted(k for k, _ in found)
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(places), places[0] if places else None, places[-1] if places else None, labels


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_base_equals_plain(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_license_scans"](spark, d).collect()}
    assert len(got) == len(docs)
    for r in docs:
        own = got[r.doc_id]
        assert tuple(own[1:6]) == plain_base(r.text)
        assert set(filter(None, own.base_labels.split(","))) <= set(filter(None, own.labels.split(",")))
        assert 0 <= own.score <= 1 and (own.score == 1 or not own.base_labels)
    assert any("cc-by-nc" in r.labels for r in got.values())


def longest(tokens, sequences):
    """Length of the longest run that ends at each token and stands in a sequence."""
    runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    return [max((n for n in range(1, k + 2) if tuple(tokens[k + 1 - n : k + 1]) in runs), default=0) for k in range(len(tokens))]


def test_automaton_on_random_sequences():
    rng = random.Random(3)
    for _ in range(200):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 5))]
        own = L.Automaton(sequences)
        tokens = [rng.randrange(4) for _ in range(30)]
        found = list(own.statistics(tokens))
        assert [n for _, n in found] == longest(tokens, sequences)
        for k, (state, n) in enumerate(found):
            run = tokens[k + 1 - n : k + 1]
            ends = [(t, b) for t, s in enumerate(sequences) for b in range(n, len(s) + 1) if n and s[b - n : b] == run]
            assert sorted(own.places[state]) == sorted(ends) or not n


def plain_spans(text, own):
    """Seeds from all maximal matches, then all chains: no expiry, no streaming."""
    sequences = [plain_words(t) for t, _ in (*L.PHRASES.items(), *((t, x) for x, t in L.TEMPLATES))]
    words = plain_words(text)
    length = longest(words, sequences)
    nodes = []
    for k, n in enumerate(length):
        if n < own.seed or k + 1 < len(length) and length[k + 1] == n + 1:
            continue
        for t in range(len(L.PHRASES), len(sequences)):
            for b in range(n, len(sequences[t]) + 1):
                if sequences[t][b - n : b] == words[k + 1 - n : k + 1]:
                    nodes.append([t, k + 1, b, n])
    best = []
    for t, end, at, n in nodes:
        words_, start = n, end - n
        for u, end2, at2, total, start2 in best:
            gain = min(n, end - end2, at - at2)
            if u == t and gain > 0 and max(end - gain - end2, at - gain - at2) <= own.gap and total + gain > words_:
                words_, start = total + gain, start2
        best.append((t, end, at, words_, start))
    return {(t, start, end) for t, end, at, n, start in best if n / len(sequences[t]) >= own.cover}, best, sequences


def scan_one(text, own):
    part = next(iter(W.texts(pa.array([text]))))
    return own.row(own.read(part)[0])


def test_spans_equal_plain_chains():
    own = L.scanner(tuple(L.PHRASES.items()), L.TEMPLATES, L.SEED, L.GAP, L.COVER)
    rng = random.Random(5)
    filler = "lorem ipsum the of dolor license sit software amet copies".split()
    for _ in range(60):
        label, notice = rng.choice(L.TEMPLATES)
        words = notice.split()
        for _ in range(rng.randrange(0, 1 + len(words) // 12)):  # edits
            k = rng.randrange(len(words))
            words[k : k + rng.randrange(0, 2)] = rng.choices(filler, k=rng.randrange(0, 3))
        text = " ".join([*rng.choices(filler, k=20), *words, *rng.choices(filler, k=20)])
        got = scan_one(text, own)
        spans, best, sequences = plain_spans(text, own)
        top = max((n / len(sequences[t]) for t, _, _, n, _ in best), default=0.0)
        assert got["score"] == (1.0 if got["base_labels"] else pytest.approx(min(1.0, top)))
        found = {(s["label"], s["start"], s["stop"]) for s in got["spans"]}
        assert found <= {(own.labels[t], a, b) for t, a, b in spans}
        assert bool(found) == bool(spans)


def test_edited_notice_is_one_span_with_its_label():
    own = L.scanner(tuple(L.PHRASES.items()), L.TEMPLATES, L.SEED, L.GAP, L.COVER)
    isc = next(t for x, t in L.TEMPLATES if x == "isc")
    text = "some words before " + isc.replace("any purpose", "every purpose") + " and words after"
    got = scan_one(text, own)
    assert got["labels"] == "isc" and got["base_labels"] == "" and len(got["spans"]) == 1
    assert 0.75 <= got["score"] < 1 and got["spans"][0]["start"] == 3
    sa = next(t for x, t in L.TEMPLATES if x == "cc-by-sa")
    assert scan_one(sa, own)["labels"] == "cc-by-sa"
    assert scan_one("the rights to use copy and sell the software are with the author", own)["labels"] == ""


def test_long_text_in_slices_and_words_on_cuts():
    own = L.scanner(tuple(L.PHRASES.items()), L.TEMPLATES, L.SEED, L.GAP, L.COVER)
    unit = "Über die MIT License und den apache-license, general public licenses; GENERAL public\nLICENSE! "
    text = unit * (3 * W.SLICE_BYTES // len(unit.encode()))
    assert len(text.encode()) > 2 * W.SLICE_BYTES
    got = scan_one(text, own)
    assert tuple(got[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain_base(text)
    one = scan_one("x" * (2 * W.SLICE_BYTES) + " mit license", own)
    assert (one["n_words"], one["first_word"]) == (3, 1)


def test_edges_of_the_table(spark):
    rows = [(1, None, 5), (None, "", 5), (2, "MIT license", 6), (2, "MIT license", 6), (3, "mit the license", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long")
    got = L.scan(docs).select("doc_id", "n_words", "licences.*").collect()
    found = sorted(((r[0] or 0, r[1], r[2], r[3], r[4], r[6], r[8]) for r in got), key=str)
    assert found == sorted(
        [(1, 5, 0, 0, None, "", 0.0), (0, 5, 0, 0, None, "", 0.0)]
        + [(2, 6, 2, 1, 0, "mit", 1.0)] * 2
        + [(3, 7, 3, 0, None, "", 0.0)],
        key=str,
    )
    assert L.scan(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        L.scan(docs.withColumnRenamed("n_words", "licences"))


def test_equal_hashes_are_told_apart_by_bytes():
    own = L.Scanner(tuple(L.PHRASES.items()), L.TEMPLATES, L.SEED, L.GAP, L.COVER)
    own.bytes = [b"?" + b for b in own.bytes]
    part = next(iter(W.texts(pa.array(["mit license"]))))
    assert own.row(own.read(part)[0])["n_base"] == 0
    assert np.all(own.known(part)[1] == -1)
