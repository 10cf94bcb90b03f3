"""Benchmark decontamination against a brute-force version, and planted passages."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import decontaminate as D
from crowdpulse.llm.queries import QUERIES


def brute(docs, items, least=0.8):
    own = {i: D.tokens(t) for i, t in items}
    shingles = {i: D.runs(w, min(5, len(w))) for i, w in own.items() if w}
    items_with = Counter(s for runs in shingles.values() for s in set(runs))
    holders = {}
    for i, runs in shingles.items():
        for s in runs:
            holders.setdefault(s, set()).add(i)
    out = {}
    for d, t in docs:
        words = D.tokens(t)
        near = set()
        for size in range(1, 6):
            for s in D.runs(words, size):
                near |= holders.get(s, set())
        for i in near:
            n, size = len(own[i]), min(5, len(own[i]))
            a = Counter(shingles[i])
            for at in range(-n, len(words)):
                b = Counter(D.runs(words[max(0, at) : max(0, at + n)], size))
                both = sum(min(x, b[s]) / items_with[s] for s, x in a.items())
                either = sum(max(a[s], b[s]) / items_with.get(s, 1) for s in a.keys() | b.keys())
                if both / either >= least:
                    out[d, i] = max(out.get((d, i), 0), both / either)
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = QUERIES["op10_decontamination"](spark, d).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert got == pytest.approx(brute(docs, items)) and len(got) == len(rows) > 0


def test_planted_edits_and_blocks(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9)))
    items = [(k, " ".join(word() for _ in range(rng.choice((3, 8, 15, 30, 60, 200))))) for k in range(60)]
    twin = next(t for _, t in items if len(t.split()) == 30)  # a second item with its text, unedited
    docs = []
    for k, text in items:
        words = text.upper().split()
        if len(words) >= 60:  # one edit, anywhere
            words[rng.randrange(len(words))] = "edit"
        around = [word() for _ in range(rng.randrange(2, 300))]
        at = rng.randrange(len(around))
        docs.append((k, "  ".join(around[:at]) + "\n" + "\t".join(words) + "\n" + " ".join(around[at:])))
        docs.append((1000 + k, " ".join(around)))
    docs += [(None, items[3][1]), (None, None), (5000, ""), (5001, (word() + " ") * 100_000 + items[7][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([*items, (None, twin), (900, None), (901, "  ")], "item_id long, text string")
    want = brute([r for r in docs if r[0] != 5001], [(i if i is not None else -1, t) for i, t in [*items, (None, twin)]])
    for limit in (D.BLOCK_BYTES, 6000):
        got = [(r.doc_id, -1 if r.item_id is None else r.item_id, r.similarity) for r in D.find(d, b, limit=limit).collect()]
        assert (5001, 7) in {(x, y) for x, y, _ in got}
        assert {(x, y): z for x, y, z in got if x != 5001} == pytest.approx(want)
    left = D.remove(d, b)
    assert left.columns == ["doc_id", "text"]
    assert {r.doc_id for r in left.collect()} == {None, 5000, *range(1000, 1060)}
    assert left.where("doc_id is null").count() == 1
    none = b.where(F.lit(False))
    assert D.find(d, none).count() == 0 and D.remove(d, none).count() == len(docs)
    assert D.find(d.where(F.lit(False)), b).count() == 0


def test_prefix_votes_and_windows():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 100, dtype=np.int64).view(np.uint64)
    votes = D.prefix_votes(h)
    for size, step in ((1, 1), (9, 1), (28, 4), (42, 7)):
        want = [
            sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h[a : a + size]) > size)
            for a in range(0, 100 - size + 1, step)
        ]
        assert D.window_prints(votes, size, step).tolist() == want
    assert len(D.window_prints(D.prefix_votes(h[:3]), 4, 1)) == 0


def test_edited_copies_of_twin_and_templated_items(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    twin, shared = [word() for _ in range(59)], [word() for _ in range(40)]
    items = [(k, " ".join(twin)) for k in range(3)]
    items += [(10 + k, " ".join(shared + [word() for _ in range(19)])) for k in range(4)]
    docs = []
    for k, text in items:
        words = text.split()
        words[30] = "edit"
        docs.append((k, " ".join([word() for _ in range(50)] + words + [word() for _ in range(50)])))
    got = D.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    assert set(found) == {(a, b) for a in range(3) for b in range(3)} | {(10 + k, 10 + k) for k in range(4)}
    assert all(x >= 50 / 60 - 1e-9 for x in found.values())


def test_several_edits_at_60_to_120_words(spark):
    """Every copy with a similarity of 0.8, whatever words are changed, put in or taken out."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    items, docs = [], []
    for k in range(400):
        text = [word() for _ in range(rng.randrange(60, 121))]
        items.append((k, " ".join(text)))
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(1, len(text) - 1)
            text[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
        docs.append((k, " ".join([word() for _ in range(40)] + text + [word() for _ in range(40)])))
    got = D.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert len(want) > 200 and {(r.doc_id, r.item_id): r.similarity for r in got.collect()} == pytest.approx(want)


def test_a_window_lies_in_every_run_that_edits_leave():
    for n in range(1, 700):
        run, windows = D.whole_run(n), set(D.fits(n))
        sizes = {s for s, _ in windows}
        for at in range(n - run + 1):
            assert any(
                all((s, a + k) in windows for k in range(D.stride(s)))
                for s in sizes
                for a in range(at, at + run - s - D.stride(s) + 2)
            ), (n, at)


def test_short_items_match_whole_documents_and_are_reported(spark):
    docs = spark.createDataFrame(
        [(1, "yes"), (2, "well yes of course it is"), (3, " YES\n"), (4, "no idea at all"), (5, "I have no idea at all"), (6, None)],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, "Yes"), (8, "no idea at all"), (9, "")], "item_id long, text string")
    everywhere = {(r.doc_id, r.item_id) for r in D.find(docs, items).collect()}
    assert everywhere == {(1, 7), (2, 7), (3, 7), (4, 8), (5, 8)}
    found = {(r.doc_id, r.item_id) for r in D.find(docs, items, least_words=5).collect()}
    assert found == {(1, 7), (3, 7), (4, 8)}
    assert {r.doc_id for r in D.remove(docs, items, least_words=5).collect()} == {2, 5, 6}
    assert sorted((r.item_id, r.words) for r in D.short_items(items, 5).collect()) == [(7, 1), (8, 4), (9, 0)]


def test_slices_of_a_long_text_find_the_same(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{rng.randrange(3000)}" for _ in range(9000)]
    lengths = [7, 15, 40, 59, 90, 160, 700]
    items = [(k, " ".join(f"item{k}x{j}" for j in range(n))) for k, n in enumerate(lengths)]
    for _, text in items:
        for at in (rng.randrange(len(words)), rng.randrange(len(words))):
            words[at:at] = text.split()
    benchmark = [(i, D.tokens(t), {s: 1.0 for s in D.runs(D.tokens(t), 5)}) for i, t in items]
    block = D.Block(benchmark)
    part = next(D.W.texts(D.pa.array([" ".join(words), "a short text"]), 1 << 40))
    whole = list(block.matches(part, 0.8))
    assert {m[1] for m in whole} >= {0, 1, 2, 3}
    for size in (50, 333, 1024):
        monkeypatch.setattr(D, "SLICE_WORDS", size)
        assert list(block.matches(part, 0.8)) == whole
