"""Line dedup: planted passages go, all else stays, and the cut equals a brute-force version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import line_dedup
from crowdpulse.llm import words as W
from crowdpulse.llm.queries import QUERIES

RNG = random.Random(5)


def prose(n):
    return [" ".join(RNG.choice("abcdefghij") + str(RNG.randrange(10**6)) for _ in range(10)) for _ in range(n // 10)]


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_planted_passages_go_and_the_rest_stays(spark):
    passage = prose(60)
    one_line = " ".join(prose(80))
    docs, own = [], {}
    for k in range(12):
        lines = prose(200)
        own[k] = lines
        at = 3 + k
        if k % 3 == 0:
            lines = lines[:at] + passage + lines[at:]
        elif k % 3 == 1:
            lines = [*lines[:at], lines[at] + " " + one_line + " " + lines[at + 1], *lines[at + 2 :]]
        docs.append((k, "\n".join(lines)))
    got = rows_of(line_dedup.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string")))
    for k, text in docs:
        left = got[k].split()
        mine = [w for line in own[k] for w in line.split()]
        assert [w for w in left if w in set(mine)] == mine, "own words stay in order"
        planted = len(text.split()) - len(mine)
        if k in (0, 1) or k % 3 == 2:
            assert got[k] == text
        else:
            assert len(left) - len(mine) <= planted * 0.5


def test_first_copy_stays_and_short_repeats_stay(spark):
    body = "\n".join(prose(100))
    rows = [(5, body, "a"), (2, body, "b"), (2, body, "b"), (9, "x y z\nlicence text here", "c"), (10, "x y z\nlicence text here", "c")]
    rows += [(None, None, "d"), (11, "", "d"), (12, " \n ", "d"), (None, "only one", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = line_dedup.remove_repeated(docs)
    assert out.columns == [*docs.columns, "removed_words"]
    got = sorted(((r.doc_id or 0), r.text, r.found, r.removed_words) for r in out.where("text is not null").collect())
    assert got == sorted(
        [(5, "", "a", 100), (2, body, "b", None), (2, body, "b", None), (0, "only one", "d", None)]
        + [(9, rows[3][1], "c", None), (10, rows[4][1], "c", None), (11, "", "d", None), (12, " \n ", "d", None)]
    )
    assert out.count() == len(rows)
    assert line_dedup.remove_repeated(docs.where(F.lit(False))).count() == 0


def test_long_text_with_one_giant_word(spark):
    text = "w" * 700_000 + "\n" + " ".join(prose(40_000))
    out = rows_of(line_dedup.remove_repeated(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")))
    assert out[1] == text and len(out[2]) < 0.01 * len(text)


def test_words_equal_split():
    texts = ["", "a b", None, " \x0b x y é\n", "tail", "w" * 600_000 + " z", "\t"]
    found = []
    for part in W.texts(pa.array(texts), 8):
        w = W.words(part)
        found += [(part.first + t, bytes(part.bytes[s:e])) for t, s, e in zip(w.text, w.start, w.end)]
    assert found == [(k, x) for k, t in enumerate(texts) for x in (t or "").encode().split()]
    w = W.words(next(W.texts(pa.array(["aa b aa", "b aa B"]))), lower=True)
    assert w.hash[0] == w.hash[2] == w.hash[4] and w.hash[1] == w.hash[3] == w.hash[5] != w.hash[0]


M = (1 << 64) - 1


def mixed(x):
    return int(W.mix(np.array([x & M], np.uint64))[0])


def word_hash(word):
    data = np.frombuffer(word, np.uint8)
    return int(W.hashes(data, np.array([0]), np.array([len(word)]))[0])


def lows(values):
    """Inner places less than the value before and not above the one after."""
    return {k for k in range(1, len(values) - 1) if values[k] < values[k - 1] and values[k] <= values[k + 1]}


def plain_chunks(text):
    """(words, start, end) of every chunk with two lines, by the rules and plain loops."""
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
    if not found:
        return []
    hashes = [word_hash(text[a:b]) for a, b in found]
    pairs = [mixed(h + (hashes[k - 1] if k else 0) * int(W.BASE)) for k, h in enumerate(hashes)]
    cuts = lows(pairs) | {0} | {k for k in range(1, len(found)) if b"\n" in text[found[k - 1][1] : found[k][0]]}
    at = sorted(cuts)
    lines = [list(range(a, b)) for a, b in zip(at, [*at[1:], len(found)])]
    power = [1]
    while len(power) < max(map(len, lines)):
        power.append(power[-1] * 0xD6E8FEB86659FD93 & M)
    own = [sum(hashes[k] * power[j] for j, k in enumerate(line)) & M for line in lines]
    rolling = [mixed(h + (own[k - 1] if k else 0) * int(W.BASE)) for k, h in enumerate(own)]
    begins = sorted({0} | lows(rolling) - {1})
    out = []
    for a, b in zip(begins, [*begins[1:], len(lines)]):
        parts = [a] if b - a <= line_dedup.MOST_LINES else list(range(a, b - 1, 2))
        for c, d in zip(parts, [*parts[1:], b]):
            if d - c >= 2:
                words = [k for line in lines[c:d] for k in line]
                out.append((c, d, words, found[words[0]][0], found[words[-1]][1]))
    return out


def brute(docs):
    """Texts after removal: exact copies whole, then chunks by their bytes, grown word by word."""
    first_of, out, seen, cuts = {}, {}, {}, {}
    order = sorted(docs, key=lambda r: r[0])
    for doc_id, text in order:
        first_of.setdefault(text, doc_id)
    for doc_id, text in order:
        if first_of[text] == doc_id:
            data = text.encode()
            cuts[doc_id] = plain_chunks(data)
            for n, (_, _, _, a, b) in enumerate(cuts[doc_id]):
                seen.setdefault(data[a:b], (doc_id, n))
    texts = dict(order)
    count = Counter(data for d, own in cuts.items() for data in {texts[d].encode()[c[3] : c[4]] for c in own})
    within = {d: Counter(texts[d].encode()[c[3] : c[4]] for c in own) for d, own in cuts.items()}

    def candidate(d, n):
        if not 0 <= n < len(cuts[d]):
            return False
        piece = texts[d].encode()[cuts[d][n][3] : cuts[d][n][4]]
        return count[piece] > 1 or within[d][piece] > 1

    for doc_id, text in order:
        data = text.encode()
        if first_of[text] != doc_id:
            out[doc_id] = "" if len(data.split()) >= line_dedup.MIN_WORDS else text
            continue
        words = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
        spans = []
        late = [n for n, c in enumerate(cuts[doc_id]) if seen[data[c[3] : c[4]]] != (doc_id, n)]
        runs = [g for g in grouped(late, cuts[doc_id])]
        for run in runs:
            begin, end = cuts[doc_id][run[0]][2][0], cuts[doc_id][run[-1]][2][-1]
            for side, n in ((-1, run[0]), (1, run[-1])):
                c = cuts[doc_id][n]
                other, m = seen[data[c[3] : c[4]]]
                theirs = texts[other].encode()
                their_words = [x.group() for x in re.finditer(rb"[^\x20\x09-\x0D]+", theirs)]
                place = cuts[other][m][2][0 if side < 0 else -1] + side
                beside = candidate(other, m + side) and cuts[other][max(m, m + side)][0] == cuts[other][min(m, m + side)][1]
                limit = len(cuts[other][m + side][2]) if beside else line_dedup.GROW
                for _ in range(limit):
                    mine = begin - 1 if side < 0 else end + 1
                    if not (0 <= mine < len(words) and 0 <= place < len(their_words)):
                        break
                    if data[slice(*words[mine])] != their_words[place]:
                        break
                    place += side
                    begin, end = (mine, end) if side < 0 else (begin, mine)
            if spans and begin <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([begin, end])
        gone = [(words[a][0], words[b][1]) for a, b in spans if b - a + 1 >= line_dedup.MIN_WORDS]
        out[doc_id] = line_dedup.without(data, gone).decode()
    return out


def grouped(late, cuts):
    """Numbers of late chunks in rows of neighbours (a chunk follows another where its lines do)."""
    rows = []
    for n in late:
        if rows and rows[-1][-1] == n - 1 and cuts[n][0] == cuts[n - 1][1]:
            rows[-1].append(n)
        else:
            rows.append([n])
    return rows


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert rows_of(QUERIES["op6_line_dedup"](spark, d)) == brute(docs)


def test_equal_hashes_of_unequal_bytes(spark, monkeypatch):
    """With a hash that collides always, the byte comparison alone decides."""
    real = line_dedup.cut

    def colliding(*args):
        found = real(*args)
        return *found[:-1], found[-1] % 3

    monkeypatch.setattr(line_dedup, "cut", colliding)
    shared = prose(100)
    docs = [(k, "\n".join(prose(60) + shared + prose(40))) for k in range(6)]
    out = rows_of(line_dedup.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out[0] == docs[0][1]
    for k, text in docs[1:]:
        assert 95 <= len(out[k].split()) <= 150 and set(text.split()) - set(" ".join(shared).split()) <= set(out[k].split())


def test_no_passage_of_51_to_80_words_is_missed(spark):
    """3000 random passages within a paragraph and as a line of their own: at most one word stays at an end."""
    rng = random.Random(11)
    words = lambda n: [rng.choice("abcdefghij") + str(rng.randrange(10**6)) for _ in range(n)]
    docs, planted = [], {}
    for k in range(3000):
        passage, sep = words(rng.randrange(51, 81)), " \n"[k % 2]
        planted[2 * k + 1] = set(passage)
        docs += [(2 * k + j, sep.join(" ".join(x) for x in (words(30), passage, words(30)))) for j in (0, 1)]
    out = rows_of(line_dedup.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string")))
    for k, text in docs:
        if k % 2 == 0:
            assert out[k] == text
            continue
        left = out[k].split()
        assert [w for w in text.split() if w not in planted[k]] == [w for w in left if w not in planted[k]]
        assert sum(w in planted[k] for w in left) <= 2, k


def test_chunks_have_several_lines_and_keep_their_boundaries():
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(10**6)) for _ in range(n)).encode()
    text = words(3000)
    own = plain_chunks(text)
    sizes = [d - c for c, d, *_ in own]
    assert min(sizes) >= 2 and max(sizes) <= line_dedup.MOST_LINES and len(own) > 200
    shifted = words(47) + b" " + text
    moved = {shifted[a:b] for *_, a, b in plain_chunks(shifted)}
    assert sum(text[a:b] in moved for *_, a, b in own) >= len(own) - 4


def test_clashing_count_is_refused(spark):
    docs = spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, removed_words long")
    with pytest.raises(ValueError):
        line_dedup.remove_repeated(docs)
    assert line_dedup.remove_repeated(docs, count="gone").columns == [*docs.columns, "gone"]


def test_spent_tables_go_and_a_text_is_shuffled_once(spark):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir()) if shared.exists() else set()
    passage = prose(60)
    rows = [(k, "\n".join(prose(40) + passage + prose(40))) for k in range(4)]
    out = line_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {p.name.rsplit("-", 1)[0] for p in set(shared.iterdir()) - before}
    assert left == {"first-copies", "passages"}
    shuffled = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "AS _doc" in x]
    assert len(shuffled) == 1 and ", text#" not in shuffled[0].split("AS _doc")[1]
    assert out.where("removed_words > 0").count() == 3


def test_chunks_meet_in_one_shuffle_and_a_common_one_once_a_batch(spark):
    """Chunks are not written and joined; of one that all texts share, a batch sends one row to where it is counted."""
    passage = " ".join(prose(60))
    rows = [(k, "\n".join([passage, *prose(40), *prose(40)])) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    cuts = [set(line_dedup.cut(next(W.texts(pa.array([t]))))[-1].tolist()) for _, t in rows[:300]]
    count = Counter(x for own in cuts for x in own)
    again = [n for n in count.values() if n > 1]
    assert max(again) == 300
    out = line_dedup.chunks(docs).toPandas()
    assert len(out) == sum(map(len, cuts)), "copies are cut once"
    several = out[out.known]
    assert len(several) == sum(again) and (several.deal == several.chunk).sum() == len(again)
    found = line_dedup.repeated_chunks(docs)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sum(len(r.chunks) for r in found.collect()) == sum(again)


def test_repeated_chunks_across_batches_equal_plain_counts(spark):
    rng = random.Random(9)
    lines = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(6)) for _ in range(80)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    texts += texts[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    own = [r.key for r in spark.createDataFrame([(t,) for t in texts], "text string").select(F.xxhash64("text").alias("key")).collect()]
    cuts = {}
    for key, text in zip(own, texts):
        part = next(W.texts(pa.array([text])))
        cuts[key] = line_dedup.cut(part)[-1].view(np.int64).tolist()
    count = Counter(c for chunks in cuts.values() for c in chunks)
    plain = {k: sorted({c for c in chunks if count[c] > 1}) for k, chunks in cuts.items()}
    got = {r.key: r.chunks for r in line_dedup.repeated_chunks(docs).collect()}
    assert got == {k: v for k, v in plain.items() if v}


def test_sorted_batches_are_cut_between_groups_only():
    rng = random.Random(2)
    values = sorted(rng.randrange(40) for _ in range(500))
    batches = [pa.RecordBatch.from_pydict({"v": pa.array(values[k : k + 7], pa.int64())}) for k in range(0, 500, 7)]
    got, groups = [], []
    for table, at in line_dedup.whole_groups(iter(batches), "v", rows=20):
        own = table.column("v").to_pylist()
        groups += [own[k] for k in at]
        got += own
    assert got == values and groups == sorted(set(values))
    assert not list(line_dedup.whole_groups(iter([batches[0].slice(0, 0)]), "v"))


def test_documents_without_id_come_first(spark):
    text, other = " ".join(prose(30)), " ".join(prose(30))
    rows = [(None, text), (3, text), (None, text), (None, other), (4, text + " x")]
    first = line_dedup.firsts(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.first.doc_id, r.copied) for r in first.collect()}
    assert got == {(None, True), (None, False), (4, False)} and first.count() == 3
