"""PII: base spans against Python's regular expressions, revealing terms against a brute-force version."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import pii
from crowdpulse.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(number))))
        return 14 <= len(number) <= 19 and total % 10 == 0
    return kind != "phone" or 10 <= len(number) <= 15


def base_of(text):
    found = [(m.start(), k, m.end(), m[0]) for k, p in enumerate(BASE.values()) for m in re.finditer(p, text or "")]
    return sorted(f for f in found if good(pii.KINDS[f[1]], f[3]))


def expected(doc_id, text):
    spans = base_of(text)
    joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e, _ in spans)
    counts = [sum(k == n for _, k, _, _ in spans) for n in range(4)]
    return (doc_id, *counts, hashlib.sha256(joined.encode()).hexdigest()), joined


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_regular_expressions(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = QUERIES["op2_pii"](spark, d).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(expected(*x)[0] for x in docs)
    for r in rows:
        own = [s for s in r.spans.split(",") if s and not s.startswith("term")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r.base_sha256


def test_odd_texts(spark):
    rng = random.Random(9)
    alphabet = ["a", "Z", "7", "0", "12", "255", "256", "@", ".", "-", " ", "+", "_", "(", ")", "é", "😀", "\n", "b@c.d", "1.2.3.4", "4111 1111 1111 1111"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "00.000.1.0255", "+1 (202) 555-0143.", "4111-1111-1111-1111 4111111111111112"]
    texts += [None, "", "a" * 300_000, "1" * 200_000, "@" * 5000, "+1" * 20_000, "a@" + "b." * 60_000, "1." * 50_000, "x" * 200_000 + "@mail.example.com"]
    rows = list(enumerate(texts)) + [(None, "q@r.st"), (None, "q@r.st"), (7, "q@r.st")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit(1)).withColumn("spans", F.lit(2))
    got = sorted((tuple(r)[:6] for r in pii.digest(pii.protected(docs)).collect()), key=repr)
    want = sorted((expected(*x)[0] for x in rows if x[1] is None or len(x[1]) < 100_000), key=repr)
    slow = {k for k, x in rows if x and len(x) >= 100_000}
    assert [g for g in got if g[0] not in slow] == [w for w in want if w[0] not in slow]
    assert {g[0]: g[1] for g in got if g[0] in slow}[len(texts) - 1] == 1
    assert len(got) == len(rows)
    assert pii.digest(pii.protected(docs.where(F.lit(False)))).count() == 0


def plain_names(text):
    """Lower-cased words written with a capital within a sentence, and never without one."""
    word = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_])){2,}")
    found, small = set(), set()
    for m in word.finditer(text):
        before = text[max(0, m.start() - 2) : m.start()]
        if m[0][0].islower():
            small.add(m[0])
        elif len(before) == 2 and before[1] == " " and before[0] not in ".!?:" and not before[0].isspace():
            found.add(m[0].lower())
    return found - small


def brute_terms(docs):
    """(entity value, term) -> disclosure, counting over all documents."""
    word = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_])){2,}")
    holds, near, spread, texts, names = {}, {}, {}, {}, set()
    for k, (_, text) in enumerate(docs):
        plain = re.sub(BASE["email"], " ", text)
        for w in set(word.findall(text.lower())):
            spread.setdefault(w, set()).add(k)
        for s, kind, e, value in base_of(text):
            name = (kind, value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value))
            holds.setdefault(name, set()).add(k)
            names |= {(name, w) for w in plain_names(plain)}
            for w in word.findall(plain.lower()):
                near.setdefault((name, w), set()).add(k)
                texts.setdefault((name, w), set()).add(text)
    out = {}
    for (name, w), ks in near.items():
        if (len(texts[name, w]) >= pii.SUPPORT or (name, w) in names) and len(holds[name]) < len(docs):
            ic = math.log(len(docs) / len(holds[name]))
            d = math.log(len(ks) * len(docs) / (len(spread[w]) * len(holds[name]))) / ic
            if d >= pii.GENERALISE:
                out[name, w] = d
    return out


def test_revealing_terms(spark):
    rng = random.Random(4)
    common = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("lm", "rt", "nd", "sk")]
    line = lambda n: " ".join(rng.choices(common, k=n))
    docs = [(k, line(80)) for k in range(60)]
    docs += [(100 + k, f"{line(30)} write to Zebulon O'Quark at z.quark@mail.example.org or {line(2)}, {line(30)} ZEBULON.") for k in range(6)]
    docs += [(200 + k, f"{line(20)} call Jane on +1 202 555 0143 {line(20)}") for k in range(5)]
    docs += [(300 + k, f"{line(20)} Jane {line(20)}") for k in range(40)]
    docs += [(400, docs[60][1])] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_terms(docs)
    assert {w for _, w in want} >= {"zebulon", "o'quark"} and "jane" not in {w for _, w in want}
    base = pii.detected(df)
    got = {(r.entity, r.term): r.disclosure for r in pii.risky(df, base).collect()}
    assert sorted(t for _, t in got) == sorted(w for _, w in want)
    assert sorted(got.values()) == pytest.approx(sorted(want.values()))
    spans = {r.doc_id: r.spans for r in pii.digest(pii.protected(df)).collect()}
    assert all("term" not in spans[k] for k, _ in docs if k < 100 or 300 <= k < 400)
    text = dict(docs)[103]
    words = [text[int(s) : int(e)] for kind, s, e in (x.split(":") for x in spans[103].split(",")) if kind == "term"]
    assert {"Zebulon", "O'Quark", "ZEBULON"} <= set(words)
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[5] == docs[5][1] and "[EMAIL]" in clean[103] and "[PHONE]" in clean[202]
    assert "zebulon" not in clean[103].lower() and "quark" not in clean[103].lower() and "Jane" in clean[202]
    again = {r.doc_id: r.spans for r in pii.digest(pii.protected(df)).collect()}
    assert again == spans


def test_terms_of_an_entity_in_one_text(spark):
    """A name that stands only beside one address, or far from it in its text, gives it away."""
    rng = random.Random(6)
    common = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("lm", "rt", "nd", "sk")]
    line = lambda n: " ".join(rng.choices(common, k=n))
    docs = [(k, line(200)) for k in range(60)]
    docs += [(100, f"Quillon {line(150)} uniqueword ask Zebulon at z.quark@mail.example.org {line(150)} Vortigern")]
    docs += [(101, docs[-1][1])]  # a copy changes nothing
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.term: r.disclosure for r in pii.risky(df, pii.detected(df)).collect()}
    assert got == {t: pytest.approx(1.0) for t in ("zebulon", "vortigern")}
    spans = {r.doc_id: r.spans for r in pii.digest(pii.protected(df)).collect()}
    words = [docs[60][1][int(s) : int(e)] for kind, s, e in (x.split(":") for x in spans[100].split(",")) if kind == "term"]
    assert words == ["Zebulon", "Vortigern"] and spans[101] == spans[100]
    assert not any(spans[k] for k in range(60))


def test_ordinary_rare_words_stay(spark):
    recipe = "Recipe: add cinnamon and nutmeg to the batter then bake. Questions to joe@example.org please"
    rows = [(0, recipe), (1, "we met with Xanthippe near the lake, write to x@example.org soon")]
    rows += [(2 + k, "the house and the garden were quiet then") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert clean[0] == recipe.replace("joe@example.org", "[EMAIL]")
    assert "Xanthippe" not in clean[1] and "[EMAIL]" in clean[1] and "lake" in clean[1]


def test_very_many_matches_in_one_text(spark):
    """Linear time: a quadratic version takes about an hour."""
    n = 100_000
    text = " ".join(f"a{k}@b.cd" for k in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.monotonic()
    row = pii.detected(df).select(F.size("found").alias("n"), F.element_at("found", -1).alias("last")).first()
    assert time.monotonic() - began < 60
    assert row.n == n and row.last.end == len(text)
