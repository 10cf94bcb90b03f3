"""Quality rules against a brute-force version, and the edges of the table."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import quality_rules as Q
from crowdpulse.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    repeated = {k + d for k in range(len(words) - 2) for d in range(3) if windows[tuple(words[k : k + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    again = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated)


def brute(docs, most_documents=Q.MOST_DOCUMENTS, left=Q.LEFT):
    def lines(text):
        out = Counter()
        for x in (text or "").lower().translate(str.maketrans("123456789", "0" * 9)).split("\n"):
            words = WORD.findall(x)
            if words:
                out[" ".join(words)] += len(words)
        return out

    hosts = defaultdict(Counter)
    for source, text in {(s, t or "") for _, t, s in docs}:
        hosts[source].update(lines(text).keys())
    out = []
    for doc_id, text, source in docs:
        c = plain_counts(text)
        often = {x for x, n in hosts[source].items() if n > most_documents}
        gone = sum(n for x, n in lines(text).items() if x in often)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        out.append((doc_id, *c, failed, not failed and c[0] - gone >= left * c[0]))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op4_quality_rules"](spark, d).collect())) == sorted(brute(docs))


def test_frequent_lines_and_edges(spark):
    words = lambda k, n=60: " ".join(f"w{k}x{j}" for j in range(n))
    menu = " ".join(f"Menu{j}" for j in range(70))
    docs = [(k, f"{menu} {k % 10}\n{words(k)}", "a") for k in range(30)]  # digits do not tell lines apart
    docs += [(100 + k, f"{menu} 5\n{words(100 + k, 200)}", "a") for k in range(5)]
    docs += [(200 + k, f"{menu} 5\n{words(7000)}", "b") for k in range(30)]  # copies are one document
    docs += [(300, None, "a"), (301, "", None), (None, words(1), None), (None, words(1), None), (302, " \n\n", "a")]
    docs += [(303, words(5, 200_000), "c"), (304, "é🙂 x\n" * 4, "c")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("line", F.lit("x")).withColumn("c", F.lit(1))
    out = Q.judged(df)
    got = sorted((tuple(r[c] for c in ("doc_id", *Q.COUNTS, "base_failed", "kept")) for r in out.collect()), key=repr)
    assert got == sorted(brute(docs), key=repr)
    kept = {g[0]: g[-1] for g in got}
    assert not any(kept[k] for k in range(30)) and all(kept[k] for k in [*range(100, 105), *range(200, 230)])
    assert Q.judged(df.where(F.lit(False))).count() == 0


def test_verdict_does_not_change_with_the_table(spark):
    """The same boilerplate documents in a small and in a large host get the same verdict."""
    letters = str.maketrans("0123456789", "abcdefghij")  # digits don't tell lines apart
    words = lambda k, n=60: " ".join(f"w{k}x{j}".translate(letters) for j in range(n))
    lines = "\n".join(" ".join(f"Shared{k}{j}".translate(letters) for j in range(10)) for k in range(8))
    made = [(k, f"{lines}\n{words(k, 20)}") for k in range(30)]
    for size in (100, 2000):
        docs = made + [(1000 + k, words(1000 + k)) for k in range(size)]
        df = spark.createDataFrame([(*d, "a") for d in docs], "doc_id long, text string, source string")
        kept = {r.doc_id: r.kept for r in Q.judged(df).collect()}
        assert not any(kept[k] for k in range(30)) and all(kept[k] for k in kept if k >= 1000)
