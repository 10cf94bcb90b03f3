"""Both classifiers: accuracy on held-out rows, planted texts, nothing leaked, edges of the tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import features, quality_classifier, toxicity
from crowdpulse.llm import words as W
from crowdpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize(
    "name, label, threshold, share_1, share_0",
    [("op1_toxicity", "toxic", 0.5, 0.85, 0.99), ("op9_quality_classifier", "quality", 0.3, 0.98, 0.95)],
)
def test_held_out_accuracy(spark, name, label, threshold, share_1, share_0):
    rows = QUERIES[name](spark, SF).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = lambda c: np.mean([p == y for p, y in seen if y == c])
    assert right(1) >= share_1 and right(0) >= share_0


def edge_tables(spark, small):
    docs = small.limit(150).collect()
    rows = [(r.doc_id, r.text, "en") for r in docs] + [(docs[0].doc_id, docs[0].text, "xx")]
    rows += [(None, "a text without an id", None), (900_001, None, None), (900_002, "", None), (900_003, "word " * 200_000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, x string").withColumn("features", F.lit("f")).withColumn("fold", F.lit(9))


def test_edges(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (0, None, None), (0, 0, 1)], labels.schema))
    docs = edge_tables(spark, small)
    none, one = labels.where(F.lit(False)), labels.where("quality = 1 and toxic = 0")
    for module in (quality_classifier, toxicity):
        for marks in (labels, none, one):
            rows = module.scored(docs, marks).collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.scored(docs.where(F.lit(False)), labels).count() == 0
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_held_out_labels_are_never_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = [r.doc_id for r in labels.collect() if is_held_out(r.doc_id)]
    flipped = labels.withColumns(
        {c: F.when(F.col("doc_id").isin(out), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")}
    )
    scores = lambda m, t: {r.doc_id: r.score for r in m.scored(docs, t).collect()}
    assert scores(quality_classifier, labels) == pytest.approx(scores(quality_classifier, flipped))
    assert scores(toxicity, labels) == pytest.approx(scores(toxicity, flipped))


def test_toxicity_features():
    lexicon = toxicity.Lexicon(
        toxicity.hashes_of(toxicity.INSULTS), toxicity.hashes_of(toxicity.SECOND), np.zeros(0, np.uint64), np.zeros(0)
    )
    texts = ["You are an IDIOT!!", "what a st0pid, no, st*upid l0ser", "the house is a nice house", "", "du bist ein DUMMKOPF", "an idíot"]
    x = toxicity.features(pa.array(texts), lexicon)
    assert x.shape == (6, len(features.NAMES) + len(toxicity.NAMES)) and np.isfinite(x).all()
    own = {n: x[:, len(features.NAMES) + k] for k, n in enumerate(toxicity.NAMES)}
    assert own["fixed_hits"].tolist() == [1, 2, 0, 0, 1, 0]
    assert own["near_second"].tolist() == [1, 0, 0, 0, 1, 0]
    assert own["disguised_hits"].tolist() == [0, 2, 0, 0, 0, 0]


def test_features_of_slices_equal_features_of_texts():
    texts = ["a b a b a b", None, "X | Y | Z!! $$$\n\nX | Y", "é 12 é 12", "\n", "one"]
    together = features.of_column(pa.array(texts))
    alone = np.concatenate([features.of_column(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and (alone[1] == alone[4]).all() and alone[1].sum() < 0.2
    names = dict(zip(features.NAMES, together[0]))
    assert names["repeated_words"] == 4 / 6 and names["repeated_triples"] == 2 / 6
    assert sum(len(W.words(p).hash) for p in W.texts(pa.array(texts))) == 20


