"""The pipeline: every stage on what the one before kept, against its operator's plain meaning."""

from pyspark.sql import functions as F

import corpus_pipeline
from crowdpulse.llm import decontaminate, simhash
from crowdpulse.llm.tables import staged

SF = "/root/testdata/sf0.01"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, seen, kept = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = staged(stage(spark, docs, SF), name)
        seen[name], kept[name] = before, [r.asDict() for r in docs.collect()]
        if name != "source_mixing":
            assert docs.columns == columns
            assert len({r["doc_id"] for r in kept[name]}) == len(kept[name])
    ids = lambda n: {r["doc_id"] for r in kept[n]}
    gone = set(seen["quality_classifier"]) - ids("quality_classifier")
    assert all(labels.get(d, 0) == 0 for d in gone) and sum(labels.get(d) == 0 for d in gone) >= 50
    for r in kept["line_dedup"]:
        assert r["text"] and len(r["text"]) <= len(seen["line_dedup"][r["doc_id"]])
    near = spark.createDataFrame(list(seen["simhash_near_dedup"].items()), "doc_id long, text string")
    firsts = {r.component_id for r in simhash.near_duplicates(near).collect()}
    assert ids("simhash_near_dedup") == firsts
    left = spark.createDataFrame([(r["doc_id"], r["text"]) for r in kept["benchmark_decontamination"]], "doc_id long, text string")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.find(left, benchmark).count() == 0
    for item in benchmark.collect():
        assert not any(item.text in r["text"] for r in kept["benchmark_decontamination"])
    words = sum(len(r["text"].split()) for r in kept["benchmark_decontamination"])
    assert abs(sum(r["mix_words"] for r in kept["source_mixing"]) - 1.5 * words) <= 20
    run = corpus_pipeline.run(spark, SF)
    key = lambda r: (r["doc_id"], r["mix_pass"], r["mix_shard"], r["mix_position"], r["mix_words"], r["text"])
    assert sorted(map(key, kept["source_mixing"])) == sorted(key(r.asDict()) for r in run.collect())


def test_odd_tables(spark):
    """Nulls, empty and long texts, repeated rows and extra columns pass every stage."""
    rows = [(None, "a null id " * 20, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0)]
    rows += [(3, "the same row " * 30, "en", "s", 1)] * 3 + [(4, "long words " * 50_000, "en", "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(c) for c in ("_hash", "fp", "chunk", "found", "key", "spans")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert out.count() >= 0
        assert stage(spark, docs.where(F.lit(False)), SF).count() == 0, name
