"""State in buckets, stored running counts, the join of two streams, the incremental learner."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdpulse.operators import learning as batch_learning
from crowdpulse.operators import serving
from crowdpulse.params import CATEGORICAL_INPUTS, DEFAULT, LABEL, NUMERIC_INPUTS
from crowdpulse.session import run_dir
from crowdpulse.streaming import batches, joins, learning, prefix, statistics
from crowdpulse.streaming.buckets import BucketTable

SCHEMA = "key string, n long"
START = datetime(2026, 1, 1)


def table(spark, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketTable(spark, run_dir(spark, "buckets"), schema, "key", **options)


def summed(rows):
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def files(spark, folders):
    return set(spark.read.schema(SCHEMA).parquet(*folders).inputFiles()) if folders else set()


def test_upsert_rewrites_named_buckets_only(spark):
    t = table(spark, buckets=8, fold_every=1)
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(200)], SCHEMA)
    t.write(rows, 0)
    t.fold(1, t.touched(0), summed)
    before = {b: files(spark, t.folders(1, [b])) for b in range(8)}
    t.write(spark.createDataFrame([("k3", 1000)], SCHEMA), 1)
    named = t.touched(1)
    t.fold(2, named, summed)
    assert len(named) == 1
    after = {b: files(spark, t.folders(2, [b])) for b in range(8)}
    assert all((after[b] == before[b]) == (b not in named) for b in range(8))
    assert {r["key"]: r.n for r in t.current().collect()} == {f"k{i}": i + 1000 * (i == 3) for i in range(200)}
    # A reader that began before finds its files; the batch again leaves the same table.
    assert all(spark.read.parquet(f).count() >= 0 for own in before.values() for f in own)
    t.write(spark.createDataFrame([("k3", 1000)], SCHEMA), 1)
    t.fold(2, named, summed)
    assert {r["key"]: r.n for r in t.current().collect()}["k3"] == 1003


def test_folds_keep_the_sum_and_bound_the_folders(spark):
    t = table(spark, buckets=2, fold_every=3)
    for n in range(11):
        t.write(spark.createDataFrame([("a", n), (None, 1)], SCHEMA), n)
        t.fold(n, t.touched(n), summed)
    assert {r["key"]: r.n for r in summed(t.current()).collect()} == {"a": 55, None: 11}
    assert max(len(t.folders(11, [b])) for b in range(2)) <= 4
    assert {r["key"]: r.n for r in summed(t.before(10)).collect()} == {"a": 45, None: 10}


EVENTS = "event_id long, image_id string, kind string, ts timestamp"


def made(seed, n):
    rng = random.Random(seed)
    times = [START + timedelta(seconds=rng.randrange(6 * 3600)) for _ in range(n)]
    return [(k, rng.choice(["hot", "hot", "b", "c"]), rng.choice(["view", "comment", "flag"]), t) for k, t in enumerate(times)]


@pytest.mark.parametrize("parts", [1, 4])
def test_prefix_sums_equal_the_history(spark, parts):
    """Batches in any order of time: late events change nothing that is stored."""
    rows = made(3, 600)
    rows += [(600 + k, "hot", "view", START + timedelta(minutes=k)) for k in range(5)]  # on minute edges
    events = spark.createDataFrame(rows, EVENTS)
    asked = [(k, i, "viral", t) for k, (_, i, _, t) in enumerate(made(4, 40))] + [(90, "hot", "x", START + timedelta(hours=1, minutes=2)), (91, "none", "x", START)]
    requests = spark.createDataFrame(asked, "request_id long, image_id string, trigger string, ts timestamp")
    t = prefix.PrefixSums(spark, run_dir(spark, "prefix"), buckets=2, fold_every=2)
    for n in range(parts):
        t.add(events.filter(F.col("event_id") % parts == n), n)
    t.add(events.filter(F.col("event_id") % parts == parts - 1), parts - 1)  # again
    want = serving.activity_at(requests, events, DEFAULT)
    got = t.counts_at(requests, DEFAULT).select(want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_join_keeps_requests_without_events_and_splits_hot_images(spark):
    rows, asked = made(5, 400), [(k, i, "viral", t) for k, (_, i, _, t) in enumerate(made(6, 30))]
    asked += [(50, "nobody", None, START + timedelta(hours=2)), (51, None, "x", START)]
    kind = "request_id long, image_id string, trigger string, ts timestamp"
    events, requests = spark.createDataFrame(rows, EVENTS), spark.createDataFrame(asked, kind)
    want = serving.activity_at(serving.accepted_requests(requests), events, DEFAULT)
    names = ["request_id", "image_id", "trigger", *[f"{k}s_{w}" for k in joins.KINDS for w in DEFAULT.serving_seconds]]
    a, b, out = (run_dir(spark, n) for n in ("join-asked", "join-events", "join-out"))
    far = [START + timedelta(days=d) for d in (5, 10)]
    for k in range(2):
        half = START + timedelta(hours=3)
        side = F.col("ts") < F.lit(half) if k == 0 else F.col("ts") >= F.lit(half)
        requests.filter(side).write.mode("append").parquet(a)
        events.filter(side).write.mode("append").parquet(b)
        if k:
            for t in far:
                spark.createDataFrame([(-1, "end", "x", t)], kind).write.mode("append").parquet(a)
                spark.createDataFrame([(-1, "end", "view", t)], EVENTS).write.mode("append").parquet(b)
        for _ in range(1 + k):
            counted = joins.request_counts(
                spark.readStream.schema(kind).option("maxFilesPerTrigger", 100).parquet(a),
                spark.readStream.schema(EVENTS).parquet(b),
                DEFAULT,
                salts=3,
            )
            batches.run_available(counted, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/t/batch_id={n}"), f"{out}/c")
    got = spark.read.parquet(f"{out}/t").filter("request_id >= 0").select(names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(names).collect()))


def training(spark, n=300):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        numbers = [None if rng.random() < 0.05 else rng.uniform(0, 10) for _ in NUMERIC_INPUTS]
        words = [str(rng.randrange(2)), None if k % 7 == 0 else str(rng.randrange(2)), rng.choice(["Soup", "Rice", "Egg"])]
        rows.append((k, *numbers, *words, int(rng.random() < 0.5)))
    columns = ["id long", *[f"{c} double" for c in NUMERIC_INPUTS], *[f"{c} string" for c in CATEGORICAL_INPUTS], f"{LABEL} int"]
    return rows, spark.createDataFrame(rows, ", ".join(columns))


def plain_learner(parts, rate=0.5, penalty=1e-4):
    """The same batches in plain loops."""
    size, first = len(NUMERIC_INPUTS), parts[0]
    value = lambda x: 0.0 if x is None else float(x)
    columns = list(zip(*[[value(x) for x in r[1 : 1 + size]] for r in first]))
    mean = [sum(c) / len(c) for c in columns]
    dev = [math.sqrt(sum((x - m) ** 2 for x in c) / len(c)) or 1.0 for c, m in zip(columns, mean)]
    text = lambda r: ["Unknown" if x is None else str(x) for x in r[1 + size : -1]]
    known = sorted({(n, v) for r in first for n, v in zip(CATEGORICAL_INPUTS, text(r))})

    def inputs(r):
        pairs = set(zip(CATEGORICAL_INPUTS, text(r)))
        return [(value(x) - m) / d for x, m, d in zip(r[1 : 1 + size], mean, dev)] + [float(p in pairs) for p in known] + [1.0]

    w = [0.0] * (size + len(known) + 1)
    squares = list(w)
    for part in parts:
        gradient = [0.0] * len(w)
        for r in part:
            x = inputs(r)
            e = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))) - r[-1]
            gradient = [g + e * v for g, v in zip(gradient, x)]
        gradient = [g / len(part) + penalty * a * (k < len(w) - 1) for k, (g, a) in enumerate(zip(gradient, w))]
        squares = [s + g * g for s, g in zip(squares, gradient)]
        w = [a - rate * g / (math.sqrt(s) + 1e-12) for a, g, s in zip(w, gradient, squares)]
    return w, inputs


def test_incremental_learner_equals_plain_loops_and_resumes(spark):
    rows, df = training(spark)
    parts = [[r for r in rows if r[0] % 4 == n] for n in range(4)]
    path = run_dir(spark, "learner")
    for n in (0, 1, 1, 2, 3):  # the second batch twice, each by a learner that knows the table only
        learning.IncrementalLearner(spark, path).handle(df.filter(F.col("id") % 4 == n), n)
    learner = learning.IncrementalLearner(spark, path)
    learner.handle(df.filter("false"), 4)
    state = learner.current()
    w, inputs = plain_learner(parts)
    assert list(state.weights) == pytest.approx(w, abs=1e-9)
    assert (state.rows_seen, state.batches_seen) == (300, 4)
    scored = learner.predictor()(df)
    assert scored.columns[: len(df.columns)] == df.columns
    for r in scored.collect()[:50]:
        x = inputs(next(q for q in rows if q[0] == r.id))
        assert r.moderation_probability == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x)))), abs=1e-9)
        assert r.inference_mode == "incremental"


def test_batch_model_scores_equal_plain_products(spark):
    """The scores of the fitted pipeline, from its own means, deviations and coefficients."""
    rows, df = training(spark, 120)
    model = batch_learning.fit(df)
    got = {r.id: r.moderation_probability for r in batch_learning.score(model, df, ["id"]).collect()}
    indexer, _, _, scaler, _, logistic = model.stages
    size = len(NUMERIC_INPUTS)
    mean, dev, weights = scaler.mean.toArray(), scaler.std.toArray(), logistic.coefficients.toArray()
    for r in rows:
        x = [((0.0 if v is None else v) - m) / d for v, m, d in zip(r[1 : 1 + size], mean, dev)]
        for labels, v in zip(indexer.labelsArray, r[1 + size : -1]):
            x += [float(("Unknown" if v is None else v) == label) for label in labels]
        score = sum(a * b for a, b in zip(weights, x)) + logistic.intercept
        assert got[r[0]] == pytest.approx(1 / (1 + math.exp(-score)), abs=1e-9)


def test_latency_of_stages_from_reports(spark):
    rows = [("q", "r", k, 10 * (k % 2), "t", stage, 100 + k) for k in range(10) for stage in ("addBatch", "triggerExecution")]
    table = spark.createDataFrame(rows, statistics.ROWS)
    assert [tuple(r) for r in statistics.batch_counts(table).collect()] == [("q", 5, 50)]
    got = {r.stage: r.millis for r in statistics.stage_latency(table, (0.5, 0.9)).collect()}
    assert got == {"addBatch": [104, 108], "triggerExecution": [104, 108]}


def test_stream_join_copies_a_request_for_the_parts_its_window_reaches_only(spark):
    reach = max(DEFAULT.serving_seconds.values())
    at = START + timedelta(hours=5)
    edges = [timedelta(seconds=s) for s in (0, 1, reach // 2, reach, reach + 1)] + [timedelta(seconds=-1)]
    events = spark.createDataFrame([(k, "a", "view", at - d) for k, d in enumerate(edges)], EVENTS)
    requests = spark.createDataFrame(
        [(1, "a", "viral", at), (2, "a", "viral", None)], "request_id long, image_id string, trigger string, ts timestamp"
    )
    for salts in (1, 2, 7):
        counted = joins.request_counts(requests, events, DEFAULT, salts=salts).filter("request_id = 1").first()
        longest = max(DEFAULT.serving_seconds, key=DEFAULT.serving_seconds.get)
        assert counted[f"views_{longest}"] == 4, "both ends of the window count"
    a, b, c = (run_dir(spark, n) for n in ("copies-asked", "copies-events", "copies-state"))
    requests.filter("request_id = 1").write.parquet(a)
    events.limit(0).write.parquet(b)
    streams = [spark.readStream.schema(t.schema).parquet(p) for t, p in ((requests, a), (events, b))]
    query = batches.run_available(joins.request_counts(*streams, DEFAULT), lambda df, n: df.count(), c)
    kept = [o.numRowsTotal for p in query.recentProgress for o in p.stateOperators if "Join" in o.operatorName]
    assert max(kept) == 3
