"""Streams give the batch results, whatever the micro-batches."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdpulse.functions.times import iso
from crowdpulse.operators import alerts, counters, entities as batch_entities, messages, serving
from crowdpulse.params import DEFAULT, SCALED
from crowdpulse.session import run_dir
from crowdpulse.sources import sinks, streams
from crowdpulse.streaming import batches, entities, scoring, windows
from crowdpulse.streaming.alerts import AlertJob

PARAMS = replace(
    DEFAULT,
    rolling_seconds={"1min": 60, "5min": 300, "1hr": 3600},
    viral_views_5min=5,
    suspicious_comments_1min=2,
    popular_views_1hr=8,
    milestones=(3, 10, 20),
)
EVENTS = "image_id string, event_id bigint, kind string, ts timestamp"


def made(spark, size=240, seed=5):
    """Three images, the first with half of the events, over five hours, with ties."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(5 * 60) for _ in range(size))
    rows = [
        (
            rng.choice(["hot", "hot", "b", "c"]),
            n,
            rng.choice(["view", "view", "comment", "flag"]),
            datetime(2026, 1, 1) + timedelta(minutes=m),
        )
        for n, m in enumerate(times)
    ]
    return spark.createDataFrame(rows, EVENTS)


def sent(events):
    clock = iso(F.col("ts"))
    view = F.col("kind") == "view"
    shaped = events.select(
        F.struct(F.timestamp_micros("event_id").alias("arrived_at"), F.lit(0).alias("partition"), F.col("event_id").cast("long").alias("offset")).alias("arrival"),
        F.col("kind").alias("event_type"),
        "image_id",
        F.when(F.col("kind") == "comment", F.col("event_id").cast("string")).alias("comment_id"),
        F.when(view, clock).alias("viewed_at"),
        F.when(~view, clock).alias("created_at"),
    )
    return messages.encode(shaped, messages.topic_of(F.col("event_type")), shaped.columns[1:], ("arrival",))


def run_in_parts(spark, events, cuts, start):
    source = run_dir(spark, "test-messages")
    bounds = [0, *cuts, 10**9]
    for low, high in zip(bounds, bounds[1:]):
        sinks.land(sent(events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))), source)
        start(source)


def run_alerts(spark, events, cuts, **options):
    out = run_dir(spark, "test-alerts")
    job = AlertJob(spark, f"{out}/tables", PARAMS, **options)

    def start(source):
        batches.run_available(streams.events_of(streams.landed_messages(spark, source)), job.handle, f"{out}/checkpoint")

    run_in_parts(spark, events, cuts, start)
    return job


def numbered(rows):
    return rows.withColumn("event_id", F.col("arrival.offset"))


COUNTS = ["event_id", *[f"{k}s_{w}" for k in ("view", "comment", "flag") for w in ("1min", "5min", "1hr")]]


@pytest.mark.parametrize("cuts", [[], [100], [30, 31, 90, 200]])
def test_rolling_alerts_equal_batch(spark, cuts):
    events = made(spark)
    job = run_alerts(spark, events, cuts, buckets=3, fold_every=2)
    counts = alerts.activity_counts(events, PARAMS)
    assert sorted(numbered(job.counts).select(COUNTS).collect()) == sorted(counts.select(COUNTS).collect())

    columns = ["image_id", "alert_type", "event_id", "value"]
    want = alerts.first_alerts(alerts.crossings(counts, PARAMS)).select(columns).collect()
    assert sorted(numbered(job.alerts).select(columns).collect()) == sorted(want)
    columns = ["image_id", "milestone_value", "event_id"]
    want = alerts.milestones(counts, PARAMS).select(columns).collect()
    assert sorted(numbered(job.milestones).select(columns).collect()) == sorted(want)
    assert job.requests.count() == sum(a.alert_type != "popular" for a in job.alerts.collect())


def test_a_repeated_batch_changes_nothing(spark):
    events = made(spark)
    job = run_alerts(spark, events, [100])
    before = [sorted(t.collect()) for t in (job.alerts, job.milestones.drop("batch_id"))]
    again = messages.with_event_time(messages.decode(sent(events.filter("event_id >= 100"))))
    job.handle(again, 1)
    assert [sorted(t.collect()) for t in (job.alerts, job.milestones.drop("batch_id"))] == before


def test_late_event_is_counted(spark):
    events = made(spark)
    job = run_alerts(spark, events, [100])
    late = spark.createDataFrame([("hot", 9_000, "view", datetime(2020, 1, 1))], EVENTS)
    job.handle(messages.with_event_time(messages.decode(sent(late))), 2)
    row = numbered(job.counts).filter("event_id = 9000").first()
    assert (row.views_1min, row.views_1hr, row.comments_1hr) == (1, 1, 0)


def handled(job, spark, rows, batch_id):
    job.handle(messages.with_event_time(messages.decode(sent(spark.createDataFrame(rows, EVENTS)))), batch_id)


def test_files_of_a_batch_do_not_grow_with_untouched_images(spark):
    """Many batches of other images come first: a batch of one image opens its own bucket's folders only."""
    out = run_dir(spark, "test-buckets")
    start = datetime(2026, 1, 1)
    job = AlertJob(spark, f"{out}/t", PARAMS, buckets=8, fold_every=3)
    handled(job, spark, [("a", 0, "view", start)], 0)
    own = job.recent.touched(0)
    few = [len(t.folders(1, own)) for t in (job.recent, job.totals_table, job.alerts_table)]
    others = [f"u{k}" for k in range(400)]
    bucket = job.recent.bucket()
    apart = spark.createDataFrame([(u,) for u in others], "image_id string").filter(~bucket.isin(*own))
    apart = [r.image_id for r in apart.limit(60).collect()]
    for n in range(1, 9):
        rows = [(u, 100 * n + k, "view", start + timedelta(minutes=n)) for k, u in enumerate(apart)]
        handled(job, spark, rows, n)
    assert [len(t.folders(9, own)) for t in (job.recent, job.totals_table, job.alerts_table)] == few
    handled(job, spark, [("a", 5000, "view", start + timedelta(minutes=2))], 9)
    assert job.recent.touched(9) == own
    plan = job.recent.before(9, own)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(plan)) < int(str(job.recent.current()._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) / 4
    assert [r.views_5min for r in numbered(job.counts).filter("event_id = 5000").collect()] == [2]
    # Folders of a touched bucket are bounded by the folds, however many batches there were.
    assert max(len(t.folders(10, [b])) for t in (job.recent, job.totals_table) for b in range(8)) <= 2 * job.recent.fold_every
    with pytest.raises(ValueError):
        AlertJob(spark, f"{out}/t", PARAMS, buckets=4)


def test_fold_drops_what_no_window_reaches(spark):
    out = run_dir(spark, "test-expiry")
    start = datetime(2026, 1, 1)
    job = AlertJob(spark, f"{out}/t", PARAMS, buckets=1, fold_every=2, late_seconds=600)
    for n in range(7):
        handled(job, spark, [("a", n, "view", start + timedelta(minutes=30 * n))], n)
    kept = sorted(r.ts for r in job.recent.current().collect())
    assert kept[0] >= start + timedelta(minutes=30 * 5 - 70) and kept[-1] == start + timedelta(minutes=180)
    assert sorted(r.views_1hr for r in job.counts.collect()) == [1, 2, 2, 2, 2, 2, 2]
    assert [r.total_views for r in job.totals(7).collect()] == [7]
    # A later batch asks for the same state again and finds it.
    before = sorted(job.counts.collect())
    handled(job, spark, [("a", 6, "view", start + timedelta(minutes=180))], 6)
    assert sorted(job.counts.collect()) == before


def test_idle_images_expire_by_arrival(spark):
    out = run_dir(spark, "test-idle-images")
    start = datetime(2026, 1, 1)
    job = AlertJob(spark, f"{out}/t", PARAMS, buckets=1, fold_every=1, idle_seconds=10)
    handled(job, spark, [("a", 0, "view", start)], 0)
    for n in range(1, 4):  # arrivals are micros of the id: 20 seconds apart
        handled(job, spark, [("b", 20_000_000 * n, "view", start)], n)
    assert {r.image_id for r in job.recent.before(3).collect()} == {"b"}


@pytest.mark.parametrize("cuts", [[], [60, 170]])
def test_window_counts_equal_batch(spark, cuts):
    events = made(spark)
    out = run_dir(spark, "test-windows")

    def start(source):
        stream = streams.events_of(streams.landed_messages(spark, source), stamp_missing=False)
        batches.run_available(stream, windows.window_writer(f"{out}/t", PARAMS), f"{out}/c")

    run_in_parts(spark, events, cuts, start)
    columns = ["kind", "image_id", "window_start", "window_end", "event_count"]
    got = windows.final_windows(spark, f"{out}/t").select(columns)
    assert sorted(got.collect()) == sorted(counters.tumbling_counts(events).select(columns).collect())


def test_run_without_new_data_writes_nothing(spark):
    events = made(spark, 20)
    out = run_dir(spark, "test-idle")
    source = run_dir(spark, "test-idle-messages")
    sinks.land(sent(events), source)
    for _ in range(2):
        stream = streams.events_of(streams.landed_messages(spark, source), stamp_missing=False)
        query = batches.run_available(stream, windows.window_writer(f"{out}/t", PARAMS), f"{out}/c")
    assert batches.read_batches(spark, f"{out}/t").agg(F.sum("event_count")).first()[0] == 20
    assert sum(p["rows"] for p in batches.progress(query)) == 0


def test_small_batches_by_files_per_trigger(spark):
    events = made(spark, 60)
    out = run_dir(spark, "test-trigger")
    source = run_dir(spark, "test-trigger-messages")
    sinks.land(sent(events).repartition(4), source)
    stream = streams.events_of(streams.landed_messages(spark, source, files_per_trigger=2), stamp_missing=False)
    query = batches.run_available(stream, windows.window_writer(f"{out}/t", PARAMS), f"{out}/c")
    assert batches.read_batches(spark, f"{out}/t").agg(F.sum("event_count")).first()[0] == 60
    assert len([p for p in batches.progress(query) if p["rows"]]) > 1
    assert all("addBatch" in p["duration_ms"] for p in batches.progress(query) if p["rows"])


def test_counters_in_the_progress(spark):
    out = run_dir(spark, "test-observe")
    lines = sent(made(spark, 30)).drop("arrival").unionByName(
        spark.createDataFrame([("views", '{"event_type":"view"}'), ("views", "junk")], "topic string, value string")
    )
    sinks.publish(lines, path=f"{out}/m")
    timed = streams.events_of(streams.file_messages(spark, f"{out}/m"), stamp_missing=False)
    query = batches.run_available(messages.observed(timed, "events"), windows.window_writer(f"{out}/t", PARAMS), f"{out}/c")
    seen = [p["observed"]["events"] for p in batches.progress(query) if p["observed"]]
    assert {k: sum(s[k] for s in seen) for k in seen[0]} == {
        "events_read": 32,
        "events_processed": 30,
        "events_skipped": 2,
    }


def test_lifetime_totals_equal_batch(spark):
    events = made(spark)
    out = run_dir(spark, "test-totals")

    def start(source):
        stream = messages.valid(streams.events_of(streams.landed_messages(spark, source)))
        batches.run_available(windows.running_totals(stream), windows.totals_writer(f"{out}/t"), f"{out}/c", "update")

    run_in_parts(spark, events, [50, 51], start)
    got = windows.latest_totals(spark, f"{out}/t").collect()
    assert sorted(got) == sorted(counters.lifetime_totals(events).collect())


def scoring_tables(spark):
    users = spark.createDataFrame([("u", datetime(2025, 1, 1))], "id string, created_at timestamp")
    images = spark.createDataFrame(
        [(i, "u", "text", "Soup", datetime(2026, 1, 1)) for i in ("hot", "b", "c")],
        "id string, user_id string, caption string, category string, created_at timestamp",
    )
    return scoring.ServingTables(made(spark), images, users)


def requests(spark):
    return spark.createDataFrame(
        [
            ("hot", "viral", {"views_5min": 5}, 1767232800.25),
            ("b", None, None, 1767240000.0),
            ("", "viral", None, 1767240000.0),
            ("gone", "viral", None, 1767240000.0),
        ],
        "image_id string, trigger string, context map<string,int>, timestamp double",
    )


def score_stream(spark, predictor=None, tables=None):
    out = run_dir(spark, "test-scoring")
    tables = tables or scoring_tables(spark)
    text = messages.encode(requests(spark), F.lit("moderation_requests"), ["image_id", "trigger", "context", "timestamp"])
    sinks.publish(text, path=f"{out}/requests")
    stream = streams.requests_of(streams.file_messages(spark, f"{out}/requests"))
    handler = scoring.scoring_writer(f"{out}/t", lambda: tables, DEFAULT, predictor)
    batches.run_available(stream, handler, f"{out}/c")
    return batches.read_batches(spark, f"{out}/t").collect()


def test_scoring_stream(spark):
    rows = {r.target_id: r for r in score_stream(spark)}
    # No image id: dropped. Unknown image: not stored. No trigger: 'unknown'.
    assert set(rows) == {"hot", "b"}
    assert (rows["hot"].trigger_type, rows["b"].trigger_type) == ("viral", "unknown")
    assert all(r.inference_mode == "heuristic" and 0 <= r.risk_score <= 1 for r in rows.values())
    assert rows["hot"].created_at == datetime(2026, 1, 1, 2, 0, 0, 250000)
    t = scoring_tables(spark)
    asked = requests(spark).filter("image_id = 'hot'").select(
        F.lit("r").alias("request_id"), "image_id", "trigger", F.timestamp_micros((F.col("timestamp") * 1e6).cast("bigint")).alias("ts")
    )
    batch = serving.rule_predictor(DEFAULT.rules)(serving.request_features(asked, t.events, t.images, t.users, DEFAULT))
    assert batch.first().moderation_probability == rows["hot"].risk_score


def test_scoring_with_a_totals_table_reads_recent_events_only(spark):
    """Same windows from the last hour of events; totals are the stored ones."""
    t = scoring_tables(spark)
    t.totals = counters.lifetime_totals(t.events)
    full = {r.target_id: r.risk_score for r in score_stream(spark)}
    stored = {r.target_id: r.risk_score for r in score_stream(spark, tables=t)}
    assert set(stored) == {"hot", "b"}
    # Both images have flags before and after the request, so the scores agree.
    assert stored == full


def test_scoring_stream_with_another_predictor(spark):
    def constant(rows):
        return rows.withColumns(
            {
                "moderation_probability": F.lit(0.5),
                "inference_mode": F.lit("model"),
                "model_version": F.lit("m1"),
            }
        )

    rows = score_stream(spark, constant)
    assert {(r.risk_score, r.inference_mode, r.model_version) for r in rows} == {(0.5, "model", "m1")}


def test_metadata_last_write_wins(spark):
    out = run_dir(spark, "test-metadata")
    write = entities.metadata_writer(f"{out}/t")
    fields = "event_type string, image_id string, category string, caption string, created_at string, uploaded_at string, user_id string, arrival struct<arrived_at:timestamp,partition:int,offset:bigint>"

    def batch(rows):
        at = lambda n: (datetime(2026, 1, 1), 0, n)
        return spark.createDataFrame([("upload", *r[:-1], at(r[-1])) for r in rows], fields)

    write(batch([("i", "Egg", "abc", "2026-01-01T00:00:00", None, "u", 1), ("j", None, None, None, None, None, 2)]), 0)
    write(batch([("i", "Bread", "", None, "2026-01-02T00:00:00", "u", 3), ("i", "Soup", "x", None, None, "u", 2)]), 1)
    rows = {r.image_id: r for r in entities.latest_metadata(spark, f"{out}/t").collect()}
    assert (rows["i"].category, rows["i"].caption_length, rows["i"].uploaded_at) == ("Bread", "0", "2026-01-02T00:00:00")
    assert (rows["j"].category, rows["j"].user_id) == ("unknown", "")
    # No time in the message: the ingest time.
    assert rows["j"].uploaded_at is not None


def test_accounts_are_created_once(spark):
    out = run_dir(spark, "test-accounts")
    existing = spark.createDataFrame([("old", 1)], "username string, id bigint")
    write = entities.account_writer(f"{out}/t", existing)
    fields = "username string, id bigint, arrival bigint"
    write(spark.createDataFrame([("new", 10, 2), ("new", 11, 1), ("old", 12, 3)], fields), 0)
    write(spark.createDataFrame([("new", 13, 4), ("other", 14, 5)], fields), 1)
    write(spark.createDataFrame([("new", 13, 4), ("other", 14, 5)], fields), 1)
    schema = spark.createDataFrame([], fields).schema
    rows = entities.created_accounts(spark, f"{out}/t", schema).select("username", "id").collect()
    assert sorted(tuple(r) for r in rows) == [("new", 11), ("other", 14)]


def test_rows_and_messages_agree(spark):
    out = run_dir(spark, "test-dual")
    write = entities.dual_writer(f"{out}/t", messages.comment_messages, message_path=f"{out}/m")
    rows = spark.createDataFrame(
        [("i", "u", "nice", datetime(2026, 1, 1))], "image_id string, user_id string, content string, created_at timestamp"
    )
    batch = sinks.with_row_ids(rows)
    write(batch, 0)
    write(batch, 0)
    stored = batches.read_batches(spark, f"{out}/t").collect()
    told = messages.decode(spark.read.text(f"{out}/m").select("value")).collect()
    assert len(stored) == len(told) == 1
    assert told[0].comment_id == stored[0].id and told[0].created_at == "2026-01-01T00:00:00.000000+00:00"


def test_metadata_and_features_of_unknown_keys(spark):
    stored = spark.createDataFrame([("i1", 3)], "image_id string, n int")
    asked = spark.createDataFrame([("i1",), ("i2",), ("i1",)], "image_id string")
    assert sorted((r.image_id, r.n or 0) for r in batch_entities.lookup(stored, asked).collect()) == [("i1", 3), ("i2", 0)]
    assert [r.image_id for r in batch_entities.keys_like(stored, "i?").collect()] == ["i1"]
    assert batch_entities.keys_like(stored, "x*").count() == 0


def test_glob_patterns(spark):
    names = ["a1", "b1", "c1", "a*", "a?", "[x]", "a.b", "a\nb", "a\\b"]
    stored = spark.createDataFrame([(n,) for n in names], "image_id string")
    wanted = {
        "[ab]1": ["a1", "b1"],
        "[^a]1": ["b1", "c1"],
        "[b-c]1": ["b1", "c1"],
        "a\\*": ["a*"],
        "a\\?": ["a?"],
        "\\[x\\]": ["[x]"],
        "a.b": ["a.b"],
        "a\\\\b": ["a\\b"],
        "a?b": ["a.b", "a\nb", "a\\b"],
    }
    for pattern, keys in wanted.items():
        assert sorted(r.image_id for r in batch_entities.keys_like(stored, pattern).collect()) == sorted(keys), pattern


def test_redelivered_comments_count_once_in_windows_and_twice_in_totals(spark):
    at = datetime(2026, 1, 1)
    rows = [("i", n, "comment", at + timedelta(seconds=n)) for n in range(3)] + [("i", 9, "view", at + timedelta(seconds=9))]
    events = spark.createDataFrame(rows, EVENTS)
    source, out = run_dir(spark, "test-messages"), run_dir(spark, "test-alerts")
    job = AlertJob(spark, f"{out}/tables", PARAMS)
    comments = sent(events.filter("kind = 'comment'"))
    for part in (comments, comments.limit(2), sent(events.filter("kind = 'view'"))):
        sinks.land(part, source)
        batches.run_available(streams.events_of(streams.landed_messages(spark, source)), job.handle, f"{out}/checkpoint")
    assert max(r.comments_1min for r in job.counts.collect()) == 3
    assert [(r.total_comments, r.total_views) for r in job.totals(3).collect()] == [(5, 1)]


def test_windows_take_comments_without_id_by_topic(spark):
    made_ = spark.createDataFrame(
        [("comments", "view", "i", None), ("comments", "comment", "i", "c"), ("views", "view", None, None), ("x", "view", "i", None)],
        "topic string, event_type string, image_id string, comment_id string",
    ).withColumn("ts", F.lit(datetime(2026, 1, 1)))
    kept = messages.for_windows(made_, ("view", "comment", "flag"))
    names = {r.topic: r.kind for r in made_.select("topic", messages.kind_of_topic(F.col("topic")).alias("kind")).collect()}
    assert [r.kind for r in kept.collect()] == [names["comments"]] * 2
    assert messages.for_windows(made_.drop("topic"), ("view", "comment", "flag")).count() == 3


def test_images_of_a_batch_are_summed_once_and_milestones_cross_batches(spark, monkeypatch):
    job = AlertJob(spark, run_dir(spark, "test-once"), PARAMS)
    start = datetime(2026, 1, 1)
    read = []
    for step in ("_write_milestones", "_write_totals"):
        plain = getattr(AlertJob, step)

        def spy(self, counts, images, batch_id, buckets, plain=plain):
            read.append(images._jdf.queryExecution().optimizedPlan().toString())
            plain(self, counts, images, batch_id, buckets)

        monkeypatch.setattr(AlertJob, step, spy)
    goals = sorted(PARAMS.milestones)
    first = goals[1] - 1
    handled(job, spark, [("a", k, "view", start + timedelta(seconds=k)) for k in range(first)], 0)
    handled(job, spark, [("a", first + k, "view", start + timedelta(seconds=first + k)) for k in range(2)], 1)
    assert sorted(r.milestone_value for r in job.milestones.collect()) == goals[:2]
    assert len(read) == 4 and not any("Aggregate" in plan for plan in read)
