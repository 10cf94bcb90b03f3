"""The jobs in their order over one folder: a burst on one image ends as one stored decision."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdpulse import schemas
from crowdpulse.operators import learning, messages
from crowdpulse.plans import jobs
from crowdpulse.sources import sinks, streams, tables
from crowdpulse.streaming import batches, entities, scoring

UPLOAD = datetime(2026, 1, 1, 10, 2)
BURST = UPLOAD + timedelta(minutes=3)


def raw_tables(spark):
    users = [(f"u{i}", f"name{i}", 1, None, "NL", 1990, i == 9, UPLOAD - timedelta(days=40)) for i in range(10)]
    images = [
        (f"i{i}", f"u{i}", "url", "user_upload", "text", "Soup", UPLOAD, None if i != 8 else UPLOAD, 0)
        for i in range(10)
    ]
    flags = [(f"f{i}", "u1", f"i{i}", None, "spam", None, "pending", None, BURST) for i in range(0, 10, 2)]
    return {
        "users": spark.createDataFrame(users, schemas.USERS),
        "images": spark.createDataFrame(images, schemas.IMAGES),
        "comments": spark.createDataFrame([], schemas.COMMENTS),
        "flags": spark.createDataFrame(flags, schemas.FLAGS),
    }


def burst(spark):
    kinds = ["view"] * 110 + ["comment"] * 8 + ["flag"] * 2
    rows = [("i0", n, k, BURST + timedelta(seconds=n)) for n, k in enumerate(kinds, 1)]
    return spark.createDataFrame(rows, "image_id string, event_id bigint, kind string, ts timestamp")


def as_messages(events):
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    shaped = events.select(
        F.struct(F.timestamp_micros("event_id").alias("arrived_at"), F.lit(0).alias("partition"), F.col("event_id").cast("long").alias("offset")).alias("arrival"),
        F.col("kind").alias("event_type"),
        "image_id",
        F.when(F.col("kind") == "comment", F.col("event_id").cast("string")).alias("comment_id"),
        F.when(F.col("kind") == "view", clock).alias("viewed_at"),
        F.when(F.col("kind") != "view", clock).alias("created_at"),
    )
    return messages.encode(shaped, messages.topic_of(F.col("event_type")), shaped.columns[1:], ("arrival",))


def upload_message(spark):
    shaped = spark.range(1).select(
        F.struct(F.timestamp_micros(F.lit(999)).alias("arrived_at"), F.lit(0).alias("partition"), F.lit(999).cast("long").alias("offset")).alias("arrival"),
        F.lit("upload").alias("event_type"),
        F.lit("i0").alias("image_id"),
        F.lit("Soup").alias("category"),
        F.lit("2026-01-01T10:02:00").alias("created_at"),
    )
    return messages.encode(shaped, messages.topic_of(F.col("event_type")), shaped.columns[1:], ("arrival",))


def relation(spark, path):
    """A table by scan and append, as a database gives it."""
    spark.createDataFrame([], schemas.MODERATION).drop("id").write.parquet(path)
    return jobs.RelationalTable(
        lambda: spark.read.parquet(path), lambda rows: rows.write.mode("append").parquet(path)
    )


def test_decisions_are_stored_once(spark, tmp_path):
    at = [UPLOAD + timedelta(seconds=k) for k in range(6)]
    table = relation(spark, str(tmp_path / "t"))
    names = ["inference_request_id", "created_at", "risk_score"]
    kept = jobs.RelationalTable(table.read, lambda rows: table.append(table.read().limit(0).unionByName(rows, allowMissingColumns=True)))
    put = lambda rows: sinks.append_absent(rows, kept.read(), kept.append, "inference_request_id", "created_at")
    first = spark.createDataFrame([(f"0-{k}", at[k], 0.5) for k in range(3)], names)
    more = spark.createDataFrame([(f"0-{k}", at[k], 0.5) for k in range(1, 6)], names)
    for rows in (first, first, more, more.limit(0)):
        put(rows)
    assert sorted(r.inference_request_id for r in table.read().collect()) == [f"0-{k}" for k in range(6)]
    with pytest.raises(ValueError):
        put(spark.createDataFrame([(None, at[0], 0.5)], "inference_request_id string, created_at timestamp, risk_score double"))


def test_equal_requests_stay_apart(spark):
    asked = '{"image_id": "i0", "trigger": "viral", "context": null, "timestamp": 1767261780.0}'
    came = [(asked, (BURST, 0, k)) for k in (1, 2)] + [(asked, (BURST, 1, 1))]
    landed = spark.createDataFrame(came, "value string, arrival struct<arrived_at timestamp, partition int, offset long>")
    named = streams.requests_of(landed).withColumn("n", scoring.request_id(streams.requests_of(landed)))
    assert sorted(r.n for r in named.collect()) == ["0-1", "0-2", "1-1"]


def test_jobs_end_to_end(spark, tmp_path):
    root = str(tmp_path / "root")
    raw = raw_tables(spark)
    jobs.extract_tables(raw.__getitem__, root)

    topics = f"{root}/topics"
    sinks.land(as_messages(burst(spark)), topics)
    jobs.aggregate_events(streams.landed_messages(spark, topics), root)
    # A second run finds nothing new.
    jobs.aggregate_events(streams.landed_messages(spark, topics), root)
    assert batches.read_batches(spark, f"{root}/windows").agg(F.sum("event_count")).first()[0] == 120

    for snapshot in (1, 2):
        jobs.build_training_set(spark, root, snapshot)
    # 10 images less the deleted one and the one of a test account, 3 decision points, two runs.
    assert spark.read.parquet(f"{root}/training").count() == 2 * 8 * 3
    at_30 = spark.read.parquet(f"{root}/processed/training_data.parquet").filter("decision_point_minutes = 30")
    # The burst starts at 10:05, so its windows lie inside [10:02, 10:32].
    assert {r.image_id: (r.views_1hr, r.total_flags) for r in at_30.collect()}["i0"] == (110, 2)
    assert sum(r.label_needs_moderation_24h for r in at_30.collect()) == 4

    profile, head = jobs.verify(spark, f"{root}/training", ["image_id", "decision_point_minutes"])
    assert {r.row_count for r in profile.collect()} == {48} and head.count() == 5

    gone = spark.createDataFrame([("i2",)], "image_id string")
    jobs.remove_excluded(spark, root, gone, 3)
    # The rows of the last rebuild only, once each.
    assert tables.read_as_of(spark, f"{root}/training", 3).count() == 7 * 3
    assert tables.read_as_of(spark, f"{root}/training", 2).count() == 48
    jobs.build_training_set(spark, root, 4)
    assert tables.read_as_of(spark, f"{root}/training", 4).count() == 7 * 3 + 8 * 3

    model = jobs.train(spark, root, 2)
    assert spark.read.json(f"{root}/models/2/metadata").first().rows_seen == 24

    sinks.land(upload_message(spark), topics)
    job, _ = jobs.watch_activity(spark, streams.events_of(streams.landed_messages(spark, topics)), root)
    assert sorted((r.alert_type, r.value) for r in job.alerts.collect()) == [("popular", 50), ("viral", 100)]
    assert sorted(r.milestone_value for r in job.milestones.collect()) == [10, 100]

    # The same job keeps the uploads' metadata and sends the requests.
    assert [(r.image_id, r.category) for r in entities.latest_metadata(spark, f"{root}/metadata").collect()] == [("i0", "Soup")]
    requests = streams.requests_of(streams.file_messages(spark, f"{root}/requests"))
    moderation = relation(spark, str(tmp_path / "moderation"))
    jobs.score_requests(spark, requests, root, lambda: burst(spark), moderation=moderation)
    row = jobs.decisions(spark, root).first()
    # 100 views in 5 minutes and no flag yet: velocity 20 and engagement 100 are at, not over, the limits.
    assert (row.trigger_type, row.inference_mode, row.decisions, row.avg_risk_score) == ("viral", "heuristic", 1, 0.3)
    stored = moderation.read().collect()
    assert [(r.target_id, r.trigger_type, r.risk_score) for r in stored] == [("i0", "viral", 0.3)]

    predict = learning.model_predictor(model, "2")
    again = f"{root}/with-model"
    jobs.extract_tables(raw.__getitem__, again)
    requests = streams.requests_of(streams.file_messages(spark, f"{root}/requests"))
    jobs.score_requests(spark, requests, again, lambda: burst(spark), predictor=predict)
    assert jobs.decisions(spark, again).first().inference_mode == "model"
