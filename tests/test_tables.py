"""Scans, sinks, snapshots and the working folder."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from crowdpulse import schemas, session
from crowdpulse.operators import files, messages, quality
from crowdpulse.sources import sinks, streams, tables


def some_users(spark, n=3):
    rows = [(str(i), f"u{i}", 1, None, "NL", 1990, False, datetime(2026, 1, 1)) for i in range(n)]
    return spark.createDataFrame(rows, schemas.USERS)


def test_raw_snapshot_is_replaced(spark, tmp_path):
    sinks.overwrite_snapshot(some_users(spark, 5), str(tmp_path), "users")
    sinks.overwrite_snapshot(some_users(spark, 2), str(tmp_path), "users")
    got = tables.raw_snapshot(spark, str(tmp_path), "users")
    assert got.count() == 2 and got.schema == schemas.USERS


def test_processed_is_replaced(spark, tmp_path):
    for n in (4, 1):
        sinks.overwrite_processed(spark.range(n), str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/processed/training_data.parquet").count() == 1


def test_append_table_creates_then_appends(spark):
    rows = spark.createDataFrame([("a", 1)], "image_id string, event_count bigint")
    name = "event_counts.view_windows"
    sinks.append_table(spark, rows.limit(0), name)
    assert not spark.catalog.tableExists(name)
    sinks.append_table(spark, rows, name)
    sinks.append_table(spark, rows, name)
    assert tables.catalog_table(spark, name).agg(F.sum("event_count")).first()[0] == 2


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "training")
    for snapshot, value in ((1, 10), (2, 20)):
        sinks.append_snapshot(spark.createDataFrame([("i", 0, value)], "image_id string, point int, v int"), path, snapshot)
    assert tables.current_snapshot(spark, path) == 2
    assert [r.v for r in tables.read_as_of(spark, path, 1).collect()] == [10]
    assert tables.read_as_of(spark, path, 2).count() == 2
    sinks.replace_snapshot(spark.createDataFrame([("j", 0, 5)], "image_id string, point int, v int"), path, 3)
    sinks.append_snapshot(spark.createDataFrame([("k", 0, 6)], "image_id string, point int, v int"), path, 4)
    assert [r.v for r in tables.read_as_of(spark, path, 3).collect()] == [5]
    assert sorted(r.v for r in tables.read_as_of(spark, path, 4).collect()) == [5, 6]
    assert sorted(r.v for r in tables.read_as_of(spark, path, 2).collect()) == [10, 20]
    newest = tables.newest_per_row(tables.read_as_of(spark, path, 2), ["image_id", "point"]).collect()
    assert [(r.v, r.snapshot_id) for r in newest] == [(20, 2)]


def test_as_of_read_prunes_later_snapshots(spark, tmp_path):
    path = str(tmp_path / "training")
    for snapshot in (1, 2):
        sinks.append_snapshot(spark.range(3), path, snapshot)
    plan = tables.read_as_of(spark, path, 1)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):]
    assert "snapshot_id" in filters[: filters.index("]")] and "PushedFilters: []" in plan


def test_appending_a_batch_twice_keeps_one(spark, tmp_path):
    for _ in range(2):
        sinks.append_batch(spark.range(3).withColumn("kind", F.lit("view")), str(tmp_path / "t"), 7, ["kind"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_image_files_are_listed_without_content(spark, tmp_path):
    for split, folder, name in (
        ("training", "class_00", "0_1.jpg"),
        ("training", "class_03", "3_9.PNG"),
        ("validation", "class_03", "3_1.Jpeg"),
        ("validation", "class_03", "notes.txt"),
    ):
        (tmp_path / split / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / split / folder / name).write_bytes(b"x")
    listed = files.image_files(tables.file_listing(spark, str(tmp_path)))
    rows = {(r.split, r["class"], r.category) for r in listed.collect()}
    assert rows == {
        ("training", "class_00", "Bread"),
        ("training", "class_03", "Egg"),
        ("validation", "class_03", "Egg"),
    }
    counts = {(r.split, r["class"]): r.files for r in files.files_per_class(listed).collect()}
    assert counts["TOTAL", "TOTAL"] == 3 and counts["training", "SUBTOTAL"] == 2


def test_profile_and_head(spark):
    rows = spark.createDataFrame([(2, None), (1, "x")], "id int, name string")
    profile = {r.column: r for r in quality.table_profile(rows).collect()}
    assert (profile["name"].type, profile["name"].row_count, profile["name"].present) == ("string", 2, 1)
    assert [r.id for r in quality.first_rows(rows, ["id"], 1).collect()] == [1]


def test_defaults_and_required(spark):
    rows = spark.createDataFrame([(None, None), ("user_upload", 3)], "source string, views int")
    filled = quality.with_defaults(rows, "images").collect()
    assert sorted((r.source, r.views) for r in filled) == [("user_upload", 0), ("user_upload", 3)]
    nulls = {r.column: r.nulls for r in quality.null_counts(rows, "images").collect()}
    assert nulls == {"source": 1}


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_foreign_keys(spark, kind):
    """Ids of one type and of two types; null references are no violation."""
    images = spark.createDataFrame([(1, 7), (2, 8), (3, None), (4, 7)], "id bigint, user_id bigint")
    flags = spark.createDataFrame([(5, 8, 1, None), (6, 9, 99, 12)], "id bigint, user_id bigint, image_id bigint, comment_id bigint")
    images = images.withColumn("id", F.col("id").cast(kind))
    users = spark.createDataFrame([(8,)], "id bigint")
    comments = spark.createDataFrame([(11,)], "id bigint")
    found = quality.foreign_key_violations(
        {"images": images, "flags": flags}, {"users": users, "images": images, "comments": comments}
    )
    assert {(r.constraint, r.missing_key, r.child_rows) for r in found.collect()} == {
        ("images.user_id", "7", 2),
        ("flags.user_id", "9", 1),
        ("flags.image_id", "99", 1),
        ("flags.comment_id", "12", 1),
    }


def test_topics_in_one_frame(spark):
    views = spark.createDataFrame([("view", "i")], "event_type string, image_id string")
    comments = spark.createDataFrame([("comment", "i", "c")], "event_type string, image_id string, comment_id string")
    rows = messages.unite(views, comments).collect()
    assert [r.comment_id for r in rows] == [None, "c"]


def test_requests_are_decoded(spark):
    text = '{"image_id": "i", "trigger": "viral", "context": {"views_5min": 100}, "timestamp": 1767225600.5}'
    row = streams.requests_of(spark.createDataFrame([(text,)], "value string")).first()
    assert (row.image_id, row.context, row.ts) == ("i", {"views_5min": 100}, datetime(2026, 1, 1, 0, 0, 0, 500000))


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.run_dir(spark, "x") != session.run_dir(spark, "x")


def test_decode_of_every_kind(spark):
    when = datetime(2026, 1, 1, 10, 7, 3, 123456)
    views = spark.createDataFrame([("i", when)], "image_id string, ts timestamp")
    flags = spark.createDataFrame(
        [("f", "u", None, "c", "spam", when), ("g", "u", None, None, "spam", when)],
        "id string, user_id string, image_id string, comment_id string, reason string, created_at timestamp",
    )
    uploads = spark.createDataFrame(
        [("i", "u", "Soup", 'say "hi"', when, "http://s/i")],
        "id string, user_id string, category string, caption string, created_at timestamp, s3_url string",
    )
    sent = messages.unite(messages.view_messages(views), messages.flag_messages(flags), messages.upload_messages(uploads))
    back = {r.event_type: r for r in messages.with_event_time(messages.decode(sent)).collect()}
    # A flag without any target is refused.
    assert set(back) == {"view", "flag", "upload"} and sent.count() == 3
    assert all(r.ts == when for r in back.values())
    assert back["upload"].caption == 'say "hi"' and back["flag"].image_id is None


def test_append_table_goes_by_name(spark):
    name = "by_name"
    sinks.append_table(spark, spark.createDataFrame([("a", 1, 2)], "image_id string, views int, comments int"), name)
    sinks.append_table(spark, spark.createDataFrame([("b", 7, 5)], "image_id string, comments int, views int"), name)
    assert {r.image_id: (r.views, r.comments) for r in spark.table(name).collect()} == {"a": (1, 2), "b": (5, 7)}
    with pytest.raises(ValueError):
        sinks.append_table(spark, spark.createDataFrame([("c", 1)], "image_id string, views int"), name)


def test_a_snapshot_without_what_was_withdrawn(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "image_id string, v int")
    sinks.append_snapshot(rows, path, 1)
    sinks.append_snapshot(rows.filter("image_id = 'a'"), path, 2)
    assert [r.image_id for r in tables.rows_of(spark, path, 2).collect()] == ["a"]
    assert tables.rows_of(spark, path, 1).count() == 2 and tables.read_as_of(spark, path, 2).count() == 3
    assert tables.base_of(spark, str(tmp_path / "none")) == 0
