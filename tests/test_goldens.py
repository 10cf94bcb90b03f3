"""Results derived by hand, with the real parameters."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdpulse.functions import content, risk, times
from crowdpulse.operators import alerts, counters, files, governance, messages, quality, serving, training
from crowdpulse.params import DEFAULT, FEATURE_NAMES

UPLOAD = datetime(2026, 1, 1, 10, 2)


def at(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    "text, bucket",
    [
        ("2026-01-01T10:07:03.123456", "2026-01-01 10:05:00"),
        ("2026-01-01T10:07:03Z", "2026-01-01 10:05:00"),
        ("2026-01-01T10:07:03+00:00", "2026-01-01 10:05:00"),
        ("2026-01-01T10:07:03+05:30", "2026-01-01 04:35:00"),
        ("2026-01-01T10:07:03-05:00", "2026-01-01 15:05:00"),
        ("2026-01-01T10:05:00Z", "2026-01-01 10:05:00"),
        ("yesterday", None),
        (None, None),
    ],
)
def test_tumbling_bucket(spark, text, bucket):
    parsed = times.parse_iso(F.lit(text).cast("string"))
    row = spark.range(1).select(times.floor_to(parsed, 300).cast("string").alias("b")).first()
    assert row.b == bucket


def test_missing_time_is_skipped_in_batch_and_stamped_in_stream(spark):
    sent = spark.createDataFrame([('{"event_type":"view","image_id":"1"}',)], "value string")
    decoded = messages.decode(sent)
    assert messages.valid(messages.with_event_time(decoded)).count() == 0
    stamped = messages.valid(messages.with_event_time(decoded, at("2026-01-01 00:00:00")))
    assert [r.ts for r in stamped.collect()] == [datetime(2026, 1, 1)]


def test_bad_messages_never_fail_the_query(spark):
    lines = [
        "not json",
        "{}",
        '{"event_type":"view","image_id":"","viewed_at":"2026-01-01T00:00:00"}',
        '{"event_type":"comment","image_id":"1","created_at":"2026-01-01T00:00:00Z"}',
        '{"event_type":"view","image_id":"1","viewed_at":"soon"}',
        '{"event_type":"view","image_id":"1","viewed_at":"2026-01-01T00:00:00"}',
    ]
    timed = messages.with_event_time(messages.decode(spark.createDataFrame([(x,) for x in lines], "value string")))
    assert messages.valid(timed).count() == 1
    reasons = sorted(r.reason for r in messages.rejected(timed).collect())
    assert reasons == ["bad_time", "missing_comment", "missing_image", "unknown_type", "unknown_type"]


def windows(spark, rows):
    day = datetime(2026, 1, 1)
    out = []
    for kind, hour, minute, n in rows:
        start = day + timedelta(hours=hour, minutes=minute)
        out.append((kind, "i", start, start + timedelta(minutes=5), n))
    return spark.createDataFrame(
        out, "kind string, image_id string, window_start timestamp, window_end timestamp, event_count bigint"
    )


def image(spark, upload=UPLOAD):
    return spark.createDataFrame([("i", upload)], "id string, created_at timestamp")


def test_containment_features(spark):
    w = windows(
        spark,
        [("view", 10, 0, 3), ("view", 10, 5, 4), ("view", 10, 25, 2), ("view", 10, 30, 7), ("flag", 10, 5, 1)],
    )
    rows = {r.decision_point_minutes: r for r in training.with_ratios(training.window_features(image(spark), w, DEFAULT)).collect()}

    def seen(m):
        r = rows[m]
        return (r.views_5min, r.views_1hr, r.flags_5min, r.flags_1hr, r.total_flags, r.view_velocity_per_min)

    assert seen(0) == (0, 0, 0, 0, 0, 0.0)
    assert seen(5) == (0, 0, 0, 0, 0, 0.0)
    assert seen(30) == (2, 6, 0, 1, 1, 0.4)


def test_aligned_upload_counts_its_first_window(spark):
    w = windows(spark, [("view", 10, 0, 3)])
    rows = training.window_features(image(spark, datetime(2026, 1, 1, 10)), w, DEFAULT).collect()
    assert {r.decision_point_minutes: r.views_5min for r in rows} == {0: 0, 5: 3, 30: 0}


def test_partial_windows_are_summed(spark):
    w = windows(spark, [("view", 10, 5, 2), ("view", 10, 5, 3)])
    assert counters.merge_partials(w).first().event_count == 5
    rows = training.window_features(image(spark), w, DEFAULT).collect()
    assert {r.decision_point_minutes: r.views_1hr for r in rows}[30] == 5


USERS = [
    ("adult", False, 1990),
    ("test", True, 1990),
    ("minor", False, 2009),
    ("just18", False, 2008),
    ("unknown", None, None),
]


def users(spark):
    return spark.createDataFrame(
        [(i, t, y, datetime(2025, 1, 1)) for i, t, y in USERS],
        "id string, is_test_account boolean, year_of_birth int, created_at timestamp",
    )


@pytest.mark.parametrize(
    "actor, offset, comment_only, label",
    [
        ("adult", timedelta(hours=24), False, 1),
        ("adult", timedelta(hours=24, microseconds=1), False, 0),
        ("adult", timedelta(0), False, 1),
        ("adult", timedelta(microseconds=-1), False, 0),
        ("test", timedelta(hours=1), False, 0),
        ("minor", timedelta(hours=1), False, 0),
        ("just18", timedelta(hours=1), False, 1),
        ("unknown", timedelta(hours=1), False, 1),
        ("nobody", timedelta(hours=1), False, 1),
        ("adult", timedelta(hours=1), True, 0),
    ],
)
def test_label(spark, actor, offset, comment_only, label):
    flags = spark.createDataFrame(
        [("f", actor, None if comment_only else "i", "c", UPLOAD + offset)],
        "id string, user_id string, image_id string, comment_id string, created_at timestamp",
    )
    ok = governance.eligible_actions(flags, users(spark))
    assert training.flag_labels(image(spark), ok, DEFAULT).first()[training.LABEL] == label


def test_eligible_uploaders(spark):
    rows = [(u, u, "c", "Bread", datetime(2026, 5, 1)) for u, _, _ in USERS]
    images = spark.createDataFrame(rows, "id string, user_id string, caption string, category string, created_at timestamp")
    # No deleted_at column: nothing counts as deleted.
    kept = governance.eligible_images(images, users(spark))
    assert sorted(r.id for r in kept.collect()) == ["adult", "just18", "unknown"]


def test_birth_years_in_text(spark):
    people = spark.createDataFrame(
        [("a", None, "n/a"), ("b", None, "2009"), ("c", None, "1990.0"), ("d", None, None)],
        "id string, is_test_account boolean, year_of_birth string",
    )
    done = spark.createDataFrame(
        [(i, datetime(2026, 1, 1)) for i in "abcd"], "user_id string, created_at timestamp"
    )
    kept = governance.eligible_actions(done, people)
    assert sorted(r.user_id for r in kept.collect()) == ["a", "c", "d"]


def test_no_eligible_image_gives_an_empty_training_set(spark):
    images = governance.eligible_images(
        spark.createDataFrame([], "id string, user_id string, caption string, category string, created_at timestamp"),
        users(spark),
    )
    flags = spark.createDataFrame([], "image_id string, created_at timestamp")
    rows = training.training_rows(images, windows(spark, [("view", 10, 0, 1)]), flags, DEFAULT)
    assert rows.count() == 0 and len(rows.columns) == 22


def test_training_row(spark):
    images = spark.createDataFrame(
        [
            ("i", "adult", "héllo😀", None, UPLOAD, datetime(2025, 12, 31, 10)),
            ("j", "adult", None, "Soup", UPLOAD + timedelta(minutes=5), datetime(2025, 12, 31, 10)),
        ],
        "id string, user_id string, caption string, category string, created_at timestamp, user_created_at timestamp",
    )
    flags = spark.createDataFrame([("i", UPLOAD)], "image_id string, created_at timestamp")
    w = windows(spark, [("view", 10, 5, 4), ("comment", 10, 25, 3)])
    rows = {
        (r.image_id, r.decision_point_minutes): r for r in training.training_rows(images, w, flags, DEFAULT).collect()
    }
    r = rows["i", 30]
    assert (r.time_since_upload_seconds, r.hour_of_day, r.day_of_week, r.is_weekend) == (1800, 10, 3, 0)
    assert (r.views_1hr, r.comments_5min, r.comment_to_view_ratio, r.recent_engagement_score) == (4, 3, 0.75, 15.0)
    assert (r.caption_length, r.has_caption, r.category, r.user_age_days) == (6, 1, "Unknown", 1)
    assert r.label_needs_moderation_24h == 1 and rows["j", 0].label_needs_moderation_24h == 0
    assert [rows["i", m].user_image_count for m in (0, 5, 30)] == [1, 2, 2]
    assert (rows["j", 0].caption_length, rows["j", 0].has_caption) == (0, 0)


def test_no_feature_sees_events_after_its_cutoff(spark):
    early = windows(spark, [("view", 10, 5, 4), ("comment", 10, 10, 2), ("flag", 10, 15, 1)])
    late = early.unionByName(windows(spark, [("view", 10, 30, 9), ("comment", 11, 0, 9), ("flag", 12, 0, 9)]))
    a = training.window_features(image(spark), early, DEFAULT).collect()
    b = training.window_features(image(spark), late, DEFAULT).collect()
    assert sorted(a) == sorted(b)


def burst(spark):
    kinds = ["view"] * 110 + ["comment"] * 8 + ["flag"] * 2
    rows = [("i", n, k, datetime(2026, 1, 1) + timedelta(seconds=n)) for n, k in enumerate(kinds, 1)]
    return spark.createDataFrame(rows, "image_id string, event_id bigint, kind string, ts timestamp")


def test_viral_burst(spark):
    counts = alerts.activity_counts(burst(spark), DEFAULT)
    found = {r.alert_type: r for r in alerts.first_alerts(alerts.crossings(counts, DEFAULT)).collect()}
    assert set(found) == {"viral", "popular"}
    assert (found["popular"].event_id, found["viral"].event_id) == (50, 100)
    reached = {r.milestone_value: r.event_id for r in alerts.milestones(counts, DEFAULT).collect()}
    assert reached == {10: 10, 100: 100}
    asked = alerts.scoring_requests(alerts.first_alerts(alerts.crossings(counts, DEFAULT))).collect()
    assert [(r.trigger, r.context) for r in asked] == [("viral", {"views_5min": 100})]


def scored(spark, **features):
    base = {n: 0.0 for n in FEATURE_NAMES} | {k: float(v) for k, v in features.items()}
    rows = spark.createDataFrame([tuple(base.values())], ", ".join(f"{n} double" for n in base))
    rows = training.with_ratios(rows)
    return serving.rule_predictor(DEFAULT.rules)(rows).first()


@pytest.mark.parametrize(
    "features, score, reasons",
    [
        ({}, 0.3, ["Normal activity"]),
        ({"views_5min": 100, "views_1hr": 100}, 0.3, ["Normal activity"]),
        (
            {"total_flags": 2, "views_5min": 110, "views_1hr": 110, "comments_5min": 8, "comments_1hr": 8},
            1.0,
            ["flagged 2 time", "22.0 views/min", "score: 150"],
        ),
        (
            {"comments_5min": 11, "comments_1hr": 60, "views_1hr": 10, "user_image_count": 11},
            1.0,
            ["(11 comments", "ratio (6.00)", "60 comments but only 10 views", "user (11 images)"],
        ),
        ({"user_image_count": 11}, 0.2, ["Established user"]),
        ({"comments_1hr": 5, "views_1hr": 10}, 0.3, ["No significant risk signals"]),
    ],
)
def test_rule_score(spark, features, score, reasons):
    row = scored(spark, **features)
    assert row.moderation_probability == pytest.approx(score, abs=1e-9)
    assert len(row.reasoning) == len(reasons)
    assert all(part in text for part, text in zip(reasons, row.reasoning))


def test_reason_numbers_round_half_to_even(spark):
    row = scored(spark, comments_1hr=5, views_1hr=8)
    assert "(0.62)" in row.reasoning[0]


def test_factors_are_ranked_by_size(spark):
    row = scored(spark, total_flags=1, user_image_count=11)
    ranked = spark.createDataFrame([(row.risk_factors,)], "m map<string,double>").select(
        risk.ranked_factors(F.col("m")).alias("r")
    ).first().r
    assert [e.factor for e in ranked] == ["flags_reported", "base", "established_user"]


def test_vector_replaces_nan_and_infinity(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1.5, None]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(risk.vector_element(F.col("x")).alias("x"))
    assert [r.x for r in df.collect()] == [0.0, 1e6, -1e6, 1.5, 0.0]


def test_vector_of_wrong_length_fails(spark):
    df = spark.range(1).select(risk.vector_map(F.array(F.lit(1.0))).alias("m"))
    with pytest.raises(Exception, match="29 elements"):
        df.collect()


@pytest.mark.parametrize("name, hot", [(" Dairy product ", ["category_Dairy"]), ("Unknown", []), (None, [])])
def test_one_hot(spark, name, hot):
    columns = content.one_hot(F.lit(name).cast("string"))
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    assert [n for n in columns if row[n] == 1] == hot


def test_checks_pass_on_null(spark):
    rows = spark.createDataFrame(
        [(1, 1, None), (2, 1, 1899), (3, 0, 2000), (4, None, 2027)],
        "id int, tos_version_accepted int, year_of_birth int",
    )
    broken = quality.check_violations(rows, "users", 2026).collect()
    assert sorted((r.row_key, r.rule) for r in broken) == [
        ("2", "year_of_birth"),
        ("3", "tos_version"),
        ("4", "year_of_birth"),
    ]
    flags = spark.createDataFrame([(1, None, None, "pending")], "id int, image_id string, comment_id string, review_status string")
    assert [r.rule for r in quality.check_violations(flags, "flags", 2026).collect()] == ["target"]
    decided = spark.createDataFrame([(1, "image", 1.2)], "id int, target_type string, risk_score double")
    assert [r.rule for r in quality.check_violations(decided, "moderation", 2026).collect()] == ["risk_score"]


def test_right_source_wins_even_with_null(spark):
    left = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, x int, y int")
    right = spark.createDataFrame([("a", None, 7)], "k string, x int, z int")
    rows = {r.k: r.asDict() for r in serving.prefer_right(left, right, "k").collect()}
    assert rows["a"] == {"k": "a", "x": None, "y": 1, "z": 7}
    assert rows["b"] == {"k": "b", "x": 2, "y": 2, "z": None}


def test_file_categories(spark):
    names = spark.createDataFrame(
        [("training", "0_1.jpg"), ("training", "10_2.JPG"), ("validation", "11_3.png"), ("validation", "x.jpg"), ("evaluation", "3_4.txt")],
        "split string, name string",
    )
    placed = files.image_files(files.sorted_into_classes(names))
    rows = {r.name: (r["class"], r.category) for r in placed.collect()}
    assert rows["0_1.jpg"] == ("class_00", "Bread")
    assert rows["10_2.JPG"] == ("class_10", "Vegetable/Fruit")
    assert rows["11_3.png"] == ("class_11", "Unknown")
    assert rows["x.jpg"][1] == "Unknown"
    assert "3_4.txt" not in rows


def test_views_of_known_and_unknown_images(spark):
    views = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "image_id string, n int")
    images = spark.createDataFrame([("a",), ("c",)], "id string")
    assert sorted(r.n for r in counters.views_of_known_images(views, images).collect()) == [1, 2]
    assert sorted(r.n for r in counters.views_of_unknown_images(views, images).collect()) == [3, 4]
    rows = counters.views_by_image(views, images).collect()
    assert {(r.image_id, r.views, r.known) for r in rows} == {("a", 2, True), ("b", 1, False), (None, 1, False)}


def test_window_counts_add_up_to_the_events(spark):
    counts = counters.tumbling_counts(burst(spark))
    assert counts.agg(F.sum("event_count")).first()[0] == 120
