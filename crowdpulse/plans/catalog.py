"""Named queries over the test tables: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdpulse.functions import content, risk, times
from crowdpulse.operators import (
    alerts,
    counters,
    entities,
    files,
    governance,
    learning,
    memory,
    messages,
    quality,
    serving,
    training,
)
from crowdpulse.params import FEATURE_NAMES, LABEL, SCALED
from crowdpulse.plans import jobs, risk_at_upload, streams
from crowdpulse.session import prepare, run_dir
from crowdpulse.sources import domain, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The day an earlier run of a job took place, where a query needs one.
MIDDLE = "2024-01-16"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _iso(name: str):
    return times.iso(F.col(name)).alias(name)


def _long(name: str):
    return F.col(name).cast("bigint").alias(name)


# --- messages ---------------------------------------------------------------


def _raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, some of them broken: unknown types, missing ids, odd times."""
    rows = domain.activity(spark, sf_dir)
    event_id = F.col("event_id")
    kind = F.when(F.col("kind") == "comment_flag", "flag").otherwise(F.col("kind"))
    clock = times.iso(F.col("ts"))
    text = (
        F.when(event_id % 10 == 0, F.concat(clock, F.lit("Z")))
        .when(event_id % 10 == 1, F.concat(times.iso(F.col("ts") + F.expr("INTERVAL 330 MINUTES")), F.lit("+05:30")))
        .when(event_id % 10 == 2, F.concat(times.iso(F.col("ts") - F.expr("INTERVAL 5 HOURS")), F.lit("-05:00")))
        .when(event_id % 10 == 3, F.lit("yesterday"))
        .when(event_id % 10 != 4, clock)
    )
    is_view = F.col("kind") == "view"
    shaped = rows.select(
        "event_id",
        F.when(event_id % 17 == 0, F.lit("like")).otherwise(kind).alias("event_type"),
        F.when(F.col("kind") != "comment_flag", F.col("image_id").cast("string")).alias("image_id"),
        F.when((F.col("kind") == "comment") & (event_id % 19 != 0), event_id.cast("string")).alias("comment_id"),
        F.when(is_view, text).alias("viewed_at"),
        F.when(~is_view, text).alias("created_at"),
    )
    return messages.encode(shaped, messages.topic_of(F.col("event_type")), shaped.columns[1:], ("event_id",))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.with_event_time(messages.decode(_raw_messages(spark, sf_dir)))


@query
def event_routing_counts(spark, sf_dir):
    """Messages per topic and kind after routing: one pass, since every valid message has one route."""
    return messages.valid(_decoded(spark, sf_dir)).groupBy("topic", "event_type").agg(F.count("*").alias("events"))


@query
def event_parse_stats(spark, sf_dir):
    return messages.read_counters(_decoded(spark, sf_dir))


@query
def event_quarantine(spark, sf_dir):
    return messages.rejected(_decoded(spark, sf_dir)).groupBy("event_type", "reason").agg(
        F.count("*").alias("events")
    )


@query
def iso_timestamp_parse(spark, sf_dir):
    ts = F.col("ts")
    return _decoded(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.unix_micros(ts).alias("epoch_us"),
        _micros(times.floor_to(ts, 300), "bucket_us"),
        times.iso(times.plus_seconds(times.floor_to(ts, 300), 300)).alias("bucket_end"),
        F.year(ts).cast("bigint").alias("year"),
    )


def _micros(column, name):
    return F.unix_micros(column).alias(name)


@query
def event_json_roundtrip(spark, sf_dir):
    """Message columns survive encoding and decoding."""
    back = messages.decode(_raw_messages(spark, sf_dir))
    return back.select(F.col("event_id").alias("seq"), "topic", "event_type", "image_id", "comment_id", "viewed_at", "created_at")


@query
def event_projections(spark, sf_dir):
    """The messages the four tables are published as."""
    comments = domain.comments(spark, sf_dir).withColumn("content", F.lit("nice"))
    images = domain.images(spark, sf_dir).withColumn("s3_url", content.object_url("http://store", "images", F.col("id").cast("string")))
    flags = domain.flags(spark, sf_dir).withColumn("reason", F.lit("spam"))
    return messages.unite(
        messages.view_messages(domain.views(spark, sf_dir)),
        messages.comment_messages(comments),
        messages.upload_messages(images),
        messages.flag_messages(flags),
    )


@query
def topic_rollup(spark, sf_dir):
    known = _raw_messages(spark, sf_dir).filter(F.col("topic").isNotNull())
    return messages.topic_rollup(known)


@query
def comment_dedup(spark, sf_dir):
    """Comments of which every fifth is delivered twice."""
    comments = domain.comments(spark, sf_dir).select(
        F.col("id").alias("comment_id"), "image_id", F.col("created_at").alias("ts")
    )
    twice = comments.withColumn("copy", F.explode(F.when(F.col("comment_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return messages.drop_redelivered_comments(twice).groupBy("image_id").agg(F.count("*").alias("comments"))


# --- counts -----------------------------------------------------------------


@query
def tumbling_counts_5min(spark, sf_dir):
    return counters.tumbling_counts(domain.signals(spark, sf_dir)).select(
        "kind", "image_id", _iso("window_start"), _iso("window_end"), "event_count"
    )


@query
def tumbling_partial_final(spark, sf_dir):
    """Two runs that cut the events in the middle of windows, summed by the reader."""
    events = domain.signals(spark, sf_dir)
    runs = [
        counters.tumbling_counts(events.filter(F.col("event_id") % 2 == run), SCALED.tumbling_seconds)
        for run in (0, 1)
    ]
    return counters.merge_partials(runs[0].unionByName(runs[1])).select(
        "kind", "image_id", _iso("window_start"), _iso("window_end"), "event_count"
    )


@query
def windows_per_kind(spark, sf_dir):
    return counters.windows_per_kind(counters.tumbling_counts(domain.signals(spark, sf_dir)))


@query
def lifetime_totals(spark, sf_dir):
    return counters.lifetime_totals(domain.signals(spark, sf_dir))


@query
def fixed_windows_from_first(spark, sf_dir):
    """Counters of two days per user that start at an event and again at the first one after their end."""
    found = counters.windows_from_first(_user_events(spark, sf_dir), 2 * 86_400, key="user_id")
    return found.select("user_id", _iso("window_start"), "event_count")


@query
def view_counter_update(spark, sf_dir):
    images = domain.images(spark, sf_dir).select("id", (F.col("id") % 3).alias("views"))
    return counters.apply_view_counts(images, domain.views(spark, sf_dir))


@query
def images_per_user(spark, sf_dir):
    return domain.images(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("images"))


@query
def views_on_known_images(spark, sf_dir):
    """Views per image, with the mark whether the image exists undeleted."""
    known = domain.images(spark, sf_dir).filter(F.col("deleted_at").isNull())
    return counters.views_by_image(domain.views(spark, sf_dir), known)


@query
def activity_score(spark, sf_dir):
    return counters.activity_score(
        domain.images(spark, sf_dir),
        domain.views(spark, sf_dir),
        domain.comments(spark, sf_dir),
        domain.flags(spark, sf_dir),
    )


@query
def flag_targets(spark, sf_dir):
    return counters.flag_targets(domain.flags(spark, sf_dir), domain.comments(spark, sf_dir)).select(
        "id", "image_id", "comment_id", "target_image_id"
    )


# --- rolling counts and alerts ----------------------------------------------


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity keyed by user, the dense key of the test tables."""
    return domain.events(spark, sf_dir, counters.KINDS).select("event_id", "user_id", "kind", "ts")


def _user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.activity_counts(_user_events(spark, sf_dir), SCALED, key="user_id")


@query
def rolling_counts(spark, sf_dir):
    """Own-kind counts at every event."""
    return alerts.own_counts(_user_events(spark, sf_dir), SCALED, key="user_id").select(
        "event_id", "user_id", "kind", "count_1min", "count_5min", "count_1hr"
    )


@query
def rolling_cross_counts(spark, sf_dir):
    """Views seen from comments."""
    return (
        _user_counts(spark, sf_dir)
        .filter(F.col("kind") == "comment")
        .select("event_id", "views_1min", "views_5min", "views_1hr", "views_total")
    )


@query
def running_totals_sampled(spark, sf_dir):
    totals = alerts.view_totals(_user_events(spark, sf_dir), key="user_id")
    return counters.counted_every(totals, "views_total", 10, SCALED.milestones).select(
        "event_id", "user_id", "views_total"
    )


def _user_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = alerts.alert_counts(_user_events(spark, sf_dir), SCALED, key="user_id")
    return alerts.first_alerts(alerts.crossings(counts, SCALED, key="user_id"), key="user_id")


@query
def alerts_first_crossing(spark, sf_dir):
    return _user_alerts(spark, sf_dir).select("user_id", "alert_type", "event_id", _iso("ts"), "metric", "value")


@query
def alerts_with_memory(spark, sf_dir):
    """Alerts that repeat once a memory of 1, 10 or 1000 users has forgotten them."""
    counts = alerts.alert_counts(_user_events(spark, sf_dir), SCALED, key="user_id")
    found = sinks.staged(alerts.crossings(counts, SCALED, key="user_id"), run_dir(spark, "crossings"))
    sizes = [
        memory.alerts_with_memory(found, size, key="user_id").withColumn("memory_size", F.lit(size).cast("bigint"))
        for size in (1, 10, SCALED.alert_tracking)
    ]
    return messages.unite(*sizes).select(
        "memory_size", "user_id", "alert_type", "event_id", _iso("ts"), "metric", "value"
    )


def _milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = alerts.view_totals(_user_events(spark, sf_dir), key="user_id")
    return alerts.milestones(totals, SCALED, key="user_id")


@query
def milestones(spark, sf_dir):
    return _milestones(spark, sf_dir).select(
        "user_id", "milestone_type", "milestone_value", "event_id", _iso("reached_at")
    )


@query
def milestones_by_selection(spark, sf_dir):
    found = alerts.milestones_by_selection(_user_events(spark, sf_dir), SCALED, key="user_id")
    return found.select("user_id", "milestone_type", "milestone_value", "event_id", _iso("reached_at"))


@query
def moderation_requests(spark, sf_dir):
    asked = alerts.scoring_requests(_user_alerts(spark, sf_dir), key="user_id")
    return asked.select(
        "image_id",
        "trigger",
        F.map_keys("context")[0].alias("metric"),
        F.map_values("context")[0].cast("bigint").alias("value"),
        F.round(F.col("timestamp") * 1e6).cast("bigint").alias("epoch_us"),
    )


@query
def alert_stats(spark, sf_dir):
    return alerts.alert_stats(_user_alerts(spark, sf_dir), _milestones(spark, sf_dir), key="user_id")


@query
def recent_alerts_topk(spark, sf_dir):
    return alerts.most_recent_alerts(_user_alerts(spark, sf_dir), 20, key="user_id").select(
        "alert_type", "user_id", "event_id", _long("recency_rank")
    )


@query
def milestone_insert_absent(spark, sf_dir):
    reached = _milestones(spark, sf_dir)
    stored = reached.filter(F.col("reached_at") < F.lit(MIDDLE).cast("timestamp"))
    return alerts.absent_milestones(reached, stored, key="user_id").select(
        "user_id", "milestone_type", "milestone_value", "event_id"
    )


@query
def milestone_history(spark, sf_dir):
    """Milestones of test accounts in order, numbered by the order they were reached in."""
    reached = _milestones(spark, sf_dir)
    asked = domain.users(spark, sf_dir).filter("is_test_account").select(F.col("id").alias("user_id"))
    return alerts.milestone_history(reached, asked, key="user_id").select(
        "user_id", "milestone_value", _iso("reached_at")
    )


# --- governance and training -------------------------------------------------


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.eligible_images(domain.images(spark, sf_dir), domain.users(spark, sf_dir))


def _eligible_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance.eligible_actions(domain.flags(spark, sf_dir), domain.users(spark, sf_dir))


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.tumbling_counts(domain.signals(spark, sf_dir), SCALED.tumbling_seconds)


@query
def eligible_images(spark, sf_dir):
    rows = _eligible(spark, sf_dir)
    return governance.stable_ids(rows, ["id", "user_id"]).select(
        "id", "user_id", "caption", "category", _iso("created_at"), _iso("user_created_at")
    )


@query
def eligibility_summary(spark, sf_dir):
    return governance.eligibility_summary(
        governance.images_with_policy(domain.images(spark, sf_dir), domain.users(spark, sf_dir))
    )


@query
def eligible_comments(spark, sf_dir):
    rows = governance.eligible_actions(domain.comments(spark, sf_dir), domain.users(spark, sf_dir))
    return rows.select("id", "image_id", "user_id", _iso("created_at"))


@query
def eligible_flags(spark, sf_dir):
    return _eligible_flags(spark, sf_dir).select("id", "image_id", "comment_id", "user_id", _iso("created_at"))


@query
def labels_24h(spark, sf_dir):
    return training.flag_labels(_eligible(spark, sf_dir), _eligible_flags(spark, sf_dir), SCALED).select(
        "image_id", _long(LABEL)
    )


@query
def image_window_features(spark, sf_dir):
    rows = training.window_features(_eligible(spark, sf_dir), _windows(spark, sf_dir), SCALED)
    return rows.withColumn("decision_point_minutes", _long("decision_point_minutes"))


@query
def user_image_count_asof(spark, sf_dir):
    return training.user_image_counts(_eligible(spark, sf_dir), SCALED).select(
        "image_id", _long("decision_point_minutes"), "user_image_count"
    )


def _as_wide(rows: DataFrame) -> DataFrame:
    """Integers as bigint, so that both sides of a comparison agree."""
    return rows.select(
        *[F.col(f.name).cast("bigint").alias(f.name) if f.dataType.simpleString() == "int" else f.name for f in rows.schema]
    )


@query
def training_set(spark, sf_dir):
    return _as_wide(risk_at_upload.training_set(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return _as_wide(training.label_distribution(risk_at_upload.training_set(spark, sf_dir)))


def _written_training(spark: SparkSession, sf_dir: str) -> str:
    """Two runs appended: images up to the middle of the month, then all images."""
    path = run_dir(spark, "training")
    sinks.append_snapshot(risk_at_upload.training_set(spark, sf_dir, before=MIDDLE), path, 1)
    sinks.append_snapshot(risk_at_upload.training_set(spark, sf_dir), path, 2)
    return path


@query
def training_as_of(spark, sf_dir):
    """Rows per image and decision point at the first snapshot and at the second."""
    path = _written_training(spark, sf_dir)
    last = tables.current_snapshot(spark, path)
    return (
        tables.read_as_of(spark, path, 1)
        .withColumn("as_of", F.lit(1).cast("bigint"))
        .unionByName(tables.read_as_of(spark, path, last).withColumn("as_of", F.lit(last).cast("bigint")))
        .groupBy("as_of", "image_id")
        .agg(F.count("*").alias("rows"), F.max(LABEL).cast("bigint").alias("label"))
    )


@query
def training_newest(spark, sf_dir):
    path = _written_training(spark, sf_dir)
    rows = tables.newest_per_row(tables.read_as_of(spark, path, 2), ["image_id", "decision_point_minutes"])
    return rows.select("image_id", _long("decision_point_minutes"), _long("snapshot_id"), "total_flags")


@query
def training_exclude_deleted(spark, sf_dir):
    """Training rows without the images of a category that was withdrawn afterwards."""
    rows = risk_at_upload.training_set(spark, sf_dir)
    gone = domain.images(spark, sf_dir).filter(F.col("category") == "Meat")
    excluded = governance.stable_ids(gone.select(F.col("id").alias("image_id")), ["image_id"])
    return governance.without_excluded(rows, excluded).groupBy("image_id").agg(F.count("*").alias("rows"))


@query
def training_after_withdrawal(spark, sf_dir):
    """What is trained on when a category was withdrawn between two rebuilds of the training table."""
    path = run_dir(spark, "withdrawn")
    rows = risk_at_upload.training_set(spark, sf_dir)
    sinks.append_snapshot(rows, path, 1)
    sinks.append_snapshot(rows.filter(F.col("category") != "Meat"), path, 2)
    left = tables.rows_of(spark, path, tables.current_snapshot(spark, path))
    return left.groupBy("image_id").agg(F.count("*").alias("rows"))


@query
def training_excluded_after_rebuilds(spark, sf_dir):
    """The training table after two rebuilds, the second without a category, and an exclusion by user."""
    root = run_dir(spark, "excluded")
    rows = risk_at_upload.training_set(spark, sf_dir)
    sinks.append_snapshot(rows, f"{root}/training", 1)
    sinks.append_snapshot(rows.filter(F.col("category") != "Meat"), f"{root}/training", 2)
    gone = domain.images(spark, sf_dir).filter(F.col("user_id") % 2 == 0).select(F.col("id").alias("image_id"))
    jobs.remove_excluded(spark, root, governance.stable_ids(gone, ["image_id"]), 3)
    left = tables.read_as_of(spark, f"{root}/training", 3)
    return left.groupBy("image_id").agg(F.count("*").alias("rows"))


@query
def raw_snapshots(spark, sf_dir):
    """Raw copies of the tables, taken twice, with the rows the second copy holds."""
    root = run_dir(spark, "raw")
    copied = {
        "users": domain.users(spark, sf_dir),
        "images": domain.images(spark, sf_dir),
        "comments": domain.comments(spark, sf_dir),
        "flags": domain.flags(spark, sf_dir),
    }
    parts = []
    for name, rows in copied.items():
        sinks.overwrite_snapshot(rows.filter(F.col("created_at") < F.lit(MIDDLE).cast("timestamp")), root, name)
        sinks.overwrite_snapshot(rows, root, name)
        stored = tables.parquet_table(spark, f"{root}/raw/{name}/latest.parquet")
        parts.append(
            stored.agg(
                F.lit(name).alias("table"),
                F.count("*").alias("rows"),
                F.sum("id").alias("id_sum"),
                F.max(times.iso(F.col("created_at"))).alias("newest"),
            )
        )
    return messages.unite(*parts)


# --- serving ----------------------------------------------------------------


@query
def features_at_request(spark, sf_dir):
    asked = serving.accepted_requests(domain.requests(spark, sf_dir))
    return serving.activity_at(asked, domain.signals(spark, sf_dir), SCALED).drop("ts")


@query
def serving_metadata(spark, sf_dir):
    rows = serving.image_metadata(domain.images(spark, sf_dir), domain.users(spark, sf_dir))
    return _as_wide(rows).withColumn("uploaded_at", _iso("uploaded_at")).withColumn(
        "user_created_at", _iso("user_created_at")
    )


@query
def merged_features(spark, sf_dir):
    """Metadata from the upload messages, overridden by the relational table where it has the image."""
    stored = domain.images(spark, sf_dir).select(
        F.col("id").alias("image_id"),
        F.lit("unknown").alias("category"),
        F.col("user_id").alias("uploader"),
    )
    table = (
        domain.images(spark, sf_dir)
        .filter(F.col("deleted_at").isNull())
        .select(F.col("id").alias("image_id"), "category", content.caption_length(F.col("caption")).cast("bigint").alias("caption_length"))
    )
    return serving.prefer_right(stored, table, "image_id")


def _request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.request_features(
        domain.requests(spark, sf_dir),
        domain.signals(spark, sf_dir),
        domain.images(spark, sf_dir),
        domain.users(spark, sf_dir),
        SCALED,
    )


@query
def feature_vector(spark, sf_dir):
    rows = _request_rows(spark, sf_dir).select("request_id", risk.vector_map(risk.feature_vector()).alias("v"))
    return rows.select("request_id", *[F.col("v")[n].cast("double").alias(n) for n in FEATURE_NAMES])


@query
def feature_summary(spark, sf_dir):
    vector = risk.feature_vector()
    return _request_rows(spark, sf_dir).select(
        "request_id",
        risk.vector_summary(vector).alias("summary"),
        risk.vector_summary(vector, compact=True).alias("compact"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.rule_predictor(SCALED.rules)(_request_rows(spark, sf_dir))


@query
def risk_scores(spark, sf_dir):
    return risk_at_upload.risk_scores(spark, sf_dir)


@query
def request_risk_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("request_id", "image_id", "trigger", "moderation_probability", "needs_review")


@query
def risk_reasons(spark, sf_dir):
    return _scored(spark, sf_dir).select("request_id", F.array_join("reasoning", " | ").alias("reasons"))


@query
def risk_explain_ranked(spark, sf_dir):
    ranked = risk.ranked_factors(F.col("risk_factors"))
    text = F.transform(ranked, lambda e: F.concat(e["factor"], F.lit("="), F.format_string("%.2f", e["contribution"])))
    return _scored(spark, sf_dir).select("request_id", F.array_join(text, ", ").alias("factors"))


@query
def decisions_by_trigger(spark, sf_dir):
    return serving.decisions_by_trigger(serving.decisions(_scored(spark, sf_dir), F.col("ts")))


# --- quality ----------------------------------------------------------------


def _raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables with the faults real ones would be checked for."""
    users, images = domain.users(spark, sf_dir), domain.images(spark, sf_dir)
    comments, flags = domain.comments(spark, sf_dir), domain.flags(spark, sf_dir)
    i = F.col("id")

    def pick(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))

    decided = flags.select(
        i,
        pick("image", "comment", "account", "page", None).alias("target_type"),
        F.coalesce("image_id", "comment_id").cast("string").alias("target_id"),
        F.lit("heuristic").alias("inference_mode"),
        ((i % 50) / F.lit(40.0)).alias("risk_score"),
        F.when(i % 2 == 0, F.lit("v1")).alias("policy_version"),
    )
    return {
        "users": users.withColumns(
            {
                "username": F.when(i % 29 != 0, F.concat(F.lit("name-"), F.floor(i / 2).cast("string"))),
                "tos_version_accepted": F.when(i % 7 != 0, (i % 4).cast("int")),
                "year_of_birth": F.when(i % 11 != 0, (1880 + i % 160).cast("int")),
            }
        ),
        "images": images.withColumns(
            {
                "s3_url": F.when(i % 9 != 0, content.object_url("http://store", "images", i.cast("string"))),
                "source": pick("user_upload", "synthetic", "import", "scrape", None),
                "views": F.when(i % 3 == 0, 1),
            }
        ),
        "comments": comments.withColumns(
            {"content": F.lit("text"), "moderator_hidden": F.when(i % 2 == 0, False), "moderator_action_id": i + 1}
        ),
        "flags": flags.withColumns(
            {"reason": F.lit("spam"), "review_status": pick("pending", "confirmed", "rejected", "open", None), "moderation_action_id": F.when(i % 3 == 0, i)}
        ),
        "moderation": decided,
    }


@query
def constraint_violations(spark, sf_dir):
    raw = _raw_tables(spark, sf_dir)
    return messages.unite(*[quality.check_violations(raw[t], t, 2026) for t in ("users", "images", "flags", "moderation")])


@query
def fk_violations(spark, sf_dir):
    """Missing parents when test accounts, deleted images, early comments and decisions without target are gone."""
    raw = _raw_tables(spark, sf_dir)
    kept = {
        "users": raw["users"].filter(~F.coalesce("is_test_account", F.lit(False))),
        "images": raw["images"].filter(F.col("deleted_at").isNull()),
        "comments": raw["comments"].filter(F.col("created_at") >= F.lit(MIDDLE).cast("timestamp")),
        "moderation": raw["moderation"].filter(F.col("target_id").isNotNull()),
    }
    return quality.foreign_key_violations({t: raw[t] for t in ("images", "comments", "flags")}, kept)


@query
def unique_violations(spark, sf_dir):
    users = _raw_tables(spark, sf_dir)["users"].filter(F.col("username").isNotNull())
    return quality.unique_violations(users, ["username"])


@query
def null_violations(spark, sf_dir):
    raw = _raw_tables(spark, sf_dir)
    return messages.unite(*[quality.null_counts(raw[t], t) for t in raw])


@query
def column_defaults(spark, sf_dir):
    raw = _raw_tables(spark, sf_dir)
    return messages.unite(*[quality.default_usage(raw[t], t) for t in quality.DEFAULTS])


@query
def users_get_or_create(spark, sf_dir):
    """Requests for names some of which have accounts, several per name."""
    asked = domain.account_requests(spark, sf_dir).drop("ts")
    return entities.get_or_create_users(asked, domain.users(spark, sf_dir), "arrival")


@query
def upload_metadata_upsert(spark, sf_dir):
    return entities.latest_metadata(domain.upload_rows(spark, sf_dir), order="seq")


@query
def latest_features_lookup(spark, sf_dir):
    """Features of every event's id taken as image id, at the end of the data; ids without upload stay empty."""
    events = governance.stable_ids(domain.signals(spark, sf_dir), ["image_id"])
    now = F.lit("2024-01-31T00:00:00").cast("timestamp")
    stored = entities.features_now(entities.latest_metadata(domain.upload_rows(spark, sf_dir), order="seq"), events, now, SCALED)
    asked = domain.events(spark, sf_dir).select(F.col("event_id").cast("string").alias("image_id"))
    return _as_wide(entities.lookup(stored, asked)).drop("seq")


@query
def feature_keys_like(spark, sf_dir):
    return entities.keys_like(entities.latest_metadata(domain.upload_rows(spark, sf_dir), order="seq"), "1*7?")


# --- files and profiles ------------------------------------------------------


def _file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat file names as a data set download leaves them, three splits."""
    key = F.col("event_id")
    split = F.element_at(F.array(*[F.lit(s) for s in files.SPLITS]), (key % 3 + 1).cast("int"))
    ending = F.element_at(
        F.array(*[F.lit(s) for s in ("jpg", "JPEG", "png", "txt", "Jpg")]), (key % 5 + 1).cast("int")
    )
    return domain.events(spark, sf_dir).select(
        split.alias("split"), F.concat((key % 13).cast("string"), F.lit("_"), key.cast("string"), F.lit("."), ending).alias("name")
    )


@query
def path_category_rollup(spark, sf_dir):
    placed = files.sorted_into_classes(_file_names(spark, sf_dir)).drop("split")
    return files.files_per_class(files.image_files(placed))


@query
def path_categories(spark, sf_dir):
    placed = files.sorted_into_classes(_file_names(spark, sf_dir)).drop("split")
    return files.image_files(placed).groupBy("class", "category").agg(F.count("*").alias("files"))


@query
def object_keys(spark, sf_dir):
    names = _file_names(spark, sf_dir)
    ident = F.substring_index("name", ".", 1)
    return names.select(
        "name",
        content.file_extension(F.col("name")).alias("extension"),
        content.object_url("http://store:9000", "images", content.object_key(ident, F.col("name"))).alias("url"),
        content.short_id(F.col("name")).alias("short"),
    )


@query
def table_profile(spark, sf_dir):
    return quality.table_profile(risk_at_upload.training_set(spark, sf_dir))


@query
def table_head(spark, sf_dir):
    rows = risk_at_upload.training_set(spark, sf_dir)
    return _as_wide(
        quality.first_rows(rows, ["image_id", "decision_point_minutes"]).select(
            "image_id", "decision_point_minutes", "category", "total_flags", "user_image_count"
        )
    )


# --- learning ---------------------------------------------------------------


@query
def model_inputs(spark, sf_dir):
    return _as_wide(learning.model_inputs(risk_at_upload.training_set(spark, sf_dir)))


@query
def scaler_statistics(spark, sf_dir):
    rows = learning.scaler_statistics(learning.model_inputs(risk_at_upload.training_set(spark, sf_dir)))
    return rows.select("feature", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query
def category_values(spark, sf_dir):
    return learning.category_values(learning.model_inputs(risk_at_upload.training_set(spark, sf_dir)))


@query
def model_scores(spark, sf_dir):
    """Every training row scored by a model fitted on a pinned snapshot of the table."""
    path = run_dir(spark, "model-training")
    sinks.append_snapshot(risk_at_upload.training_set(spark, sf_dir), path, 1)
    rows = tables.read_as_of(spark, path, 1)
    return learning.score(learning.fit(rows), rows, ["image_id", "decision_point_minutes", LABEL])


@query
def model_request_scores(spark, sf_dir):
    """Scoring requests by a trained model in place of the rules."""
    # Every stage of the fit reads the rows again.
    rows = sinks.staged(risk_at_upload.training_set(spark, sf_dir), run_dir(spark, "model-training"))
    predict = learning.model_predictor(learning.fit(rows), "v1")
    return predict(_request_rows(spark, sf_dir)).select(
        "request_id", "image_id", "trigger", "moderation_probability", "inference_mode", "model_version"
    )


def _out_of_range():
    p = F.col("moderation_probability")
    return F.count_if(~F.coalesce(p.between(0, 1), F.lit(False))).alias("out_of_range")


@query
def model_score_checks(spark, sf_dir):
    """Scores per label and decision point. The intercept is free, so over all rows scores add up to the labels."""
    scored = QUERIES["model_scores"](spark, sf_dir)
    gap = F.sum(F.col("moderation_probability") - F.col(LABEL))
    groups = scored.groupBy(F.col(LABEL).alias("label"), "decision_point_minutes").agg(
        F.count("*").alias("rows"), _out_of_range(), gap.alias("part")
    )
    total = F.round(F.abs(F.sum("part").over(Window.partitionBy())), 1)
    return _as_wide(groups.withColumn("gap", total.cast("bigint")).drop("part"))


@query
def model_request_checks(spark, sf_dir):
    """Requests a model scored, per trigger."""
    scored = QUERIES["model_request_scores"](spark, sf_dir)
    return scored.groupBy("trigger", "inference_mode", "model_version").agg(F.count("*").alias("requests"), _out_of_range())


@query
def training_metadata(spark, sf_dir):
    """What is stored with a model, without its clock and batch count."""
    path = run_dir(spark, "model-metadata")
    sinks.append_snapshot(risk_at_upload.training_set(spark, sf_dir), path, 7)
    pinned = tables.current_snapshot(spark, path)
    rows = tables.read_as_of(spark, path, pinned)
    return learning.training_metadata(rows, pinned).select("snapshot_id", "rows_seen", "algorithm")


# --- streams (each runs to the end of its input and returns the resulting table) --

for _name, _run in streams.QUERIES.items():
    QUERIES[_name] = lambda spark, sf_dir, _run=_run: _run(prepare(spark), sf_dir)
