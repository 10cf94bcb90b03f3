"""Threshold alerts and view milestones on rolling counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.operators.sequences import kth_rows, rolling_counts
from crowdpulse.params import EngagementParams

# Alerts that ask for a score; the others are only recorded.
REQUESTING = ("viral", "suspicious")


def activity_counts(
    events: DataFrame, params: EngagementParams, key: str = "image_id", ts: str = "ts", order: str = "event_id"
) -> DataFrame:
    """Rolling and running counts at every view, comment and flag of an image."""
    kinds = {f"{k}s": F.col("kind") == k for k in ("view", "comment", "flag")}
    return rolling_counts(
        events,
        key=key,
        ts=F.col(ts),
        order=F.col(order),
        measures=kinds,
        windows=params.rolling_seconds,
        totals=kinds,
    )


def own_counts(
    events: DataFrame, params: EngagementParams, key: str = "image_id", ts: str = "ts", order: str = "event_id"
) -> DataFrame:
    """Rolling counts of an event's own kind only, one sequence per image and kind."""
    return rolling_counts(
        events,
        key=[key, "kind"],
        ts=F.col(ts),
        order=F.col(order),
        measures={"count": F.lit(True)},
        windows=params.rolling_seconds,
        edge="open",
    )


def alert_counts(
    events: DataFrame, params: EngagementParams, key: str = "image_id", ts: str = "ts", order: str = "event_id"
) -> DataFrame:
    """The counts the alert rules read, at the views and comments of an image; flags raise none."""
    rolling = params.rolling_seconds
    kinds = {f"{k}s": F.col("kind") == k for k in ("view", "comment")}
    return rolling_counts(
        events.filter(F.col("kind").isin("view", "comment")),
        key=key,
        ts=F.col(ts),
        order=F.col(order),
        measures=kinds,
        windows={
            "views": {w: rolling[w] for w in ("5min", "1hr")},
            "comments": {"1min": rolling["1min"]},
        },
        totals={"views": kinds["views"]},
    )


def view_totals(
    events: DataFrame, key: str = "image_id", ts: str = "ts", order: str = "event_id", bucket_seconds: int = 60
) -> DataFrame:
    """Running number of views at each view: all that milestones need."""
    return rolling_counts(
        events.filter(F.col("kind") == "view"),
        key=key,
        ts=F.col(ts),
        order=F.col(order),
        totals={"views": F.lit(True)},
        bucket_seconds=bucket_seconds,
    )


def crossings(counts: DataFrame, params: EngagementParams, key: str = "image_id", order: str = "event_id") -> DataFrame:
    """All events at which an alert's threshold is met.

    Views and comments can raise alerts, flags never; the comment rule is looked
    at on comments only.
    """
    rule = F.array(
        F.when(
            F.col("views_5min") >= params.viral_views_5min,
            F.struct(
                F.lit("viral").alias("alert_type"),
                F.lit("views_5min").alias("metric"),
                F.col("views_5min").alias("value"),
            ),
        ),
        F.when(
            (F.col("kind") == "comment") & (F.col("comments_1min") >= params.suspicious_comments_1min),
            F.struct(
                F.lit("suspicious").alias("alert_type"),
                F.lit("comments_1min").alias("metric"),
                F.col("comments_1min").alias("value"),
            ),
        ),
        F.when(
            F.col("views_1hr") >= params.popular_views_1hr,
            F.struct(
                F.lit("popular").alias("alert_type"),
                F.lit("views_1hr").alias("metric"),
                F.col("views_1hr").alias("value"),
            ),
        ),
    )
    return (
        counts.filter(F.col("kind").isin("view", "comment"))
        .select(key, order, "ts", F.explode(F.array_compact(rule)).alias("a"))
        .select(key, order, "ts", "a.*")
    )


def first_alerts(found: DataFrame, key: str = "image_id", order: str = "event_id") -> DataFrame:
    """Each alert once per image, at its first crossing. The minimum is merged before the shuffle."""
    first = F.min(F.struct("ts", order, "metric", "value")).alias("f")
    return found.groupBy(key, "alert_type").agg(first).select(key, "alert_type", "f.*")


def milestones(counts: DataFrame, params: EngagementParams, key: str = "image_id", order: str = "event_id") -> DataFrame:
    """When each image's total views reached each milestone.

    The running total rises by one per view, so a milestone is reached at the row
    whose total equals it: a filter, no further shuffle.
    """
    return counts.filter(
        (F.col("kind") == "view") & F.col("views_total").isin(*params.milestones)
    ).select(
        key,
        F.lit("views").alias("milestone_type"),
        F.col("views_total").alias("milestone_value"),
        F.col("ts").alias("reached_at"),
        order,
    )


def milestones_by_selection(
    events: DataFrame, params: EngagementParams, key: str = "image_id", ts: str = "ts", order: str = "event_id"
) -> DataFrame:
    """The same milestones without a running total: the k-th view is selected where bucket sums say it lies."""
    views = events.filter(F.col("kind") == "view").select(key, ts, order)
    found = kth_rows(views, key=key, ts=F.col(ts), order=F.col(order), numbers=tuple(params.milestones))
    return found.select(
        key,
        F.lit("views").alias("milestone_type"),
        F.col("k").alias("milestone_value"),
        F.col(ts).alias("reached_at"),
        order,
    )


def scoring_requests(alerts: DataFrame, key: str = "image_id") -> DataFrame:
    """Alerts that ask for a score, as request messages."""
    return alerts.filter(F.col("alert_type").isin(*REQUESTING)).select(
        F.col(key).alias("image_id"),
        F.col("alert_type").alias("trigger"),
        F.create_map(F.col("metric"), F.col("value").cast("int")).alias("context"),
        (F.unix_micros("ts") / F.lit(1e6)).alias("timestamp"),
    )


def alert_stats(alerts: DataFrame, reached: DataFrame, key: str = "image_id") -> DataFrame:
    """Images per alert type, and milestones reached. Alerts are already one per image."""
    per_type = alerts.groupBy("alert_type").agg(F.count(key).alias("alerts"))
    return per_type.unionByName(
        reached.agg(F.lit("milestones").alias("alert_type"), F.count("*").alias("alerts"))
    )


def most_recent_alerts(alerts: DataFrame, n: int, key: str = "image_id") -> DataFrame:
    """The ``n`` most recently alerted images of each type.

    Spark keeps only ``n`` rows per type and task before the shuffle
    (WindowGroupLimit), so the single task of a type sees ``n`` rows per map task.
    """
    newest = Window.partitionBy("alert_type").orderBy(F.desc("ts"), F.desc(key))
    return (
        alerts.withColumn("recency_rank", F.row_number().over(newest))
        .filter(F.col("recency_rank") <= n)
    )


def absent_milestones(reached: DataFrame, stored: DataFrame, key: str = "image_id") -> DataFrame:
    """Milestones not yet stored: what an insert-if-absent would add."""
    return reached.join(stored, [key, "milestone_type", "milestone_value"], "left_anti")


def milestone_history(reached: DataFrame, images: DataFrame, key: str = "image_id") -> DataFrame:
    """Milestones of the given images, ordered by image and time reached."""
    return reached.join(images.select(key).distinct(), key, "left_semi").orderBy(
        key, "reached_at", "milestone_value"
    )
