"""Point-in-time training rows: window features, labels, user counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions import content, risk, times
from crowdpulse.operators.sequences import MICROS, rolling_counts
from crowdpulse.params import LABEL, EngagementParams
from crowdpulse.schemas import TRAINING

COUNT_KINDS = ("view", "comment", "flag")
MINUTE = 60 * MICROS


def decision_points(images: DataFrame, params: EngagementParams) -> DataFrame:
    """Every image at every decision point, with its cutoff time."""
    points = F.array(*[F.lit(m).cast("int") for m in params.decision_points])
    return images.withColumn("decision_point_minutes", F.explode(points)).withColumn(
        "cutoff", times.plus_seconds(F.col("created_at"), F.col("decision_point_minutes") * 60)
    )


def _window_facts(windows: DataFrame) -> DataFrame:
    return windows.select(
        "image_id",
        "kind",
        F.col("window_start").alias("since"),
        F.col("window_end").alias("until"),
        F.col("event_count").alias("n"),
    )


def _label_facts(eligible_flags: DataFrame) -> DataFrame:
    """Earliest and latest eligible flag per image and hour.

    An hour is shorter than the label horizon, so it holds a flag of the interval
    exactly when its latest is not before the upload and its earliest not after
    the end. A hot image is one row per hour.
    """
    hour = F.date_trunc("hour", "created_at")
    return (
        eligible_flags.filter(F.col("image_id").isNotNull())
        .groupBy("image_id", hour.alias("__hour"))
        .agg(
            F.min("created_at").alias("since"), F.max("created_at").alias("until"), F.count("*").alias("n")
        )
        .select("image_id", F.lit("label").alias("kind"), "since", "until", "n")
    )


def _per_image(images: DataFrame, facts: DataFrame, params: EngagementParams) -> DataFrame:
    """Images with ``points`` (window counts at each decision point) and the label.

    A window counts when it starts at or after the upload and ends at or before
    the cutoff; the recent counts also need an end after cutoff - W. One join on
    the image and one aggregation on the same key serve all decision points and
    the label. ``facts`` are reduced per image and time unit, so a hot image is
    bounded by the time span, whatever its traffic.
    """
    if params.label_horizon_hours < 1:
        raise ValueError("the label horizon must be at least one hour")
    upload, kind = F.unix_micros("created_at"), F.col("kind")
    f = facts.select(
        F.col("image_id").alias("__image"),
        "kind",
        F.unix_micros("since").alias("__since"),
        F.unix_micros("until").alias("__until"),
        "n",
    )
    since, until = F.col("__since"), F.col("__until")
    in_window = (kind != "label") & (since >= upload) & (until <= upload + max(params.decision_points) * MINUTE)
    in_label = (kind == "label") & (until >= upload) & (since <= upload + params.label_horizon_hours * 60 * MINUTE)
    joined = images.join(f, (F.col("id") == F.col("__image")) & (in_window | in_label), "left").select(
        *images.columns,
        "kind",
        # Age of the image at the end of the window; one column of counts per kind.
        (until - upload).alias("__age"),
        *[F.when(kind == of, F.col("n")).alias(f"__{of}") for of in COUNT_KINDS],
    )
    age = F.col("__age")

    def counted(of: str, minutes: int, recent: int | None):
        seen = age <= minutes * MINUTE
        if recent is not None:
            seen = seen & (age > (minutes - recent) * MINUTE)
        return F.coalesce(F.sum(F.when(seen, F.col(f"__{of}"))), F.lit(0))

    def at(minutes: int):
        fields = [F.lit(minutes).cast("int").alias("decision_point_minutes")]
        for of in COUNT_KINDS:
            for name, recent in params.recency_minutes.items():
                fields.append(counted(of, minutes, recent).alias(f"{of}s_{name}"))
        fields.append(counted("flag", minutes, None).alias("total_flags"))
        return F.struct(*fields)

    return joined.groupBy(*images.columns).agg(
        F.array(*[at(m) for m in params.decision_points]).alias("points"),
        F.max(F.when(kind == "label", 1).otherwise(0)).alias(LABEL),
    )


def window_features(images: DataFrame, windows: DataFrame, params: EngagementParams) -> DataFrame:
    """Window counts of each image as known at each decision point.

    ``windows``: (kind, image_id, window_start, window_end, event_count), final or
    partial rows.
    """
    per_image = _per_image(images.select("id", "created_at"), _window_facts(windows), params)
    return per_image.select(F.col("id").alias("image_id"), F.explode("points").alias("p")).select(
        "image_id", "p.*"
    )


def flag_labels(images: DataFrame, eligible_flags: DataFrame, params: EngagementParams) -> DataFrame:
    """1 when an eligible flag falls in [upload, upload + horizon], both ends included."""
    per_image = _per_image(images.select("id", "created_at"), _label_facts(eligible_flags), params)
    return per_image.select(F.col("id").alias("image_id"), LABEL)


def user_image_counts(images: DataFrame, params: EngagementParams, bucket_seconds: int = 3600) -> DataFrame:
    """Images of the same user uploaded up to each cutoff (itself and later uploads included).

    Every image is one fact at its upload and one question per decision point; the
    answer is the running total at the question. Uploads of one user are sparse, so a bucket is an hour.
    """
    upload = F.col("created_at")
    rows = [F.struct(upload.alias("at"), F.lit(None).cast("int").alias("decision_point_minutes"))]
    rows += [
        F.struct(times.plus_seconds(upload, m * 60).alias("at"), F.lit(m).cast("int").alias("decision_point_minutes"))
        for m in params.decision_points
    ]
    spread = images.select(
        "user_id", F.col("id").alias("image_id"), F.explode(F.array(*rows)).alias("r")
    ).select("user_id", "image_id", "r.*")
    is_image = F.col("decision_point_minutes").isNull()
    return (
        rolling_counts(
            spread,
            key="user_id",
            ts=F.col("at"),
            # Uploads at the cutoff itself count.
            order=F.when(is_image, 0).otherwise(1),
            totals={"images": is_image},
            bucket_seconds=bucket_seconds,
        )
        .filter(~is_image)
        .select("image_id", "decision_point_minutes", F.col("images_total").alias("user_image_count"))
    )


def with_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "view_velocity_per_min": risk.view_velocity(F.col("views_5min")),
            "comment_to_view_ratio": risk.comment_to_view_ratio(F.col("comments_1hr"), F.col("views_1hr")),
            "recent_engagement_score": risk.recent_engagement(F.col("views_5min"), F.col("comments_5min")),
        }
    )


def training_rows(
    images: DataFrame, windows: DataFrame, eligible_flags: DataFrame, params: EngagementParams
) -> DataFrame:
    """One labelled row per eligible image and decision point.

    ``images`` are eligible images with ``user_created_at``. Counts, labels and
    user counts meet on the image id before the decision points are spread out,
    so every side is shuffled once.
    """
    facts = _window_facts(windows).unionByName(_label_facts(eligible_flags))
    described = images.select(
        "id",
        "created_at",
        content.caption_length(F.col("caption")).alias("caption_length"),
        times.days_between(F.col("user_created_at"), F.col("created_at")).alias("user_age_days"),
        F.coalesce("category", F.lit("Unknown")).alias("category"),
    )
    minutes = F.col("decision_point_minutes")
    uploads = (
        user_image_counts(images, params)
        .groupBy(F.col("image_id").alias("id"))
        .agg(*[F.max(F.when(minutes == m, F.col("user_image_count"))).alias(f"__u{m}") for m in params.decision_points])
    )
    known = F.create_map(*[x for m in params.decision_points for x in (F.lit(m), F.col(f"__u{m}"))])
    upload = F.col("created_at")
    rows = (
        _per_image(described, facts, params)
        .join(uploads, "id")
        .withColumn("p", F.explode("points"))
        .select("*", "p.*")
        .withColumns(
            {
                "image_id": F.col("id"),
                "time_since_upload_seconds": minutes.cast("bigint") * 60,
                "hour_of_day": times.hour_of_day(upload),
                "day_of_week": times.day_of_week(upload),
                "is_weekend": times.is_weekend(upload),
                "has_caption": F.when(F.col("caption_length") > 0, 1).otherwise(0),
                "user_image_count": known[minutes],
            }
        )
    )
    return with_ratios(rows).select(*[F.col(f.name).cast(f.dataType) for f in TRAINING])


def label_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy(LABEL).agg(F.count("*").alias("samples"))
