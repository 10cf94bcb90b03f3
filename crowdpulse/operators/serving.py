"""Features and scores for scoring requests, set at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions import content, risk, times
from crowdpulse.operators.sequences import rolling_counts
from crowdpulse.operators.training import with_ratios
from crowdpulse.params import FEATURE_NAMES, EngagementParams, RiskRules

Predictor = Callable[[DataFrame], DataFrame]


def accepted_requests(requests: DataFrame) -> DataFrame:
    """Requests that name an image; a missing trigger is 'unknown'."""
    return requests.filter(content.present(F.col("image_id"))).withColumn(
        "trigger", F.coalesce("trigger", F.lit("unknown"))
    )


KINDS = ("view", "comment", "flag")


def activity_at(
    requests: DataFrame, events: DataFrame, params: EngagementParams, totals: DataFrame | None = None
) -> DataFrame:
    """Window counts over [t-W, t] and lifetime totals, for each request at its time t.

    Without ``totals`` the totals are those up to t and ``events`` is the whole
    history. With a totals table (one row per image) they are its current values
    and ``events`` needs to reach back one longest window only.
    """
    asked = requests.select("request_id", "image_id", "trigger", "ts", F.lit("request").alias("kind"))
    # Only the history of the images asked for goes past the first exchange.
    ids = requests.select("image_id").distinct()
    facts = events.select("image_id", "ts", "kind", "event_id").join(ids, "image_id", "left_semi")
    last = F.lit(2**63 - 1)
    kinds = {f"{k}s": F.col("kind") == k for k in KINDS}
    counted = (
        rolling_counts(
            facts.unionByName(asked, allowMissingColumns=True),
            key="image_id",
            ts=F.col("ts"),
            order=F.coalesce(F.col("event_id"), last),
            measures=kinds,
            windows=params.serving_seconds,
            totals=kinds if totals is None else None,
            edge="closed",
        )
        .filter(F.col("kind") == "request")
        .drop("kind", "event_id")
    )
    names = [f"total_{k}s" for k in KINDS]
    if totals is None:
        return counted.withColumnsRenamed({f"{k}s_total": f"total_{k}s" for k in KINDS})
    return counted.join(totals.select("image_id", *names), "image_id", "left").withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in names}
    )


def image_metadata(images: DataFrame, users: DataFrame) -> DataFrame:
    """Category, caption and uploader of every image, with the uploader's number of images."""
    per_user = images.groupBy("user_id").agg(F.count("*").alias("user_image_count"))
    owners = users.select(F.col("id").alias("user_id"), F.col("created_at").alias("user_created_at")).join(
        per_user, "user_id"
    )
    return images.join(owners, "user_id").select(
        F.col("id").alias("image_id"),
        "user_id",
        content.category_or(F.col("category")).alias("category"),
        content.caption_length(F.col("caption")).alias("caption_length"),
        content.has_caption(F.col("caption")).alias("has_caption"),
        F.col("created_at").alias("uploaded_at"),
        "user_created_at",
        "user_image_count",
    )


def request_features(
    requests: DataFrame,
    events: DataFrame,
    images: DataFrame,
    users: DataFrame,
    params: EngagementParams,
    totals: DataFrame | None = None,
) -> DataFrame:
    """All features of each request at its own time. Requests for unknown images drop out."""
    at = activity_at(accepted_requests(requests), events, params, totals)
    meta = image_metadata(images, users)
    joined = at.join(meta, "image_id")
    return with_vector_columns(
        joined.withColumns(
            {
                "time_since_upload_seconds": times.seconds_between(F.col("uploaded_at"), F.col("ts")),
                "user_age_days": times.days_between(F.col("user_created_at"), F.col("ts")),
            }
        )
    )


def with_vector_columns(rows: DataFrame) -> DataFrame:
    """Add the columns of the vector that follow from counts and metadata."""
    return with_ratios(rows).withColumns(
        {
            "hour_of_day": times.hour_of_day(F.col("uploaded_at")),
            "day_of_week": times.day_of_week(F.col("uploaded_at")),
            "is_weekend": times.is_weekend(F.col("uploaded_at")),
            **content.one_hot(F.col("category")),
        }
    )


def vector_columns(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The vector as named float columns."""
    return rows.select(*keys, *[risk.vector_element(F.col(n)).alias(n) for n in FEATURE_NAMES])


def prefer_right(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Merge two feature sources on ``key``; where both have a column the right one wins.

    The right value wins even when null, as long as the right source has the key.
    """
    r = right.select(key, *[F.col(c).alias(f"__r_{c}") for c in right.columns if c != key], F.lit(True).alias("__in"))
    merged = []
    for c in dict.fromkeys([*left.columns, *right.columns]):
        if c == key:
            continue
        if c in right.columns and c in left.columns:
            merged.append(F.when(F.col("__in"), F.col(f"__r_{c}")).otherwise(F.col(c)).alias(c))
        elif c in right.columns:
            merged.append(F.col(f"__r_{c}").alias(c))
        else:
            merged.append(F.col(c))
    return left.join(r, key, "left").select(key, *merged)


def rule_predictor(rules: RiskRules = RiskRules()) -> Predictor:
    """Predictor that adds probability, reasons and factors by the rules."""
    rule = risk.RuleScore(rules)

    def predict(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "moderation_probability": rule.score(),
                "reasoning": rule.reasons(),
                "risk_factors": rule.factors(),
                "needs_review": rule.needs_review(),
                "inference_mode": F.lit("heuristic"),
                "model_version": F.lit(None).cast("string"),
            }
        )

    return predict


def decisions(scored: DataFrame, decided_at: Column | None = None) -> DataFrame:
    """Scored requests as rows of the moderation table."""
    return scored.select(
        F.col("request_id").cast("string").alias("inference_request_id"),
        F.lit("image").alias("target_type"),
        F.col("image_id").cast("string").alias("target_id"),
        "inference_mode",
        "model_version",
        F.col("moderation_probability").alias("risk_score"),
        F.col("trigger").alias("trigger_type"),
        F.lit("v1").alias("policy_version"),
        F.lit(None).cast("string").alias("rationale"),
        (decided_at if decided_at is not None else F.current_timestamp()).alias("created_at"),
    )


def decisions_by_trigger(moderation: DataFrame) -> DataFrame:
    # Decimal sums do not depend on the order rows arrive in.
    return (
        moderation.groupBy("trigger_type", "inference_mode")
        .agg(
            F.count("*").alias("decisions"),
            F.round(F.avg(F.col("risk_score").cast("decimal(18,12)")).cast("double"), 6).alias("avg_risk_score"),
        )
    )
