"""Risk of every eligible image at every decision point after its upload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators import counters, governance, serving, training
from crowdpulse.params import SCALED, EngagementParams
from crowdpulse.session import run_dir
from crowdpulse.sources import domain, sinks


def training_set(
    spark: SparkSession, sf_dir: str, params: EngagementParams = SCALED, before: str | None = None
) -> DataFrame:
    """Training rows of all images, or of those uploaded before a day."""
    users = domain.users(spark, sf_dir)
    uploaded = domain.images(spark, sf_dir)
    if before is not None:
        uploaded = uploaded.filter(F.col("created_at") < F.lit(before).cast("timestamp"))
    images = sinks.staged(
        governance.eligible_images(uploaded, users, params.adult_age), run_dir(spark, "eligible-images")
    )
    windows = counters.tumbling_counts(domain.signals(spark, sf_dir), params.tumbling_seconds)
    flags = governance.eligible_actions(domain.flags(spark, sf_dir), users, params.adult_age)
    return training.training_rows(images, windows, flags, params)


def risk_scores(spark: SparkSession, sf_dir: str, params: EngagementParams = SCALED) -> DataFrame:
    rows = training_set(spark, sf_dir, params)
    scored = serving.rule_predictor(params.rules)(rows)
    return scored.select(
        "image_id",
        F.col("decision_point_minutes").cast("bigint").alias("decision_point_minutes"),
        "total_flags",
        "user_image_count",
        "moderation_probability",
        "needs_review",
    )
