"""Requests against events as a join of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.operators.sequences import MICROS
from crowdpulse.operators.serving import accepted_requests
from crowdpulse.params import EngagementParams

KINDS = ("view", "comment", "flag")


def request_counts(
    requests: DataFrame, events: DataFrame, params: EngagementParams, late: str = "10 minutes", salts: int = 2
) -> DataFrame:
    """Window counts over [t-W, t] of each request, both sides streams (append mode).

    Both sides are kept in Spark's state for the longest window plus ``late``: an event joins the
    requests up to one window after it, a request the events up to one window before it, and a
    request without events comes out when the watermark has passed it. The watermark is the slower
    side's, so neither side's delay loses a match. A hot image is split by time: the longest window is
    ``salts`` parts long, an event lies in one of them and a request visits those its window reaches,
    ``salts + 1``; the parts' counts are summed before they meet. The state holds that many copies of a
    request, so more parts spread a hot image further and cost more.

    ``requests``: (request_id, image_id, trigger, ts); ``events``: (image_id, kind, ts).
    """
    reach = max(params.serving_seconds.values())
    width = -(-reach * MICROS // salts)

    def part_of(micros: Column) -> Column:
        return micros - F.pmod(micros, F.lit(width))

    at = F.unix_micros("ts")
    visited = F.sequence(part_of(at - reach * MICROS), part_of(at), F.lit(width).cast("bigint"))
    asked = (
        accepted_requests(requests)
        .withWatermark("ts", late)
        .select("request_id", "image_id", "trigger", "ts", F.explode(visited).alias("part"))
    )
    seen = (
        events.filter(F.col("image_id").isNotNull() & F.col("kind").isin(*KINDS))
        .withWatermark("ts", late)
        .select(
            F.col("image_id").alias("__image"),
            "kind",
            F.col("ts").alias("__ts"),
            part_of(at).alias("__part"),
        )
    )
    reached = F.expr(f"__ts <= ts AND __ts >= ts - INTERVAL {reach} SECONDS")
    joined = asked.join(
        seen, (F.col("image_id") == F.col("__image")) & (F.col("part") == F.col("__part")) & reached, "leftOuter"
    )
    age = F.unix_micros("ts") - F.unix_micros("__ts")
    counts = [
        F.count_if((F.col("kind") == k) & (age <= seconds * 1_000_000)).alias(f"{k}s_{name}")
        for k in KINDS
        for name, seconds in params.serving_seconds.items()
    ]
    return joined.groupBy("request_id", "image_id", "trigger", "ts").agg(*counts)
