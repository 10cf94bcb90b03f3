"""Streaming window counts and lifetime totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators import counters, messages
from crowdpulse.params import EngagementParams
from crowdpulse.sources.sinks import append_batch
from crowdpulse.streaming.batches import Handler, read_batches


def window_writer(path: str, params: EngagementParams) -> Handler:
    """Append each batch's partial window counts, one folder per kind and day for pruned reads."""

    def write(batch: DataFrame, batch_id: int) -> None:
        events = messages.for_windows(batch, counters.KINDS)
        counts = counters.tumbling_counts(events, params.tumbling_seconds)
        dated = counters.processed_now(counts).withColumn("window_date", F.to_date("window_start"))
        append_batch(dated, path, batch_id, ["kind", "window_date"])

    return write


def final_windows(spark: SparkSession, path: str) -> DataFrame:
    """A window cut by a batch boundary has several partial rows; readers sum them."""
    return counters.merge_partials(read_batches(spark, path))


def running_totals(events: DataFrame) -> DataFrame:
    """Totals per image as streaming state (use output mode ``update``)."""
    return (
        events.groupBy("image_id")
        .agg(*[F.count_if(F.col("event_type") == k).alias(f"total_{k}s") for k in counters.KINDS])
    )


def totals_writer(path: str) -> Handler:
    """Write the totals that changed in each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id)

    return write


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The last written totals of each image."""
    rows = read_batches(spark, path)
    names = [f"total_{k}s" for k in counters.KINDS]
    return (
        rows.groupBy("image_id")
        .agg(F.max(F.struct("batch_id", *names)).alias("t"))
        .select("image_id", *[f"t.{n}" for n in names])
    )


def sliding_counts(events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Overlapping windows with a watermark: the approximate, state-only form of the rolling counts."""
    return (
        events.withWatermark("ts", late)
        .groupBy("image_id", F.window("ts", size, slide))
        .agg(*[F.count_if(F.col("event_type") == k).alias(f"{k}s") for k in counters.KINDS])
    )
