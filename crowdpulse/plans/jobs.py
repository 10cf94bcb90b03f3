"""The recurring jobs, end to end, over one root folder.

    raw/{table}/latest.parquet           extract_tables        daily
    windows/                             aggregate_events      hourly
    processed/*.parquet                  build_training_set    daily
    training/base=B/snapshot_id=N        build_training_set    daily
    models/{N}                           train                 on demand
    alerts/, metadata/, requests/        watch_activity        continuous
    moderation/                          score_requests        continuous
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crowdpulse.operators import governance, learning, quality, serving, training
from crowdpulse.operators import messages as event_messages
from crowdpulse.params import DEFAULT, EngagementParams
from crowdpulse.sources import sinks, streams, tables
from crowdpulse.streaming import activity, batches, scoring, windows
from crowdpulse.streaming.alerts import AlertJob

@dataclass(frozen=True)
class RelationalTable:
    """How to scan a table and how to append to it."""

    read: Callable[[], DataFrame]
    append: Callable[[DataFrame], None]


def jdbc_relation(spark: SparkSession, url: str, table: str, **options: str) -> RelationalTable:
    return RelationalTable(
        lambda: tables.jdbc_table(spark, url, table, **options),
        lambda rows: sinks.jdbc_append(rows, url, table, **options),
    )


RAW_TABLES = ("users", "images", "comments", "flags")


def extract_tables(read: Callable[[str], DataFrame], root: str) -> None:
    """Replace the raw copies; ``read`` gives a table by name (JDBC in production)."""
    for name in RAW_TABLES:
        sinks.overwrite_snapshot(read(name), root, name)


def aggregate_events(messages: DataFrame, root: str, params: EngagementParams = DEFAULT) -> StreamingQuery:
    """One bounded run from the checkpoint to the end of the topics at its start."""
    events = event_messages.observed(streams.events_of(messages, stamp_missing=False), "events")
    return batches.run_available(
        events, windows.window_writer(f"{root}/windows", params), f"{root}/checkpoints/windows"
    )


def build_training_set(
    spark: SparkSession, root: str, snapshot_id: int, params: EngagementParams = DEFAULT
) -> None:
    """Governed, labelled rows from the raw copies and the window table, appended as a snapshot."""
    raw = {t: tables.raw_snapshot(spark, root, t) for t in ("users", "images", "flags")}
    images = sinks.staged(
        governance.eligible_images(raw["images"], raw["users"], params.adult_age),
        f"{root}/processed/eligible_images.parquet",
    )
    flags = governance.eligible_actions(raw["flags"], raw["users"], params.adult_age)
    # Partial window rows need no merge here: the features sum them.
    counted = batches.read_batches(spark, f"{root}/windows")
    sinks.overwrite_processed(training.training_rows(images, counted, flags, params), root)
    processed = spark.read.parquet(f"{root}/processed/training_data.parquet")
    sinks.append_snapshot(processed, f"{root}/training", snapshot_id)


def remove_excluded(spark: SparkSession, root: str, excluded: DataFrame, snapshot_id: int) -> None:
    """Replace the training table by its rows without excluded images, as the next snapshot."""
    path = f"{root}/training"
    # Every snapshot is a full rebuild: only the current one's rows count.
    rows = tables.rows_of(spark, path, tables.current_snapshot(spark, path)).drop("snapshot_id")
    sinks.replace_snapshot(governance.without_excluded(rows, excluded), path, snapshot_id)


def verify(spark: SparkSession, path: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Profile (schema, rows, values) and the first rows of a table."""
    rows = spark.read.parquet(path)
    return quality.table_profile(rows), quality.first_rows(rows, order)


def train(spark: SparkSession, root: str, snapshot_id: int | None = None) -> PipelineModel:
    """Fit on the table as of a snapshot (by default the current one) and store the artefacts.

    Every snapshot is a full rebuild, so only its own rows count: an image that was withdrawn
    since an earlier snapshot is not learned from.
    """
    path = f"{root}/training"
    pinned = tables.current_snapshot(spark, path) if snapshot_id is None else snapshot_id
    rows = tables.rows_of(spark, path, pinned)
    model = learning.fit(rows)
    learning.save(model, learning.training_metadata(rows, pinned), f"{root}/models/{pinned}")
    return model


def watch_activity(
    spark: SparkSession,
    events: DataFrame,
    root: str,
    params: EngagementParams = DEFAULT,
    every: str | None = None,
    servers: str | None = None,
) -> tuple[AlertJob, StreamingQuery]:
    """All kinds of events: rolling counts, alerts, milestones, metadata of uploads, scoring requests.

    Requests go to Kafka, or below ``requests/`` as text. One bounded run, or a trigger interval.
    """
    job = AlertJob(spark, f"{root}/alerts", params)
    asks = activity.request_writer(servers=servers, message_path=f"{root}/requests")
    handler = activity.activity_writer(job, f"{root}/metadata", asks)
    events = event_messages.observed(events, "events")
    checkpoint = f"{root}/checkpoints/alerts"
    if every is None:
        return job, batches.run_available(events, handler, checkpoint)
    return job, batches.run_continuous(events, handler, checkpoint, every)


def score_requests(
    spark: SparkSession,
    requests: DataFrame,
    root: str,
    events: Callable[[], DataFrame],
    params: EngagementParams = DEFAULT,
    predictor: serving.Predictor | None = None,
    totals: Callable[[], DataFrame] | None = None,
    every: str | None = None,
    moderation: RelationalTable | None = None,
) -> StreamingQuery:
    """Score requests with the raw copies and ``events``, the activity as of each batch.

    With ``totals`` (lifetime counts per image as of each batch) the events are read one window
    back only. With ``moderation`` the decisions also go to that table, each once. One bounded
    run, or a trigger interval.
    """

    def current() -> scoring.ServingTables:
        images, users = (tables.raw_snapshot(spark, root, t) for t in ("images", "users"))
        return scoring.ServingTables(events(), images, users, totals() if totals else None)

    def store(rows: DataFrame, batch_id: int) -> None:
        sinks.append_absent(rows, moderation.read(), moderation.append, "inference_request_id", "created_at")

    kept = store if moderation is not None else None
    handler = scoring.scoring_writer(f"{root}/moderation", current, params, predictor, kept)
    checkpoint = f"{root}/checkpoints/moderation"
    if every is None:
        return batches.run_available(requests, handler, checkpoint)
    return batches.run_continuous(requests, handler, checkpoint, every)


def decisions(spark: SparkSession, root: str) -> DataFrame:
    return serving.decisions_by_trigger(batches.read_batches(spark, f"{root}/moderation"))
