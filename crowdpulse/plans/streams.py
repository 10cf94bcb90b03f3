"""Streaming queries: the events land in three slices, one bounded run after each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions import times
from crowdpulse.operators import counters, governance, messages, serving
from crowdpulse.params import REQUEST_TOPIC, SCALED
from crowdpulse.plans import risk_at_upload
from crowdpulse.session import run_dir
from crowdpulse.sources import domain, streams
from crowdpulse.sources.sinks import land, staged
from crowdpulse.streaming import activity, batches, entities, joins, learning, prefix, scoring, statistics, windows
from crowdpulse.streaming.alerts import AlertJob

RUNS = 3


def _event_messages(events: DataFrame) -> DataFrame:
    """(event_id, image_id, kind, ts) as JSON messages that arrived in order of the id, over three partitions.

    ``sent_as``, where given, is the place of another delivery of the event.
    """
    clock = times.iso(F.col("ts"))
    is_view = F.col("kind") == "view"
    shaped = events.select(
        _arrival(F.col("sent_as" if "sent_as" in events.columns else "event_id")),
        F.col("kind").alias("event_type"),
        F.col("image_id").cast("string").alias("image_id"),
        F.when(F.col("kind") == "comment", F.col("event_id").cast("string")).alias("comment_id"),
        F.when(is_view, clock).alias("viewed_at"),
        F.when(~is_view, F.concat(clock, F.lit("Z"))).alias("created_at"),
    )
    return messages.encode(shaped, messages.topic_of(F.col("event_type")), shaped.columns[1:], ("arrival",))


def _upload_messages(uploads: DataFrame) -> DataFrame:
    """Rows of ``domain.upload_rows``, with a ``ts`` that isn't sent, as messages in order of ``seq``."""
    sent = uploads.withColumn("event_type", F.lit("upload")).withColumn("arrival", _arrival(F.col("seq")))
    body = [c for c in sent.columns if c not in ("ts", "seq", "arrival")]
    return messages.encode(sent, messages.topic_of(F.col("event_type")), body, ("arrival",))


def _arrival(number: Column) -> Column:
    return F.struct(
        F.timestamp_micros(number.cast("bigint")).alias("arrived_at"),
        (number % 3).cast("int").alias("partition"),
        number.cast("bigint").alias("offset"),
    ).alias("arrival")


def _slices(rows: DataFrame) -> list[DataFrame]:
    """Time thirds of the rows; the two ends are the only values that reach the driver."""
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    step = (last - first) // RUNS + 1
    number = F.floor((F.unix_micros("ts") - first) / step)
    return [rows.filter(number == i) for i in range(RUNS)]


def _user_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity keyed by user, the dense key of the test data."""
    return domain.events(spark, sf_dir, counters.KINDS).select(
        "event_id", F.col("user_id").alias("image_id"), "kind", "ts"
    )


def _run_slices(spark: SparkSession, rows: DataFrame, encode, start) -> None:
    """Land each slice below a fresh folder and call ``start(folder)`` for a bounded run."""
    source = run_dir(spark, "messages")
    for part in _slices(rows):
        land(encode(part), source)
        start(source)


def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts of the batch job; every seventh comment comes without its id."""
    out = run_dir(spark, "windows")

    def encode(part: DataFrame) -> DataFrame:
        nameless = F.regexp_replace("value", r'"comment_id":"[0-9]*"', '"comment_id":null')
        sent = _event_messages(part)
        return sent.withColumn("value", F.when(F.col("arrival.offset") % 7 == 0, nameless).otherwise(F.col("value")))

    def start(source: str) -> None:
        # The batch rule: a message without time is skipped, not stamped.
        events = streams.events_of(streams.landed_messages(spark, source), stamp_missing=False)
        batches.run_available(events, windows.window_writer(f"{out}/table", SCALED), f"{out}/checkpoint")

    _run_slices(spark, domain.signals(spark, sf_dir), encode, start)
    return windows.final_windows(spark, f"{out}/table").select(
        "kind",
        F.col("image_id").cast("bigint").alias("image_id"),
        times.iso(F.col("window_start")).alias("window_start"),
        times.iso(F.col("window_end")).alias("window_end"),
        "event_count",
    )


def stream_lifetime_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "totals")

    def start(source: str) -> None:
        events = messages.valid(streams.events_of(streams.landed_messages(spark, source)))
        batches.run_available(
            windows.running_totals(events), windows.totals_writer(f"{out}/table"), f"{out}/checkpoint", "update"
        )

    _run_slices(spark, domain.signals(spark, sf_dir), _event_messages, start)
    return windows.latest_totals(spark, f"{out}/table").withColumn(
        "image_id", F.col("image_id").cast("bigint")
    )


def _alert_job(spark: SparkSession, sf_dir: str, encode: Callable[[DataFrame], DataFrame] = _event_messages) -> AlertJob:
    out = run_dir(spark, "alerts")
    job = AlertJob(spark, f"{out}/tables", SCALED)

    def start(source: str) -> None:
        events = streams.events_of(streams.landed_messages(spark, source))
        batches.run_available(events, job.handle, f"{out}/checkpoint")

    _run_slices(spark, _user_signals(spark, sf_dir), encode, start)
    return job


def stream_rolling_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts_of(_alert_job(spark, sf_dir))


def stream_redelivered_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts where every fifth comment is delivered again with the next slice."""
    before: list[DataFrame] = []

    def encode(part: DataFrame) -> DataFrame:
        again = [p.filter((F.col("kind") == "comment") & (F.col("event_id") % 5 == 0)) for p in before]
        before[:] = [part]
        own = part.withColumn("sent_as", F.col("event_id"))
        for p in again:
            own = own.unionByName(p.withColumn("sent_as", F.col("event_id") + 1_000_000_000))
        return _event_messages(own)

    return _alerts_of(_alert_job(spark, sf_dir, encode))


def stream_alert_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as the job for all kinds of events sends them; uploads come with the first slice."""
    out = run_dir(spark, "activity")
    job = AlertJob(spark, f"{out}/tables", SCALED)
    sends = activity.request_writer(message_path=f"{out}/requests")
    handler = activity.activity_writer(job, f"{out}/metadata", sends)
    uploads = [domain.upload_rows(spark, sf_dir).withColumn("ts", F.lit(None).cast("timestamp"))]

    def encode(part: DataFrame) -> DataFrame:
        own = _event_messages(part)
        return own.unionByName(_upload_messages(uploads.pop())) if uploads else own

    def start(source: str) -> None:
        events = streams.events_of(streams.landed_messages(spark, source))
        batches.run_available(events, handler, f"{out}/checkpoint")

    _run_slices(spark, _user_signals(spark, sf_dir), encode, start)
    sent = spark.read.schema("value string, topic string").text(f"{out}/requests")
    return streams.requests_of(sent.filter(F.col("topic") == REQUEST_TOPIC)).select(
        F.col("image_id").cast("bigint").alias("image_id"),
        "trigger",
        F.map_keys("context")[0].alias("metric"),
        F.map_values("context")[0].cast("bigint").alias("value"),
        F.unix_micros("ts").alias("epoch_us"),
    )


def _alerts_of(job: AlertJob) -> DataFrame:
    return job.alerts.select(
        F.col("image_id").cast("bigint").alias("user_id"),
        "alert_type",
        F.col("arrival.offset").alias("event_id"),
        times.iso(F.col("ts")).alias("ts"),
        "metric",
        "value",
    )


def stream_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_job(spark, sf_dir).milestones.select(
        F.col("image_id").cast("bigint").alias("user_id"),
        "milestone_type",
        "milestone_value",
        F.col("arrival.offset").alias("event_id"),
        times.iso(F.col("reached_at")).alias("reached_at"),
    )


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "scoring")
    events = governance.stable_ids(domain.signals(spark, sf_dir), ["image_id"])
    images = governance.stable_ids(domain.images(spark, sf_dir), ["id", "user_id"])
    users = governance.stable_ids(domain.users(spark, sf_dir), ["id"])
    tables = scoring.ServingTables(events, images, users)
    handler = scoring.scoring_writer(f"{out}/table", lambda: tables, SCALED)

    def encode(part: DataFrame) -> DataFrame:
        shaped = part.select(
            F.col("image_id").cast("string").alias("image_id"),
            "trigger",
            times.epoch_seconds(F.col("ts")).alias("timestamp"),
            _arrival(F.pmod(F.xxhash64("image_id", "trigger", "ts"), F.lit(10**15))),
        )
        return messages.encode(shaped, F.lit(REQUEST_TOPIC), shaped.columns[:-1], ("arrival",))

    def start(source: str) -> None:
        asked = streams.requests_of(streams.landed_messages(spark, source))
        batches.run_available(asked, handler, f"{out}/checkpoint")

    _run_slices(spark, domain.requests(spark, sf_dir), encode, start)
    return batches.read_batches(spark, f"{out}/table").select(
        F.col("target_id").cast("bigint").alias("image_id"),
        "trigger_type",
        "risk_score",
        "inference_mode",
        times.iso(F.col("created_at")).alias("created_at"),
    )


def stream_request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts at each scoring request: a join of the request stream with the event stream.

    A last request and event far behind the data move the watermark past all of it.
    """
    out, asked_at, seen_at = (run_dir(spark, n) for n in ("request-counts", "asked", "seen"))
    requests = domain.requests(spark, sf_dir).select("request_id", "image_id", "trigger", "ts")
    events = domain.signals(spark, sf_dir).select("image_id", "kind", "ts")
    parts = list(zip(_slices(requests), _slices(events)))
    last = events.agg(F.max("ts").alias("ts"))
    for days in (40, 80):
        ts = (F.col("ts") + F.make_dt_interval(F.lit(days))).alias("ts")
        closing = last.select(F.lit(-1).cast("bigint").alias("image_id"), F.lit("view").alias("kind"), ts)
        parts.append((closing.select(F.lit(-1).cast("bigint").alias("request_id"), "image_id", F.lit("close").alias("trigger"), "ts"), closing))
    for asked, seen in parts:
        asked.write.mode("append").parquet(asked_at)
        seen.write.mode("append").parquet(seen_at)
        counted = joins.request_counts(
            spark.readStream.schema(requests.schema).parquet(asked_at),
            spark.readStream.schema(events.schema).parquet(seen_at),
            SCALED,
            late="2 days",
        )
        batches.run_available(counted, windows.totals_writer(f"{out}/table"), f"{out}/checkpoint")
    rows = batches.read_batches(spark, f"{out}/table")
    return rows.filter("request_id >= 0").drop("ts", "batch_id")


def features_from_prefix_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts and totals at each request from stored running counts, kept up over three batches."""
    table = prefix.PrefixSums(spark, run_dir(spark, "prefix-sums"), buckets=4, fold_every=2)
    events = domain.signals(spark, sf_dir).select("image_id", "kind", "ts")
    for n, part in enumerate(_slices(events)):
        table.add(part, n)
    requests = serving.accepted_requests(domain.requests(spark, sf_dir))
    return table.counts_at(requests, SCALED).drop("ts")


def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches and rows of the window job as its listener reports them, over three runs."""
    out = run_dir(spark, "statistics")
    listener = statistics.StreamStatistics(spark, f"{out}/statistics")
    spark.streams.addListener(listener)
    name = "windows-" + out.rsplit("-", 1)[-1]
    try:

        def start(source: str) -> None:
            events = streams.events_of(streams.landed_messages(spark, source), stamp_missing=False)
            batches.run_available(
                events, windows.window_writer(f"{out}/table", SCALED), f"{out}/checkpoint", name=name
            )

        _run_slices(spark, domain.signals(spark, sf_dir), _event_messages, start)
        listener.wait_for(name, RUNS)
    finally:
        spark.streams.removeListener(listener)
    own = listener.rows().filter(F.col("name") == name)
    return statistics.batch_counts(own).select(F.lit("windows").alias("query"), "batches", "rows")


def model_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model learned in one pass over five batches of training rows, stopped once and resumed."""
    path = run_dir(spark, "incremental")
    rows = staged(risk_at_upload.training_set(spark, sf_dir), f"{path}/rows")
    part = F.pmod(F.xxhash64("image_id"), F.lit(5))
    for n in range(5):
        learner = learning.IncrementalLearner(spark, f"{path}/weights")  # a new one knows only what is stored
        learner.handle(rows.filter(part == n), n)
    return learning.IncrementalLearner(spark, f"{path}/weights").predictor()(rows).select(
        "image_id", F.col("decision_point_minutes").cast("bigint").alias("decision_point_minutes"), "moderation_probability"
    )


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image metadata kept by rewriting the buckets of each batch; late batches name few images."""
    out = run_dir(spark, "upsert")
    rows = domain.upload_rows(spark, sf_dir)
    resent = F.col("seq") >= 1_000_000_000
    write = entities.metadata_writer(f"{out}/table", buckets=8)
    shaped = rows.select("*", F.lit("upload").alias("event_type"), _arrival(F.col("seq")))
    parts = [shaped.filter(~resent), *(shaped.filter(resent & (F.col("seq") % 4 == k)) for k in range(4))]
    for n, part in enumerate(parts):
        write(part, n)
    stored = entities.latest_metadata(spark, f"{out}/table", buckets=8)
    return stored.withColumn("seq", F.col("arrival.offset")).drop("arrival")


def stream_upload_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stored metadata of every image; every third image is sent twice."""
    return _stored_metadata(spark, sf_dir, "Soup")


def stream_upload_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the later category comes first in the alphabet."""
    return _stored_metadata(spark, sf_dir, "Bread")


def _stored_metadata(spark: SparkSession, sf_dir: str, later: str) -> DataFrame:
    out = run_dir(spark, "metadata")

    def start(source: str) -> None:
        uploads = messages.decode(streams.landed_messages(spark, source))
        batches.run_available(uploads, entities.metadata_writer(f"{out}/table"), f"{out}/checkpoint")

    rows = domain.upload_rows(spark, sf_dir).withColumn("ts", F.col("uploaded_at").cast("timestamp"))
    resent = F.col("seq") >= 1_000_000_000
    rows = rows.withColumn("category", F.when(resent, later).otherwise(F.col("category")))
    _run_slices(spark, rows, _upload_messages, start)
    stored = entities.latest_metadata(spark, f"{out}/table")
    return stored.withColumn("seq", F.col("arrival.offset")).drop("arrival")


def stream_users_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts created for requested names, once per name over all runs."""
    out = run_dir(spark, "accounts")
    existing = domain.users(spark, sf_dir)
    source = run_dir(spark, "account-requests")
    handler = entities.account_writer(f"{out}/table", existing)
    asked = domain.account_requests(spark, sf_dir)
    for part in _slices(asked):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(asked.schema).parquet(source)
        batches.run_available(stream, handler, f"{out}/checkpoint")
    return entities.created_accounts(spark, f"{out}/table", asked.schema).select("username", "id")


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-day windows every day with a watermark, last state of each window."""
    out = run_dir(spark, "sliding")

    def start(source: str) -> None:
        events = messages.valid(streams.events_of(streams.landed_messages(spark, source)))
        counts = windows.sliding_counts(events, "2 days", "1 day").withColumn("window_start", F.col("window.start"))
        batches.run_available(
            counts.drop("window"), windows.totals_writer(f"{out}/table"), f"{out}/checkpoint", "update"
        )

    _run_slices(spark, _user_signals(spark, sf_dir), _event_messages, start)
    names = [f"{k}s" for k in counters.KINDS]
    return (
        batches.read_batches(spark, f"{out}/table")
        .groupBy("image_id", "window_start")
        .agg(F.max(F.struct("batch_id", *names)).alias("t"))
        .select(
            F.col("image_id").cast("bigint").alias("user_id"),
            times.iso(F.col("window_start")).alias("window_start"),
            *[f"t.{n}" for n in names],
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_tumbling_counts,
        stream_lifetime_totals,
        stream_rolling_alerts,
        stream_redelivered_alerts,
        stream_alert_requests,
        stream_milestones,
        stream_scoring,
        stream_request_counts,
        features_from_prefix_sums,
        upsert_buckets,
        stream_statistics,
        model_incremental,
        stream_upload_metadata,
        stream_upload_last_write,
        stream_users_created,
        stream_sliding_counts,
    )
}
