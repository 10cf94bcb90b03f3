"""Event sources: Kafka where the connector is present, files with the same messages elsewhere."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators.messages import decode, with_event_time
from crowdpulse.params import REQUEST_TOPIC
from crowdpulse.schemas import LANDED, REQUEST


def _kafka_columns(records: DataFrame) -> DataFrame:
    """Topic, text and arrival of Kafka records."""
    arrival = F.struct(F.col("timestamp").alias("arrived_at"), "partition", "offset")
    return records.select("topic", F.col("value").cast("string").alias("value"), arrival.alias("arrival"))


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting: str = "earliest",
    per_trigger: int | None = None,
    fail_on_loss: bool = True,
) -> DataFrame:
    """Messages of several topics as a stream, from the earliest unless a checkpoint says otherwise.

    A checkpoint that points to what the broker has no longer is an error; without ``fail_on_loss``
    the stream goes on with what there is.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_loss).lower())
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return _kafka_columns(reader.load())


def kafka_range(spark: SparkSession, servers: str, starting: dict, ending: dict) -> DataFrame:
    """A bounded read between two offset maps {topic: {partition: offset}}."""
    return _kafka_columns(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(starting))
        .option("startingOffsets", json.dumps(starting))
        .option("endingOffsets", json.dumps(ending))
        .load()
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages from text files below ``path``, one JSON object per line; new files are new data.

    Text has no offsets: a line arrives with its file, and lines of one file are told apart by
    a hash, in no order of their own.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.lit(0).alias("partition"),
        F.xxhash64("value").alias("offset"),
    )
    return reader.load(path).select("value", arrival.alias("arrival"))


def landed_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages landed as Parquet with topic and arrival, as a broker's archive keeps them."""
    reader = spark.readStream.schema(LANDED)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def events_of(messages: DataFrame, stamp_missing: bool = True) -> DataFrame:
    """Decoded messages with event time.

    A message without time text takes the ingest time (stream rule) or, with
    ``stamp_missing=False``, keeps a null time and is skipped later (batch rule).
    """
    ingest = F.current_timestamp() if stamp_missing else None
    return with_event_time(decode(messages), ingest)


def kafka_requests(spark: SparkSession, servers: str) -> DataFrame:
    """Scoring requests from now on."""
    return requests_of(kafka_messages(spark, servers, [REQUEST_TOPIC], starting="latest"))


def requests_of(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decoded requests: image, trigger, context, ``ts`` from the epoch seconds, and where they arrived if known."""
    r = F.from_json(F.col(value), REQUEST, {"mode": "PERMISSIVE"})
    came = ["arrival"] if "arrival" in messages.columns else []
    return messages.select(r.alias("r"), *came).select(
        "r.image_id",
        "r.trigger",
        "r.context",
        F.timestamp_micros(F.round(F.col("r.timestamp") * 1e6).cast("bigint")).alias("ts"),
        *came,
    )
