"""Streaming upserts: accounts, image metadata, and rows written with their events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crowdpulse.operators import entities
from crowdpulse.schemas import ARRIVAL
from crowdpulse.sources.sinks import append_batch, send_batch
from crowdpulse.streaming.batches import Handler
from crowdpulse.streaming.buckets import BucketTable


METADATA = StructType(
    [
        StructField("image_id", StringType()),
        StructField("arrival", ARRIVAL),
        StructField("category", StringType()),
        StructField("caption_length", StringType()),
        StructField("uploaded_at", StringType()),
        StructField("user_id", StringType()),
    ]
)


def metadata_table(spark: SparkSession, path: str, buckets: int = 16) -> BucketTable:
    return BucketTable(spark, path, METADATA, "image_id", buckets, fold_every=1)


def metadata_writer(path: str, buckets: int = 16) -> Handler:
    """Keep the last metadata of each uploaded image: the buckets a batch names are rewritten, no other.

    A bucket's new files replace its old ones as a whole; readers that began before still find those.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = metadata_table(batch.sparkSession, path, buckets)
        uploads = batch.filter(F.col("event_type") == "upload")
        table.write(entities.latest_metadata(uploads, F.current_timestamp()), batch_id)
        table.fold(batch_id + 1, table.touched(batch_id), _last_metadata)

    return write


def _last_metadata(rows: DataFrame) -> DataFrame:
    return entities.last_per_key(rows, "image_id", "arrival")


def latest_metadata(spark: SparkSession, path: str, buckets: int = 16) -> DataFrame:
    """The last write of each image: every bucket is folded, so nothing is left to merge."""
    return metadata_table(spark, path, buckets).current()


def account_writer(path: str, existing: DataFrame, order: str = "arrival", buckets: int = 16) -> Handler:
    """Append accounts for usernames that neither ``existing`` nor an earlier batch has.

    Of the earlier batches only the buckets of the asked names are read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = BucketTable(batch.sparkSession, path, batch.schema, "username", buckets)
        asked = [r.bucket for r in batch.select(table.bucket().alias("bucket")).distinct().collect()]
        table.fold(batch_id, asked, lambda rows: rows)
        known = existing.select("username").unionByName(table.before(batch_id, asked).select("username"))
        table.write(entities.users_to_create(batch, known, order), batch_id)

    return write


def created_accounts(spark: SparkSession, path: str, schema: StructType, buckets: int = 16) -> DataFrame:
    return BucketTable(spark, path, schema, "username", buckets).current()


def dual_writer(
    path: str,
    shape: Callable[[DataFrame], DataFrame],
    *,
    servers: str | None = None,
    message_path: str | None = None,
) -> Handler:
    """Write each batch to a table and send it as messages, to Kafka or as text files.

    The messages are made from the rows as stored, so generated ids and times are
    the same in both, and a batch that fails in between is written again whole.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/batch_id={batch_id}")
        send_batch(shape(stored), batch_id, servers=servers, path=message_path)

    return write
