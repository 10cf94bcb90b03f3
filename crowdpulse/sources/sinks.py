"""Sinks. Appends are by batch or snapshot folder, so a repeated batch replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.schemas import LANDED
from crowdpulse.sources.tables import base_of


def publish(messages: DataFrame, *, servers: str | None = None, path: str | None = None) -> None:
    """(topic, value) messages to Kafka, or as text files per topic.

    Messages of unknown kind have no topic and are not sent; ``messages.rejected`` has them.
    """
    messages = messages.filter(F.col("topic").isNotNull()).select("topic", "value")
    if servers:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "1")
            .option("kafka.compression.type", "gzip")
            .save()
        )
    else:
        messages.write.mode("append").partitionBy("topic").text(path)


def send_batch(messages: DataFrame, batch_id: int, *, servers: str | None = None, path: str | None = None) -> None:
    """Send the messages of one batch. As text they have a folder per batch: sent again, they replace it."""
    if servers:
        publish(messages, servers=servers)
    else:
        messages.write.mode("overwrite").partitionBy("topic").text(f"{path}/batch_id={batch_id}")


def land(messages: DataFrame, path: str) -> None:
    """(topic, value, arrival) messages as Parquet, next to those already there."""
    messages.select(*LANDED.names).write.mode("append").parquet(path)


def overwrite_snapshot(rows: DataFrame, root: str, table: str) -> None:
    """The raw copy of a relational table; the previous copy is replaced."""
    rows.write.mode("overwrite").parquet(f"{root}/raw/{table}/latest.parquet")


def overwrite_processed(rows: DataFrame, root: str) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/processed/training_data.parquet")


def staged(rows: DataFrame, path: str) -> DataFrame:
    """Write rows that several branches of a plan read, and read them back."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append_batch(rows: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Write one micro-batch. Writing the same batch again leaves the same table.

    With ``partition_by`` the rows are rebalanced first: files of even size, few
    per folder, and a hot folder is split over several tasks.
    """
    target = f"{path}/batch_id={batch_id}"
    if partition_by:
        rows.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").partitionBy(
            *partition_by
        ).parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)


def append_snapshot(rows: DataFrame, path: str, snapshot_id: int) -> None:
    """Add rows as the next snapshot; readers pinned to an earlier one do not see them."""
    base = base_of(rows.sparkSession, path)
    rows.write.mode("overwrite").parquet(f"{path}/base={base}/snapshot_id={snapshot_id}")


def replace_snapshot(rows: DataFrame, path: str, snapshot_id: int) -> None:
    """Make rows the whole table from this snapshot on; earlier snapshots stay readable."""
    rows.write.mode("overwrite").parquet(f"{path}/base={snapshot_id}/snapshot_id={snapshot_id}")


def append_table(spark: SparkSession, rows: DataFrame, table: str, provider: str = "parquet") -> None:
    """Append to a catalog table by column name; namespace and table are created when absent.

    No rows create no table. A column the table lacks, or one the rows lack, is an error.
    """
    if "." in table:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if spark.catalog.tableExists(table):
        names = spark.table(table).columns
        if sorted(names) != sorted(rows.columns):
            raise ValueError(f"{table} has columns {names}, the rows {rows.columns}")
        # insertInto goes by position.
        rows = rows.select(*names)
        rows.write.insertInto(table) if provider == "parquet" else rows.writeTo(table).append()
    elif not rows.isEmpty():
        rows.write.format(provider).saveAsTable(table)


def jdbc_append(rows: DataFrame, url: str, table: str, **options: str) -> None:
    rows.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(
        **options
    ).save()


def append_absent(
    rows: DataFrame, stored: DataFrame, append: Callable[[DataFrame], None], key: str, at: str
) -> None:
    """Append the rows whose ``key`` a relational table has not got yet, so that a repeated batch adds none.

    ``stored`` is a scan of the table. Only its rows from the earliest ``at`` on are read (the filter
    goes to the database), so ``at`` must be the same whenever a row is written again. ``rows`` is
    read twice and should be a written batch. Rows without key or time can't be found again: an error.
    """
    unnamed = F.col(key).isNull() | F.col(at).isNull()
    first, broken = rows.agg(F.min(F.unix_micros(at)), F.count_if(unnamed)).first()
    if broken:
        raise ValueError(f"{broken} rows without {key} or {at}")
    if first is not None:
        known = stored.filter(F.col(at) >= F.timestamp_micros(F.lit(first))).select(key)
        append(rows.join(known, key, "left_anti").select(*rows.columns))


def with_row_ids(rows: DataFrame, column: str = "id") -> DataFrame:
    """Random ids for new rows. Ids change when a task is run again, so write them once."""
    return rows.withColumn(column, F.uuid())
