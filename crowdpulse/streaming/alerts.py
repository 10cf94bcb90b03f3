"""Rolling counts, alerts and milestones on a stream.

The state is a set of tables in shared storage, in hash buckets of the image: the recent events,
view totals and alerts. A batch opens the buckets of its own images only, and a bucket is folded
now and then; folding the recent events drops those no window can reach any more. Each batch runs
the batch operators on its new events and the recent ones of their images, so a hot image is split by
time like there, a lost executor costs a task and a repeated batch replaces its own folders. No
key's state has to fit in one task.

Counts are exact at every event that comes up to ``late_seconds`` behind the newest event of its
image; a later one is counted, but neighbours of its own time may be gone already. ``idle_seconds``,
if given, also drops the events of an image nothing was heard of for so long, by time of arrival.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from crowdpulse.operators import alerts, messages
from crowdpulse.operators.sequences import MICROS, rolling_counts
from crowdpulse.params import EngagementParams
from crowdpulse.schemas import ARRIVAL
from crowdpulse.sources.sinks import append_batch, staged
from crowdpulse.streaming.batches import read_batches
from crowdpulse.streaming.buckets import BucketTable

KINDS = ("view", "comment", "flag")
EVENT = [
    StructField("image_id", StringType()),
    StructField("kind", StringType()),
    StructField("ts", TimestampType()),
    StructField("arrival", ARRIVAL),
]
RECENT = StructType([*EVENT, StructField("comment_id", StringType())])
TOTALS = StructType(
    [StructField("image_id", StringType()), *[StructField(f"total_{k}s", LongType()) for k in KINDS]]
)
ALERTS = StructType(
    [
        StructField("image_id", StringType()),
        StructField("alert_type", StringType()),
        StructField("ts", TimestampType()),
        StructField("arrival", ARRIVAL),
        StructField("metric", StringType()),
        StructField("value", LongType()),
    ]
)
MILESTONES = StructType(
    [
        StructField("image_id", StringType()),
        StructField("milestone_type", StringType()),
        StructField("milestone_value", LongType()),
        StructField("reached_at", TimestampType()),
        StructField("arrival", ARRIVAL),
    ]
)


def _sum_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("image_id").agg(*[F.sum(f"total_{k}s").alias(f"total_{k}s") for k in KINDS])


class AlertJob:
    """``handle`` is the foreachBatch function; the other members read its tables."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        params: EngagementParams,
        buckets: int = 16,
        fold_every: int = 8,
        late_seconds: int | None = None,
        idle_seconds: int | None = None,
    ):
        self.spark, self.root, self.params = spark, root, params
        self.reach = max(params.rolling_seconds.values())
        self.late = self.reach if late_seconds is None else late_seconds
        self.idle = idle_seconds
        windows = [StructField(f"{k}s_{w}", LongType()) for k in KINDS for w in params.rolling_seconds]
        self.counts_schema = StructType([*EVENT, *windows, StructField("new_views_total", LongType())])

        def table(name: str, schema: StructType) -> BucketTable:
            return BucketTable(spark, f"{root}/{name}", schema, "image_id", buckets, fold_every)

        self.recent = table("recent", RECENT)
        self.totals_table = table("totals", TOTALS)
        self.alerts_table = table("alerts", ALERTS)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        arrived = messages.valid(batch).filter(F.col("event_type").isin(*KINDS))
        self.recent.write(arrived.withColumnRenamed("event_type", "kind"), batch_id)
        buckets = self.recent.touched(batch_id)
        if not buckets:
            return
        self.recent.fold(batch_id, buckets, self._reachable)
        self.totals_table.fold(batch_id, buckets, _sum_totals)
        self.alerts_table.fold(batch_id, buckets, lambda rows: rows)

        new = self.recent.batch(batch_id)
        images = new.groupBy("image_id").agg(
            F.min("ts").alias("__first"),
            *[F.count_if(F.col("kind") == k).alias(f"total_{k}s") for k in KINDS],
        )
        # All steps below read them.
        images = staged(images, f"{self.root}/images")
        append_batch(self._counts(new, images, batch_id, buckets), f"{self.root}/counts", batch_id)
        counts = self.spark.read.schema(self.counts_schema).parquet(f"{self.root}/counts/batch_id={batch_id}")

        # Alerts, milestones and totals follow from the counts independently of each other.
        with ThreadPoolExecutor(3) as pool:
            steps = (self._write_alerts, self._write_milestones, self._write_totals)
            for done in [pool.submit(step, counts, images, batch_id, buckets) for step in steps]:
                done.result()

    def _write_alerts(self, counts: DataFrame, images: DataFrame, batch_id: int, buckets: list[int]) -> None:
        crossed = alerts.crossings(counts, self.params, order="arrival")
        known = self.alerts_table.before(batch_id, buckets).select("image_id", "alert_type")
        fresh = alerts.first_alerts(crossed, order="arrival").join(known, ["image_id", "alert_type"], "left_anti")
        self.alerts_table.write(fresh, batch_id)

    def _write_milestones(self, counts: DataFrame, images: DataFrame, batch_id: int, buckets: list[int]) -> None:
        stored = self.totals_table.before(batch_id, buckets).join(images, "image_id", "left_semi")
        prior = _sum_totals(stored)
        # Earlier views only add to a total, so a view beyond the last milestone in this batch is beyond it.
        seen = counts.filter((F.col("kind") == "view") & (F.col("new_views_total") <= max(self.params.milestones)))
        with_total = seen.join(prior, "image_id", "left").withColumn(
            "views_total", F.col("new_views_total") + F.coalesce("total_views", F.lit(0))
        )
        reached = alerts.milestones(with_total, self.params, order="arrival").withColumn(
            "milestone_value", F.col("milestone_value").cast("bigint")
        )
        append_batch(reached, f"{self.root}/milestones", batch_id)

    def _write_totals(self, counts: DataFrame, images: DataFrame, batch_id: int, buckets: list[int]) -> None:
        self.totals_table.write(images.drop("__first"), batch_id)

    def _reachable(self, rows: DataFrame) -> DataFrame:
        """Recent events without those that no window of an event in time can reach."""
        newest = rows.groupBy("image_id").agg(
            F.max("ts").alias("__newest"), F.max("arrival.arrived_at").alias("__heard")
        )
        gone = F.unix_micros("ts") <= F.unix_micros("__newest") - (self.reach + self.late) * MICROS
        if self.idle is not None:
            now = rows.agg(F.max("arrival.arrived_at").alias("__now"))
            newest = newest.join(now)  # one row
            gone = gone | (F.unix_micros("__heard") < F.unix_micros("__now") - self.idle * MICROS)
        return rows.join(newest, "image_id").filter(~gone).select(*RECENT.names)

    def _counts(self, new: DataFrame, images: DataFrame, batch_id: int, buckets: list[int]) -> DataFrame:
        """Exact rolling counts at the new events, from the new and the earlier ones."""
        # Of the earlier events only those of the batch's images, one window back.
        reach = F.unix_micros("__first") - self.reach * MICROS
        earlier = self.recent.before(batch_id, buckets).join(images.select("image_id", "__first"), "image_id")
        earlier = earlier.filter(F.unix_micros("ts") >= reach).select(*RECENT.names)
        rows = earlier.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
        # A comment delivered again counts once in windows; lifetime totals count every delivery.
        rows = messages.without_redelivered(rows, ["is_new", "arrival"]).select(*[f.name for f in EVENT], "is_new")
        # The counts read them twice.
        rows = staged(rows, f"{self.root}/reached")
        counts = rolling_counts(
            rows,
            key="image_id",
            ts=F.col("ts"),
            order=F.col("arrival"),
            measures={f"{k}s": F.col("kind") == k for k in KINDS},
            windows=self.params.rolling_seconds,
            totals={"new_views": F.col("is_new") & (F.col("kind") == "view")},
        )
        return counts.filter("is_new").drop("is_new")

    @property
    def alerts(self) -> DataFrame:
        return self.alerts_table.current()

    @property
    def counts(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/counts", self.counts_schema).select(*self.counts_schema.names)

    @property
    def milestones(self) -> DataFrame:
        return read_batches(self.spark, f"{self.root}/milestones", MILESTONES).select(*MILESTONES.names)

    @property
    def requests(self) -> DataFrame:
        return alerts.scoring_requests(self.alerts)

    def totals(self, next_batch: int) -> DataFrame:
        """Lifetime totals per image over all batches before ``next_batch``."""
        return _sum_totals(self.totals_table.before(next_batch))
