"""Stored running counts per image and minute, read by as-of lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from crowdpulse.operators.sequences import MICROS, latest_values, sums_before
from crowdpulse.params import EngagementParams
from crowdpulse.streaming.buckets import BucketTable

KINDS = ("view", "comment", "flag")
MINUTE = 60 * MICROS
SUMS = [f"upto_{k}s" for k in KINDS]
TABLE = StructType(
    [StructField("image_id", StringType()), StructField("run", LongType()), StructField("minute", LongType())]
    + [StructField(n, LongType()) for n in SUMS]
)
EDGES = StructType(
    [StructField("image_id", StringType()), StructField("kind", StringType()), StructField("us", LongType())]
)


def _minute(us: Column) -> Column:
    return us - F.pmod(us, F.lit(MINUTE))


class PrefixSums:
    """Per image and minute the number of events of each kind up to the minute's end, in runs.

    Every batch adds a run over its own events, whatever their times, so late events change nothing
    stored; a fold merges the runs of a bucket into one. The count of a window (t-W, t] or [t-W, t]
    is the running count before the minute of t less the one before the minute of t-W, plus events of
    these two minutes: two lookups and two minutes of events, not the history. ``events`` keeps the
    events by day, so that only the days of the asked minutes are read.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, fold_every: int = 8):
        self.spark = spark
        self.sums = BucketTable(spark, f"{root}/sums", TABLE, "image_id", buckets, fold_every)
        self.events_path = f"{root}/events"

    def add(self, events: DataFrame, batch_id: int) -> None:
        """(image_id, kind, ts) of one batch; adding a batch again replaces it."""
        known = events.filter(F.col("image_id").isNotNull() & F.col("ts").isNotNull() & F.col("kind").isin(*KINDS))
        us = F.unix_micros("ts")
        rows = known.select(F.col("image_id").cast("string").alias("image_id"), "kind", us.alias("us"))
        placed = rows.withColumns({"day": F.to_date(F.timestamp_micros("us")), "batch_id": F.lit(batch_id)})
        (
            placed.hint("rebalance", "day")
            .sortWithinPartitions("day", "us")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch_id")
            .parquet(self.events_path)
        )
        counts = rows.groupBy("image_id", _minute(F.col("us")).alias("minute")).agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS]
        )
        self.sums.write(self._running(counts).withColumn("run", F.lit(batch_id).cast("bigint")), batch_id)
        self.sums.fold(batch_id + 1, self.sums.touched(batch_id), self._merged)

    def _running(self, counts: DataFrame) -> DataFrame:
        """Running counts up to each minute's end, of (image_id, minute, n_*)."""
        rows = counts.withColumnRenamed("minute", "__b")
        before = sums_before(rows, ["image_id"], {f"__u_{k}": F.col(f"n_{k}") for k in KINDS})
        upto = [(F.col(f"__u_{k}") + F.col(f"n_{k}")).alias(f"upto_{k}s") for k in KINDS]
        return before.select("image_id", F.col("__b").alias("minute"), *upto)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """Several runs as one: at each of their minutes the runs' latest counts together."""
        minutes = rows.select("image_id", "minute").distinct()
        total = self._at(rows, minutes.withColumn("before", F.col("minute") + MINUTE))
        return total.select("image_id", F.lit(-1).cast("bigint").alias("run"), "minute", *SUMS)

    def _at(self, rows: DataFrame, probes: DataFrame) -> DataFrame:
        """Probes (image_id, before, ...) with the counts up to the last minute that starts before ``before``."""
        runs = rows.select("image_id", "run").distinct()
        key = F.concat_ws("#", "image_id", "run").alias("__key")
        facts = rows.select(
            key, F.timestamp_micros("minute").alias("__at"), F.struct(*SUMS).alias("__sums"), F.lit(1).alias("__probe")
        )
        # At equal time the probe comes first: its own minute does not count.
        asked = probes.join(runs, "image_id").select(
            key, *probes.columns, F.timestamp_micros("before").alias("__at"), F.lit(0).alias("__probe")
        )
        found = latest_values(
            facts.unionByName(asked, allowMissingColumns=True),
            key="__key",
            ts=F.col("__at"),
            order="__probe",
            values={"sums": F.col("__sums")},
            bucket_seconds=86_400,
        ).filter("__probe = 0")
        totals = [F.sum(F.coalesce(f"sums.{n}", F.lit(0))).alias(n) for n in SUMS]
        return found.groupBy(*probes.columns).agg(*totals)

    def counts_at(self, requests: DataFrame, params: EngagementParams) -> DataFrame:
        """Requests (request_id, image_id, ts, ...) with window counts over [t-W, t] and totals up to t."""
        asked = requests.withColumns({"__image": F.col("image_id").cast("string"), "__t": F.unix_micros("ts")})
        # One probe per edge: everything before t-W, and everything up to t.
        edges = [("now", F.col("__t"))] + [(n, F.col("__t") - s * MICROS) for n, s in params.serving_seconds.items()]
        edge = F.explode(F.array(*[F.struct(F.lit(n).alias("edge"), c.alias("us")) for n, c in edges]))
        probes = asked.select(F.col("__image").alias("image_id"), "request_id", edge.alias("e")).select(
            "image_id", "request_id", "e.*"
        )
        probes = probes.withColumn("before", _minute(F.col("us")))
        wanted = probes.select("image_id").distinct()
        sums = self.sums.current().join(wanted, "image_id", "left_semi")
        stored = self._at(sums, probes)
        minutes = self._edge_events(probes)
        own = [F.count_if(F.col("kind") == k).alias(f"own_{k}s") for k in KINDS]
        inside = (F.col("us") < F.col("__edge")) | ((F.col("edge") == "now") & (F.col("us") == F.col("__edge")))
        edge_counts = minutes.filter(inside).groupBy("request_id", "edge").agg(*own)
        both = probes.select("request_id", "edge").join(
            stored.select("request_id", "edge", *SUMS), ["request_id", "edge"], "left"
        ).join(edge_counts, ["request_id", "edge"], "left")

        def upto(edge: str, kind: str) -> Column:
            n = F.coalesce(f"upto_{kind}s", F.lit(0)) + F.coalesce(f"own_{kind}s", F.lit(0))
            return F.sum(F.when(F.col("edge") == edge, n))

        counts = [
            (upto("now", k) - upto(n, k)).alias(f"{k}s_{n}") for k in KINDS for n in params.serving_seconds
        ] + [upto("now", k).alias(f"total_{k}s") for k in KINDS]
        return requests.join(both.groupBy("request_id").agg(*counts), "request_id")

    def _edge_events(self, probes: DataFrame) -> DataFrame:
        """Events of the minutes the edges lie in, beside the edge; other days are pruned."""
        events = self.spark.read.schema(EDGES.add("day", "date").add("batch_id", "long")).parquet(self.events_path)
        edges = probes.select(
            "request_id",
            "edge",
            "image_id",
            F.col("us").alias("__edge"),
            F.col("before").alias("__minute"),
            F.to_date(F.timestamp_micros("us")).alias("day"),
        )
        minute = _minute(F.col("us"))
        return events.withColumn("__minute", minute).join(edges, ["image_id", "day", "__minute"])
