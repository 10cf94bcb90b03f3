"""Statistics of running streams as a table: rows and time of every batch and stage."""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from crowdpulse.sources.sinks import append_batch

ROWS = "name string, run_id string, batch_id long, rows long, started string, stage string, millis long"


class StreamStatistics(StreamingQueryListener):
    """Listens to the session's queries and writes what they report, one row per batch and stage.

    Reports are kept until ``flush`` writes them (call it after a bounded run, or now and then beside
    a continuous one); one report is a few rows, however much data the batch had.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.lock, self.waiting, self.written = threading.Lock(), [], 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        stages = json.loads(p.json).get("durationMs", {})
        with self.lock:
            for stage, millis in sorted(stages.items()):
                self.waiting.append((p.name, str(p.runId), p.batchId, p.numInputRows, p.timestamp, stage, int(millis)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, name: str, batches: int, seconds: float = 30) -> None:
        """Reports come a little after their batch: wait for those of so many batches with rows."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self.lock:
                if len({(r[1], r[2]) for r in self.waiting if r[0] == name and r[3]}) >= batches:
                    return
            time.sleep(0.1)

    def flush(self) -> None:
        with self.lock:
            rows, self.waiting = self.waiting, []
        if rows:
            append_batch(self.spark.createDataFrame(rows, ROWS), self.path, self.written)
            self.written += 1

    def rows(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(ROWS).parquet(f"{self.path}/*")


def batch_counts(statistics: DataFrame) -> DataFrame:
    """Batches with rows and rows of each query, over all its runs."""
    batches = statistics.filter("stage = 'triggerExecution' AND rows > 0")
    return batches.groupBy("name").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"))


def stage_latency(statistics: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Quantiles of the time of each stage, from mergeable sketches (percentile_approx)."""
    at = F.percentile_approx("millis", list(quantiles), 10_000)
    return statistics.groupBy("name", "stage").agg(F.count("*").alias("batches"), at.alias("millis"))
