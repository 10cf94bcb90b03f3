"""Shared parts of the streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Handler = Callable[[DataFrame, int], None]


def run_available(
    stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append", name: str | None = None
) -> StreamingQuery:
    """One bounded run: everything from the checkpoint (or the earliest) to the end at its start.

    Offsets are committed after the handler returns, so a failed batch runs again. ``name`` is the
    query's in its statistics.
    """
    writer = stream.writeStream.outputMode(mode)
    query = (
        (writer.queryName(name) if name else writer)
        .foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_continuous(stream: DataFrame, handler: Handler, checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def read_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """All batches written so far; an absent table is empty when a schema is given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def progress(query: StreamingQuery) -> list[dict]:
    """Rows, time per stage and observed counters of the recent batches of a query."""
    return [
        {
            "batch_id": p.batchId,
            "rows": p.numInputRows,
            "duration_ms": dict(p.durationMs),
            "observed": {name: row.asDict() for name, row in p.observedMetrics.items()},
        }
        for p in query.recentProgress
    ]
