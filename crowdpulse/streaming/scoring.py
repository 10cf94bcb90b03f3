"""Scoring requests on a stream: features at the request time, score, stored decision."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.operators import serving
from crowdpulse.operators.sequences import MICROS
from crowdpulse.params import EngagementParams
from crowdpulse.sources.sinks import append_batch, staged
from crowdpulse.streaming.batches import Handler


@dataclass
class ServingTables:
    """What a batch of requests reads. With ``totals`` the events are read one window back only."""

    events: DataFrame
    images: DataFrame
    users: DataFrame
    totals: DataFrame | None = None


def request_id(requests: DataFrame) -> Column:
    """The name of a request: where it arrived, or a hash of its content."""
    if "arrival" in requests.columns:
        return F.concat_ws("-", "arrival.partition", "arrival.offset")
    return F.xxhash64("image_id", "trigger", "ts").cast("string")


def scoring_writer(
    path: str,
    tables: Callable[[], ServingTables],
    params: EngagementParams,
    predictor: serving.Predictor | None = None,
    store: Handler | None = None,
) -> Handler:
    """``tables`` gives the tables as of the batch; decisions go to ``path`` by batch, then to ``store``.

    A request is named by its ``request_id`` or else by where it arrived, so equal requests stay
    apart; one without either is named by its content. The batch's folder is written again if
    ``store`` fails, with the same ids.
    """
    predict = predictor or serving.rule_predictor(params.rules)

    def write(batch: DataFrame, batch_id: int) -> None:
        t = tables()
        asked = serving.accepted_requests(batch)
        if "request_id" not in asked.columns:
            asked = asked.withColumn("request_id", request_id(asked))
        # The features read them several times.
        asked = staged(asked, f"{path}_asked")
        # A batch asks for few images: only their activity, and only the images of
        # their uploaders (for the per-user count), go through the shuffles.
        ids = asked.select("image_id").distinct()
        owned = t.images.join(ids, t.images["id"] == ids["image_id"], "left_semi")
        images = t.images.join(owned.select("user_id").distinct(), "user_id", "left_semi")
        events, totals = t.events, t.totals
        if totals is not None:
            first = asked.agg(F.min(F.unix_micros("ts"))).first()[0]
            reach = max(params.serving_seconds.values()) * MICROS
            events = events.filter(F.col("ts") >= F.timestamp_micros(F.lit((first or 0) - reach)))
            totals = totals.join(ids, "image_id", "left_semi")
        rows = serving.request_features(
            asked, events.join(ids, "image_id", "left_semi"), images, t.users, params, totals
        )
        decided = serving.decisions(predict(rows), F.col("ts"))
        append_batch(decided, path, batch_id)
        if store is not None:
            store(batch.sparkSession.read.schema(decided.schema).parquet(f"{path}/batch_id={batch_id}"), batch_id)

    return write
