"""One stream for all kinds of events: alerts, milestones, image metadata and scoring requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.operators import alerts, messages
from crowdpulse.params import REQUEST_TOPIC
from crowdpulse.schemas import REQUEST
from crowdpulse.sources.sinks import send_batch, staged
from crowdpulse.streaming.alerts import AlertJob
from crowdpulse.streaming.batches import Handler
from crowdpulse.streaming.entities import metadata_writer


def activity_writer(job: AlertJob, metadata_path: str, requests: Handler | None = None) -> Handler:
    """Views, comments and flags go to ``job``, uploads to the metadata, new alerts on to ``requests``.

    A batch is written once and read by all of them. Each part replaces its own folders, so a batch
    that fails in between is done again whole.
    """
    store_metadata = metadata_writer(metadata_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        arrived = staged(batch, f"{job.root}/arrived")
        job.handle(arrived, batch_id)
        store_metadata(messages.valid(arrived), batch_id)
        if requests is not None:
            requests(alerts.scoring_requests(job.alerts_table.batch(batch_id)), batch_id)

    return write


def request_writer(*, servers: str | None = None, message_path: str | None = None) -> Handler:
    """Send scoring requests as messages, to Kafka or as text files of the batch."""

    def write(requests: DataFrame, batch_id: int) -> None:
        sent = messages.encode(requests, F.lit(REQUEST_TOPIC), REQUEST.names)
        send_batch(sent, batch_id, servers=servers, path=message_path)

    return write
