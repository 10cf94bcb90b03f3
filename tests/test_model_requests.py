"""The model of the request queries is fitted on rows written once."""

from datetime import datetime, timedelta

import pytest

from crowdpulse.operators import learning
from crowdpulse.plans.catalog import QUERIES


class Seen(Exception):
    pass


def test_fit_reads_written_training_rows(spark, tmp_path, monkeypatch):
    types = ("signup", "view", "click", "error", "purchase")
    at = datetime(2024, 1, 1)
    events = [(k, at + timedelta(minutes=k), k % 3, types[k // 3 % 5], 1.0, "{}") for k in range(60)]
    kind = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, kind).write.parquet(f"{tmp_path}/events.parquet")
    users = [(k, f"u{k}", 0, 0.0, "BUILDING") for k in range(3)]
    kind = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(users, kind).write.parquet(f"{tmp_path}/customer.parquet")

    def fit(rows):
        raise Seen(rows.count(), rows.inputFiles())

    monkeypatch.setattr(learning, "fit", fit)
    for name in ("model_request_scores", "model_request_checks"):
        with pytest.raises(Seen) as seen:
            QUERIES[name](spark, str(tmp_path))
        count, files = seen.value.args
        assert count > 0 and files and all("/model-training-" in f for f in files)
