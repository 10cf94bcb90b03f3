"""Plans with a key that holds a third of the rows."""

from pyspark.sql import functions as F

from crowdpulse.operators import alerts, counters, governance, training
from crowdpulse.params import SCALED


def hot_actions(spark, n=120_000):
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000)
    return spark.range(n).repartition(8).select(
        "id",
        hot.alias("user_id"),
        F.concat(F.lit("text "), F.col("id")).alias("content"),
        F.timestamp_seconds(F.lit(1767225600) + F.col("id")).alias("created_at"),
    )


def test_hot_actor_is_split_by_the_skew_join(spark):
    """The adaptive join splits the hot actor's rows; the result stays whole."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        users = spark.range(5000).select("id", F.lit(False).alias("is_test_account"), F.lit(1990).alias("year_of_birth"))
        kept = governance.eligible_actions(hot_actions(spark), users)
        assert len(kept.collect()) == 120_000
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in plan and "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_counts_merge_before_the_shuffle(spark):
    events = hot_actions(spark).select(
        F.col("user_id").alias("image_id"), F.lit("view").alias("kind"), F.col("created_at").alias("ts")
    )
    plan = counters.tumbling_counts(events)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_recent_alerts_keep_n_rows_per_task(spark):
    found = spark.range(10_000).select(
        F.col("id").alias("image_id"),
        F.when(F.col("id") % 3 == 0, "viral").otherwise("popular").alias("alert_type"),
        F.timestamp_seconds("id").alias("ts"),
    )
    top = alerts.most_recent_alerts(found, SCALED.alert_tracking)
    assert top.count() == 2000
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_flags_of_a_hot_image_are_one_row_per_hour(spark):
    flags = spark.range(50_000).select(
        F.lit("i").alias("image_id"), F.timestamp_millis(F.lit(1767225600000) + F.col("id") * 100).alias("created_at")
    )
    assert training._label_facts(flags).count() == 2
