"""JSON messages: encode, decode, validate, route, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.content import present
from crowdpulse.functions.times import event_time, iso, parse_iso
from crowdpulse.params import TOPIC_OF_KIND
from crowdpulse.schemas import EVENT

STREAM_KINDS = ("view", "comment", "upload", "flag")


def topic_of(kind: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in TOPIC_OF_KIND.items() for x in kv])
    return F.try_element_at(pairs, kind)


def encode(rows: DataFrame, topic: Column, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """One keyless message per row: topic and JSON text, nulls written as null; ``keep`` stays beside it."""
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.select(topic.alias("topic"), text.alias("value"), *keep)


def _text(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("string").alias(alias or name)


def _zoned(name: str) -> Column:
    return F.concat(iso(F.col(name)), F.lit("+00:00")).alias(name)


def view_messages(views: DataFrame) -> DataFrame:
    """(image_id, ts) rows as view messages; their time text has no zone."""
    shaped = views.select(
        F.lit("view").alias("event_type"), _text("image_id"), iso(F.col("ts")).alias("viewed_at")
    )
    return encode(shaped, topic_of(F.lit("view")), shaped.columns)


def comment_messages(comments: DataFrame) -> DataFrame:
    shaped = comments.select(
        F.lit("comment").alias("event_type"),
        _text("id", "comment_id"),
        _text("image_id"),
        _text("user_id"),
        "content",
        _zoned("created_at"),
    )
    return encode(shaped, topic_of(F.lit("comment")), shaped.columns)


def upload_messages(images: DataFrame) -> DataFrame:
    shaped = images.select(
        F.lit("upload").alias("event_type"),
        _text("id", "image_id"),
        _text("user_id"),
        "category",
        "caption",
        _zoned("created_at"),
        "s3_url",
    )
    return encode(shaped, topic_of(F.lit("upload")), shaped.columns)


def flag_messages(flags: DataFrame) -> DataFrame:
    """Flags with at least one target; a flag without target is refused, not sent."""
    shaped = flags.filter(F.col("image_id").isNotNull() | F.col("comment_id").isNotNull()).select(
        F.lit("flag").alias("event_type"),
        _text("id", "flag_id"),
        _text("user_id"),
        _text("image_id"),
        _text("comment_id"),
        "reason",
        _zoned("created_at"),
    )
    return encode(shaped, topic_of(F.lit("flag")), shaped.columns)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages to typed columns; text that is not JSON yields nulls, never an error."""
    keep = [c for c in messages.columns if c != value]
    return messages.select(
        *keep, F.from_json(F.col(value).cast("string"), EVENT, {"mode": "PERMISSIVE"}).alias("m")
    ).select(*keep, "m.*")


def with_event_time(decoded: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Add ``ts``: the event time of the message's kind.

    With ``ingest_time`` a message without time text takes it (stream rule);
    without, it stays null and the batch rule skips it.
    """
    text = event_time(
        F.col("event_type"), F.col("viewed_at"), F.col("created_at"), F.col("uploaded_at")
    )
    ts = parse_iso(text)
    if ingest_time is not None:
        ts = F.when(present(text), ts).otherwise(ingest_time)
    return decoded.withColumn("ts", ts)


def accepted() -> Column:
    """Required fields: an image for every kind, and for comments the comment too."""
    kind = F.col("event_type")
    comment_ok = (kind != "comment") | present(F.col("comment_id"))
    return F.coalesce(
        kind.isin(*STREAM_KINDS) & present(F.col("image_id")) & comment_ok & F.col("ts").isNotNull(),
        F.lit(False),
    )


def valid(timed: DataFrame) -> DataFrame:
    return timed.filter(accepted())


def kind_of_topic(topic: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kind, name in TOPIC_OF_KIND.items() for x in (name, kind)])
    return F.try_element_at(pairs, topic)


def for_windows(timed: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """What the batch job counts, with ``kind``: it asks for image and time only, and goes by topic.

    Without a topic column the message's own type is its kind. A comment needs no id here.
    """
    kind = kind_of_topic(F.col("topic")) if "topic" in timed.columns else F.col("event_type")
    good = present(F.col("image_id")) & F.col("ts").isNotNull()
    return timed.withColumn("kind", kind).filter(F.col("kind").isin(*kinds) & good)


def rejected(timed: DataFrame) -> DataFrame:
    """The quarantine branch, with the first rule a message breaks."""
    kind = F.col("event_type")
    reason = (
        F.when(~F.coalesce(kind.isin(*STREAM_KINDS), F.lit(False)), "unknown_type")
        .when(~present(F.col("image_id")), "missing_image")
        .when((kind == "comment") & ~present(F.col("comment_id")), "missing_comment")
        .otherwise("bad_time")
    )
    return timed.filter(~accepted()).withColumn("reason", reason)


def read_counters(timed: DataFrame) -> DataFrame:
    """Messages read, processed and skipped per type, in one pass."""
    ok = accepted()
    return timed.groupBy("event_type").agg(
        F.count("*").alias("events_read"),
        F.count_if(ok).alias("events_processed"),
        F.count_if(~ok).alias("events_skipped"),
    )


def observed(timed: DataFrame, name: str) -> DataFrame:
    """The same rows, with the read, processed and skipped counters in the query's progress."""
    ok = accepted()
    return timed.observe(
        name,
        F.count(F.lit(1)).alias("events_read"),
        F.count_if(ok).alias("events_processed"),
        F.count_if(~ok).alias("events_skipped"),
    )


def route(timed: DataFrame) -> dict[str, DataFrame]:
    """One frame per known kind; unknown types are in :func:`rejected`."""
    good = valid(timed)
    return {k: good.filter(F.col("event_type") == k) for k in STREAM_KINDS}


def topic_rollup(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages per topic and, under topic ``TOTAL``, all together."""
    return (
        messages.rollup(topic)
        .agg(F.count("*").alias("messages"), F.grouping(topic).alias("__all"))
        .select(
            F.when(F.col("__all") == 1, F.lit("TOTAL")).otherwise(F.col(topic)).alias("topic"),
            "messages",
        )
    )


def without_redelivered(events: DataFrame, order: list[str]) -> DataFrame:
    """Events of a log without comments that came again: of equal image, comment and time the first stays.

    A comment without id, and every view and flag, is an event of its own. The groups are as small
    as a comment's deliveries.
    """
    again = Window.partitionBy("image_id", "comment_id", "ts").orderBy(*order)
    known = (F.col("kind") == "comment") & present(F.col("comment_id"))
    once = events.filter(known).withColumn("__n", F.row_number().over(again)).filter("__n = 1").drop("__n")
    return events.filter(~F.coalesce(known, F.lit(False))).unionByName(once)


def drop_redelivered_comments(comments: DataFrame, comment_id: str = "comment_id", ts: str = "ts") -> DataFrame:
    """A comment delivered again at the same time counts once; views and flags never merge."""
    return comments.dropDuplicates([comment_id, ts])


def unite(*topics: DataFrame) -> DataFrame:
    """Several topics as one frame; a column one of them lacks is null there."""
    out = topics[0]
    for t in topics[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
