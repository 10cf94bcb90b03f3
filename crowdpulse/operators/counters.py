"""Counts per image: tumbling windows, lifetime totals, view counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions.times import floor_to, plus_seconds
from crowdpulse.operators.sequences import first_at_or_after, latest_values
from crowdpulse.session import run_dir

KINDS = ("view", "comment", "flag")


def tumbling_counts(
    events: DataFrame, seconds: int = 300, key: str = "image_id", ts: str = "ts", by: tuple[str, ...] = ("kind",)
) -> DataFrame:
    """Events per (kind, image, fixed window). Rows without image or time are dropped.

    Partial counts are merged before the shuffle, so a hot image sends at most one
    row per window and map task.
    """
    return (
        events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(*by, key, floor_to(F.col(ts), seconds).alias("window_start"))
        .agg(F.count("*").alias("event_count"))
        .withColumn("window_end", plus_seconds(F.col("window_start"), seconds))
        .select(*by, key, "window_start", "window_end", "event_count")
    )


def merge_partials(partials: DataFrame, key: str = "image_id", by: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Window rows appended by several runs, one row per window again."""
    return partials.groupBy(*by, key, "window_start", "window_end").agg(
        F.sum("event_count").alias("event_count")
    )


def windows_per_kind(windows: DataFrame) -> DataFrame:
    return windows.groupBy("kind").agg(
        F.count("*").alias("windows"), F.sum("event_count").alias("events")
    )


def lifetime_totals(events: DataFrame, key: str = "image_id") -> DataFrame:
    """Total views, comments and flags per image over all time."""
    return (
        events.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.count_if(F.col("kind") == k).alias(f"total_{k}s") for k in KINDS])
    )


def apply_view_counts(images: DataFrame, views: DataFrame, image_key: str = "id") -> DataFrame:
    """Images with ``views`` raised by the number of view events."""
    seen = (
        views.filter(F.col("image_id").isNotNull())
        .groupBy(F.col("image_id").alias(image_key))
        .agg(F.count("*").alias("__n"))
    )
    return (
        images.join(seen, image_key, "left")
        .withColumn("views", F.coalesce("views", F.lit(0)) + F.coalesce("__n", F.lit(0)))
        .drop("__n")
    )


def views_of_known_images(views: DataFrame, images: DataFrame, image_key: str = "id") -> DataFrame:
    return views.join(images.select(F.col(image_key).alias("image_id")), "image_id", "left_semi")


def views_of_unknown_images(views: DataFrame, images: DataFrame, image_key: str = "id") -> DataFrame:
    """What a request for a missing image would answer with 404.

    Views without image stay out of the join: as null keys they would all meet in
    one task.
    """
    named = views.filter(F.col("image_id").isNotNull())
    missing = named.join(images.select(F.col(image_key).alias("image_id")), "image_id", "left_anti")
    return missing.unionByName(views.filter(F.col("image_id").isNull()))


def views_by_image(views: DataFrame, images: DataFrame, image_key: str = "id") -> DataFrame:
    """Views per image and whether the image is known: both reports of the two joins above at once."""
    known = images.select(F.col(image_key).alias("image_id"), F.lit(True).alias("__known"))
    counted = views.groupBy("image_id").agg(F.count("*").alias("views"))
    return counted.join(known, "image_id", "left").select(
        "image_id", "views", F.coalesce("__known", F.lit(False)).alias("known")
    )


def activity_score(
    images: DataFrame, views: DataFrame, comments: DataFrame, flags: DataFrame
) -> DataFrame:
    """Weighted activity per image: 1 + views + 2 comments + 3 image flags + 2 flags on its comments.

    Every input is counted per key before it is joined, so a hot image or comment
    is one row in the joins.
    """

    def counted(df: DataFrame, weight: int) -> DataFrame:
        return (
            df.filter(F.col("image_id").isNotNull())
            .groupBy("image_id")
            .agg((F.count("*") * weight).alias("points"))
        )

    per_comment = (
        flags.filter(F.col("image_id").isNull() & F.col("comment_id").isNotNull())
        .groupBy("comment_id")
        .agg((F.count("*") * 2).alias("points"))
    )
    on_comments = per_comment.join(
        comments.select(F.col("id").alias("comment_id"), "image_id"), "comment_id"
    ).select("image_id", "points")
    points = (
        counted(views, 1)
        .unionByName(counted(comments, 2))
        .unionByName(counted(flags, 3))
        .unionByName(on_comments)
        .groupBy("image_id")
        .agg(F.sum("points").alias("points"))
    )
    return images.select(F.col("id").alias("image_id")).join(points, "image_id", "left").select(
        "image_id", (F.lit(1) + F.coalesce("points", F.lit(0))).alias("activity_score")
    )


def flag_targets(flags: DataFrame, comments: DataFrame) -> DataFrame:
    """Flags with the image they lead to, directly or by the flagged comment.

    Image flags have no comment and stay out of the join: as null keys they would
    all meet in one task.
    """
    owner = comments.select(F.col("id").alias("comment_id"), F.col("image_id").alias("__owner"))
    on_comment = (
        flags.filter(F.col("comment_id").isNotNull())
        .join(owner, "comment_id", "left")
        .withColumn("target_image_id", F.coalesce("image_id", "__owner"))
        .drop("__owner")
    )
    on_image = flags.filter(F.col("comment_id").isNull()).withColumn("target_image_id", F.col("image_id"))
    return on_comment.unionByName(on_image)


def counted_every(totals: DataFrame, total: str, step: int, also: tuple[int, ...]) -> DataFrame:
    """Rows whose running total is a multiple of ``step`` or one of ``also``."""
    return totals.filter((F.col(total) % step == 0) | F.col(total).isin(*also))


def windows_from_first(events: DataFrame, seconds: int, key: str = "image_id", ts: str = "ts") -> DataFrame:
    """Counters that start at an event, run ``seconds`` and start again at the first event after that.

    Each time of a key points to the key's first time at or after its own end. Which times start a
    counter is then found from the key's first one by doubling: a round follows the pointers of all
    starts known so far and squares the pointers, so a chain of n counters takes log2(n) rounds, and
    no key is walked through by one task. Each round's tables are written below the shared folder.
    """
    spark = events.sparkSession
    folder = run_dir(spark, "windows-from-first")

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    known = events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    times = kept(known.groupBy(key, F.col(ts).alias("at")).agg(F.count("*").alias("n")), "times")
    ends = times.select(key, F.col("at").alias("start"), plus_seconds(F.col("at"), seconds).alias("at"))
    jumps = first_at_or_after(times.select(key, "at"), ends, key=key, ts="at").filter("found is not null")
    jumps = kept(jumps.select(key, "start", F.col("found").alias("to")), "jumps-0")
    starts = kept(times.groupBy(key).agg(F.min("at").alias("start")), "starts-0")
    had, rounds = 0, 0
    while (now := starts.count()) > had:
        had, rounds = now, rounds + 1
        reached = starts.join(jumps, [key, "start"]).select(key, F.col("to").alias("start"))
        starts = kept(starts.union(reached).distinct(), f"starts-{rounds}")
        ahead = jumps.select(key, F.col("start").alias("to"), F.col("to").alias("next"))
        doubled = jumps.join(ahead, [key, "to"]).select(key, "start", F.col("next").alias("to"))
        jumps = kept(doubled, f"jumps-{rounds}")
    marks = starts.select(key, F.col("start").alias("at"), F.col("start").alias("window"))
    placed = latest_values(
        times.join(marks, [key, "at"], "left"),
        key=key,
        ts=F.col("at"),
        order="n",
        values={"window_start": F.col("window")},
        bucket_seconds=86_400,
    )
    return placed.groupBy(key, "window_start").agg(F.sum("n").alias("event_count"))


def processed_now(windows: DataFrame, at: Column | None = None) -> DataFrame:
    return windows.withColumn("processed_at", at if at is not None else F.current_timestamp())
