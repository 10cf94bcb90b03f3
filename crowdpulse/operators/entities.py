"""Keyed upserts and lookups: users, image metadata, latest features."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions import content, risk, times
from crowdpulse.params import EngagementParams


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first arrival of each key. Minima merge before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("__f")).select(key, "__f.*")


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last write of each key."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("__f")).select(key, "__f.*")


def users_to_create(incoming: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """First request per username that has no account yet."""
    return first_per_key(incoming, "username", order).join(
        existing.select("username"), "username", "left_anti"
    )


def get_or_create_users(incoming: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """The account each requested username ends up with: the stored one or the first request."""
    stored = existing.select("username", F.col("id").alias("__stored"))
    return (
        first_per_key(incoming, "username", order)
        .join(stored, "username", "left")
        .select(
            "username",
            F.coalesce("__stored", "id").alias("id"),
            F.col("__stored").isNull().alias("created"),
        )
    )


def upload_metadata(uploads: DataFrame, ingest_time: Column | None = None, order: str = "arrival") -> DataFrame:
    """The metadata an upload message stores for its image, as text fields."""
    uploaded = F.coalesce("created_at", "uploaded_at")
    if ingest_time is not None:
        uploaded = F.coalesce(uploaded, times.iso(ingest_time))
    return uploads.filter(content.present(F.col("image_id"))).select(
        "image_id",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        content.caption_length(F.col("caption")).cast("string").alias("caption_length"),
        uploaded.alias("uploaded_at"),
        F.coalesce("user_id", F.lit("")).alias("user_id"),
        order,
    )


def latest_metadata(uploads: DataFrame, ingest_time: Column | None = None, order: str = "arrival") -> DataFrame:
    """The last write of each image; ``order`` says which write came later and never ties."""
    return last_per_key(upload_metadata(uploads, ingest_time, order), "image_id", order)


def features_now(
    metadata: DataFrame, events: DataFrame, now: Column, params: EngagementParams
) -> DataFrame:
    """Stored features of every image at one time: counts over [now-W, now], totals, metadata.

    All images share the time, so one aggregation does; here the comment ratio is
    over lifetime totals.
    """
    kinds = ("view", "comment", "flag")
    micros = F.unix_micros("ts")

    def recent(kind: str, seconds: int) -> Column:
        return F.count_if(
            (F.col("kind") == kind) & (micros >= F.unix_micros(now) - F.lit(seconds * 1_000_000))
        )

    counts = (
        events.filter(F.col("image_id").isNotNull() & (micros <= F.unix_micros(now)))
        .groupBy("image_id")
        .agg(
            *[recent(k, s).alias(f"{k}s_{n}") for k in kinds for n, s in params.serving_seconds.items()],
            *[F.count_if(F.col("kind") == k).alias(f"total_{k}s") for k in kinds],
        )
    )
    names = [f"{k}s_{n}" for k in kinds for n in params.serving_seconds] + [f"total_{k}s" for k in kinds]
    joined = metadata.join(counts, "image_id", "left").withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in names}
    )
    length = F.coalesce(F.col("caption_length").try_cast("int"), F.lit(0))
    uploaded = times.parse_iso(F.col("uploaded_at"))
    return joined.withColumns(
        {
            "caption_length": length,
            "has_caption": F.when(length > 0, 1).otherwise(0),
            "view_velocity": risk.view_velocity(F.col("views_5min")),
            "comment_ratio": risk.comment_to_view_ratio(F.col("total_comments"), F.col("total_views")),
            "recent_engagement": risk.recent_engagement(F.col("views_5min"), F.col("comments_5min")),
            "time_since_upload_seconds": F.coalesce(
                times.seconds_between(uploaded, now), F.lit(0).cast("bigint")
            ),
        }
    )


def lookup(features: DataFrame, keys: DataFrame, key: str = "image_id") -> DataFrame:
    """Features of the asked keys; a key without stored features gives nulls."""
    return keys.select(key).distinct().join(features, key, "left")


def keys_like(features: DataFrame, pattern: str, key: str = "image_id") -> DataFrame:
    """Keys that match a glob pattern: `*` any text, `?` one character, `[ab]`, `[^ab]` and `[a-c]`
    one of a class, and a backslash before a character for itself."""
    out, at = [], 0
    while at < len(pattern):
        c = pattern[at]
        end = pattern.find("]", at + 2) if c == "[" else -1
        if c == "\\" and at + 1 < len(pattern):
            out.append(re.escape(pattern[at + 1]))
            at += 1
        elif end > 0:
            inner = pattern[at + 1 : end]
            negated = "^" if inner[0] == "^" and len(inner) > 1 else ""
            own = inner[1:] if negated else inner
            out.append("[" + negated + re.sub(r"([\\\[\]^&])", r"\\\1", own) + "]")
            at = end
        else:
            out.append({"*": ".*", "?": "."}.get(c, re.escape(c)))
        at += 1
    return features.filter(F.col(key).cast("string").rlike(f"(?s)^(?:{''.join(out)})$")).select(key)
