"""Timestamp expressions. Every function takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400 * 1_000_000


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to timestamp: `Z`, any offset, or no zone (UTC); junk gives null.

    The pattern keeps out what Spark reads but ISO text is not: a bare time (of
    today) or a bare year.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]|$)"), F.try_to_timestamp(text))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def floor_to(ts: Column, seconds: int) -> Column:
    """Start of the fixed bucket that holds ``ts`` (start included, end excluded)."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def event_time(kind: Column, viewed_at: Column, created_at: Column, uploaded_at: Column | None = None) -> Column:
    """Raw time text of a message: views carry `viewed_at`, uploads may carry `uploaded_at`."""
    later = F.coalesce(created_at, uploaded_at) if uploaded_at is not None else created_at
    return F.when(kind == "view", viewed_at).when(kind == "upload", later).otherwise(created_at)


def hour_of_day(ts: Column) -> Column:
    return F.coalesce(F.hour(ts), F.lit(0))


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.coalesce(F.weekday(ts), F.lit(0))


def is_weekend(ts: Column) -> Column:
    return F.when(F.weekday(ts) >= 5, 1).otherwise(0)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds, truncated to zero."""
    return ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)).cast("bigint")


def days_between(start: Column, end: Column) -> Column:
    """Whole days, truncated to zero; a missing end point gives 0."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.coalesce((micros / F.lit(float(DAY_MICROS))).cast("bigint"), F.lit(0).cast("bigint"))
