"""Running, rolling and as-of values over event sequences, safe for hot keys.

A plain ``Window.partitionBy(key)`` hands the whole history of one key to one
task, and a sliding RANGE frame re-reads its content for every row. Here every
sequence is cut into time buckets. One shuffle by (key, bucket) gives the exact
position of a row inside its bucket with growing frames only (linear work). What
lies before a bucket comes from the bucket sums, and those are cut the same way:
running sums within a day of buckets, plus day sums carried from day to day. The
largest group in a task is one key's rows in one bucket, or its buckets of one day,
or its days; no task holds a key's life.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
# One key's rows of at most an hour meet in a task, however long the windows are.
LARGEST_BUCKET = 3600 * MICROS
# Bucket sums are carried within this span first, then from span to span.
SPAN = 86_400 * MICROS


def _bucketed(rows: DataFrame, keys: list[str], ts: Column, width: int) -> DataFrame:
    micros = F.unix_micros(ts)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        rows.withColumn("__us", micros)
        .filter(known & F.col("__us").isNotNull())
        .withColumn("__p", F.pmod("__us", F.lit(width)))
        .withColumn("__b", F.col("__us") - F.col("__p"))
    )


def rolling_counts(
    rows: DataFrame,
    *,
    key: str | list[str],
    ts: Column,
    order: Column,
    measures: dict[str, Column] | None = None,
    windows: dict | None = None,
    totals: dict[str, Column] | None = None,
    edge: str = "auto",
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Per-row counts of each measure in the last W seconds of the same key.

    ``measures`` and ``totals`` are boolean columns. A measure gives
    ``{measure}_{window}`` for each of ``windows`` (name to seconds, for all
    measures, or one such map per measure). ``edge`` says what happens at t-W:
    "open" counts ``(t-W, t]``, "closed" ``[t-W, t]``, and "auto" is open at rows
    that belong to the measure and closed at all others. A total gives
    ``{total}_total``, the rows so far. Rows with equal time count in ``order``;
    rows without key or time are dropped.

    Every W is a multiple of the bucket (by default the largest common divisor of
    the windows and one hour), so ``t-W`` lies at the same phase of an
    earlier bucket: shifting that bucket's rows by W puts them beside the row
    that asks, and the count is *bucket sums between* + *own rows up to the
    phase* - *shifted rows up to the phase*. ``rows`` is read twice, so an expensive
    derivation is better written to a table first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    measures, windows, totals = dict(measures or {}), dict(windows or {}), dict(totals or {})
    nested = any(isinstance(w, dict) for w in windows.values())
    asked = [
        (m, name, seconds * MICROS)
        for m in measures
        for name, seconds in (windows.get(m, {}) if nested else windows).items()
    ]
    shifts = sorted({s for _, _, s in asked})
    width = bucket_seconds * MICROS if bucket_seconds else reduce(gcd, shifts, LARGEST_BUCKET)
    if any(s % width for s in shifts):
        raise ValueError(f"a bucket of {bucket_seconds} s does not divide the windows {windows}")
    payload = [c for c in rows.columns if c not in keys]

    base = _bucketed(rows, keys, ts, width).withColumn("__o", order)
    marks = {**{f"__w_{m}": c for m, c in measures.items()}, **{f"__a_{m}": c for m, c in totals.items()}}
    base = base.withColumns({w: F.coalesce(c, F.lit(False)).cast("bigint") for w, c in marks.items()})
    weights = list(marks)

    def shifted_by(s: int) -> Column:
        uses = [F.col(f"__w_{m}") > 0 for m, _, shift in asked if shift == s]
        return F.when(reduce(lambda a, b: a | b, uses), F.lit(s).cast("bigint"))

    zero = F.lit(0).cast("bigint")
    # A row is copied only for the windows that count it.
    copies = F.array_compact(F.array(zero, *[shifted_by(s) for s in shifts]))
    spread = base.withColumn("__shift", F.explode(copies)) if shifts else base.withColumn("__shift", zero)
    is_own = F.col("__shift") == 0
    # Shifted copies carry only phase and weights.
    spread = spread.select(
        *keys,
        (F.col("__b") + F.col("__shift")).alias("__b"),
        "__p",
        "__shift",
        F.when(is_own, F.col("__o")).alias("__o"),
        *weights,
        *[F.when(is_own, F.col(c)).alias(c) for c in payload],
    )

    cell = Window.partitionBy(*keys, "__b")
    upto = cell.orderBy("__p", is_own, "__o").rowsBetween(Window.unboundedPreceding, 0)
    below = cell.orderBy("__p").rangeBetween(Window.unboundedPreceding, -1)

    def part(weight: str, shift: int) -> Column:
        return F.when(F.col("__shift") == shift, F.col(weight)).otherwise(0)

    gone = []
    if edge != "closed":
        gone += [F.sum(part(f"__w_{m}", s)).over(upto).alias(f"__le_{m}_{n}") for m, n, s in asked]
    if edge != "open":
        gone += [F.sum(part(f"__w_{m}", s)).over(below).alias(f"__lt_{m}_{n}") for m, n, s in asked]
    located = spread.select(
        "*", *[F.sum(part(w, 0)).over(upto).alias(f"__own{w}") for w in weights], *gone
    ).filter(is_own)

    # The same shift one level up: events before the bucket less events before it
    # minus W, both as growing sums.
    sums = base.groupBy(*keys, "__b").agg(*[F.sum(w).alias(w) for w in weights])
    steps = F.array(*[F.lit(s).cast("bigint") for s in [0, *shifts]])
    spread_sums = sums.withColumn("__shift", F.explode(steps)).withColumn("__b", F.col("__b") + F.col("__shift"))
    wanted = {f"__s_{m}_{n}": part(f"__w_{m}", 0) - part(f"__w_{m}", s) for m, n, s in asked}
    wanted |= {f"__t_{m}": part(f"__a_{m}", 0) for m in totals}
    carried = sums_before(spread_sums, keys, wanted, SPAN if width < SPAN else None).filter(is_own)
    carried = carried.select(*keys, "__b", *wanted)

    def leaving(m: str, n: str) -> Column:
        below_edge = F.coalesce(f"__lt_{m}_{n}", zero)
        if edge == "open":
            return F.col(f"__le_{m}_{n}")
        if edge == "closed":
            return below_edge
        return F.when(F.col(f"__w_{m}") > 0, F.col(f"__le_{m}_{n}")).otherwise(below_edge)

    counts = [
        (F.col(f"__own__w_{m}") + F.col(f"__s_{m}_{n}") - leaving(m, n)).alias(f"{m}_{n}")
        for m, n, _ in asked
    ]
    counts += [(F.col(f"__own__a_{m}") + F.col(f"__t_{m}")).alias(f"{m}_total") for m in totals]
    return located.join(carried, [*keys, "__b"]).select(*keys, *payload, *counts)


def sums_before(sums: DataFrame, keys: list[str], wanted: dict[str, Column], span: int | None = SPAN) -> DataFrame:
    """Add to every row the sum of each expression over the rows of its key with a smaller ``__b``.

    With a ``span`` the sums are running within a span and carried from span to span: the rows of a
    key meet by span, and its life is one pre-aggregated row per span.
    """
    zero = F.lit(0).cast("bigint")
    if span is None:
        earlier = Window.partitionBy(*keys).orderBy("__b").rangeBetween(Window.unboundedPreceding, -1)
        return sums.select("*", *[F.coalesce(F.sum(c).over(earlier), zero).alias(n) for n, c in wanted.items()])
    placed = sums.withColumns({f"__x{n}": c for n, c in wanted.items()})
    placed = placed.withColumn("__span", F.col("__b") - F.pmod("__b", F.lit(span)))
    within = Window.partitionBy(*keys, "__span").orderBy("__b").rangeBetween(Window.unboundedPreceding, -1)
    inside = placed.select("*", *[F.coalesce(F.sum(f"__x{n}").over(within), zero).alias(f"__i{n}") for n in wanted])
    spans = placed.groupBy(*keys, "__span").agg(*[F.sum(f"__x{n}").alias(f"__x{n}") for n in wanted])
    before = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *keys, "__span", *[F.coalesce(F.sum(f"__x{n}").over(before), zero).alias(f"__c{n}") for n in wanted]
    )
    joined = inside.join(spans, [*keys, "__span"])
    return joined.select(*sums.columns, *[(F.col(f"__i{n}") + F.col(f"__c{n}")).alias(n) for n in wanted])


def kth_rows(
    rows: DataFrame, *, key: str, ts: Column, order: Column, numbers: tuple[int, ...], bucket_seconds: int = 3600
) -> DataFrame:
    """The k-th row of each key in time for each k of ``numbers``, as ``k`` beside the row.

    Bucket sums tell which bucket holds the k-th row; only rows of those buckets are ranked, one key
    and bucket at a time. Keys with fewer rows have no row for that k.
    """
    base = _bucketed(rows, [key], ts, bucket_seconds * MICROS).withColumn("__o", order)
    sums = base.groupBy(key, "__b").agg(F.count("*").alias("__n"))
    located = sums_before(sums, [key], {"__before": F.col("__n")})
    held = F.filter(
        F.array(*[F.lit(k).cast("bigint") for k in numbers]),
        lambda k: (k > F.col("__before")) & (k <= F.col("__before") + F.col("__n")),
    )
    holding = located.select(key, "__b", "__before", held.alias("__held")).filter(F.size("__held") > 0)
    cell = Window.partitionBy(key, "__b").orderBy("__p", "__o")
    ranked = base.join(holding, [key, "__b"]).withColumn("k", F.col("__before") + F.row_number().over(cell))
    return ranked.filter(F.array_contains("__held", F.col("k"))).select(*rows.columns, "k")


def first_at_or_after(
    rows: DataFrame, probes: DataFrame, *, key: str, ts: str, bucket_seconds: int = 86_400
) -> DataFrame:
    """Probes with ``found``, the time of their key's first row at or after ``ts``; null when there is none.

    An as-of lookup with the time turned round, so a hot key is split by time there too.
    """

    def turned(c: Column) -> Column:
        return F.timestamp_micros(-F.unix_micros(c))

    facts = rows.select(key, turned(F.col(ts)).alias("__at"), F.lit(0).alias("__probe"))
    asked = probes.select("*", turned(F.col(ts)).alias("__at"), F.lit(1).alias("__probe"))
    both = facts.unionByName(asked, allowMissingColumns=True)
    known = F.when(F.col("__probe") == 0, F.col("__at"))
    found = latest_values(
        both, key=key, ts=F.col("__at"), order="__probe", values={"found": known}, bucket_seconds=bucket_seconds
    )
    return found.filter("__probe = 1").select(*probes.columns, turned(F.col("found")).alias("found"))


def latest_values(
    rows: DataFrame,
    *,
    key: str,
    ts: Column,
    order: str,
    values: dict[str, Column],
    bucket_seconds: int = 60,
) -> DataFrame:
    """Add the latest non-null value of each column at or before every row of its key."""
    base = _bucketed(rows, [key], ts, bucket_seconds * MICROS)
    for name, value in values.items():
        base = base.withColumn(f"__v_{name}", value)
    upto = (
        Window.partitionBy(key, "__b")
        .orderBy("__p", order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    located = base.select(
        *rows.columns,
        "__b",
        *[F.last(f"__v_{n}", ignorenulls=True).over(upto).alias(f"__l_{n}") for n in values],
    )
    when_set = {n: F.when(F.col(f"__v_{n}").isNotNull(), F.struct("__p", order)) for n in values}
    cells = base.groupBy(key, "__b").agg(*[F.max_by(f"__v_{n}", when_set[n]).alias(f"__e_{n}") for n in values])
    carried = _latest_before(cells, key, list(values), SPAN if bucket_seconds * MICROS < SPAN else None)
    return located.join(carried, [key, "__b"]).select(
        *rows.columns, *[F.coalesce(f"__l_{n}", f"__c_{n}").alias(n) for n in values]
    )


def _latest_before(cells: DataFrame, key: str, names: list[str], span: int | None) -> DataFrame:
    """(key, __b, __c_*): the latest value of earlier buckets, within a span first, then from span to span."""

    def last(name: str, by: list[str], order: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(f"__e_{name}", ignorenulls=True).over(frame)

    if span is None:
        return cells.select(key, "__b", *[last(n, [key], "__b").alias(f"__c_{n}") for n in names])
    placed = cells.withColumn("__span", F.col("__b") - F.pmod("__b", F.lit(span)))
    inside = placed.select(key, "__b", "__span", *[last(n, [key, "__span"], "__b").alias(f"__i_{n}") for n in names])
    newest = {n: F.max_by(f"__e_{n}", F.when(F.col(f"__e_{n}").isNotNull(), F.col("__b"))) for n in names}
    spans = placed.groupBy(key, "__span").agg(*[c.alias(f"__e_{n}") for n, c in newest.items()])
    spans = spans.select(key, "__span", *[last(n, [key], "__span").alias(f"__s_{n}") for n in names])
    return inside.join(spans, [key, "__span"]).select(
        key, "__b", *[F.coalesce(f"__i_{n}", f"__s_{n}").alias(f"__c_{n}") for n in names]
    )
