"""Bucketed running, rolling and as-of values against brute force."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdpulse.operators.sequences import latest_values, rolling_counts

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
WINDOWS = {"short": 2, "long": 6}
SCHEMA = "k string, us bigint, n bigint, kind string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros("us"))


def counted(spark, rows, bucket=None, windows=None):
    kinds = {m: F.col("kind") == m for m in ("a", "b")}
    df = rolling_counts(
        frame(spark, rows),
        key="k",
        ts=F.col("ts"),
        order=F.col("n"),
        measures=kinds,
        windows=windows or WINDOWS,
        totals=kinds,
        bucket_seconds=bucket,
    )
    return {r["n"]: r.asDict() for r in df.collect()}


def brute(rows, windows=WINDOWS):
    out = {}
    for k, t, n, kind in rows:
        seen = [r for r in rows if r[0] == k and (r[1], r[2]) <= (t, n)]
        row = {}
        for m in ("a", "b"):
            for name, w in windows.items():
                low = t - w * 1_000_000
                row[f"{m}_{name}"] = sum(r[3] == m and (r[1] > low if kind == m else r[1] >= low) for r in seen)
            row[f"{m}_total"] = sum(r[3] == m for r in seen)
        out[n] = row
    return out


def check(spark, rows, **options):
    got, want = counted(spark, rows, **options), brute(rows, options.get("windows") or WINDOWS)
    assert set(got) == set(want)
    for n, row in want.items():
        assert {c: got[n][c] for c in row} == row


def random_rows(seed, size, step=500_000, span=40):
    rng = random.Random(seed)
    # Times on a coarse grid, so ties and exact window edges are common; a third of all rows on one key.
    return [
        (rng.choice(["hot", "x", "y"]), rng.randrange(-span, span) * step, n, rng.choice("aabc"))
        for n in range(size)
    ]


@pytest.mark.parametrize("bucket", [None, 1, 2])
def test_rolling_counts_with_ties_and_edges(spark, bucket):
    check(spark, random_rows(3, 400), bucket=bucket)


@pytest.mark.parametrize("edge", ["open", "closed"])
def test_edges_for_all_rows(spark, edge):
    rows = random_rows(7, 200)
    kinds = {m: F.col("kind") == m for m in ("a", "b")}
    df = rolling_counts(
        frame(spark, rows),
        key="k",
        ts=F.col("ts"),
        order=F.col("n"),
        measures=kinds,
        windows={"a": {"w": 3}, "b": {"w": 5, "x": 2}},
        edge=edge,
    )
    for r in df.collect():
        me = next(x for x in rows if x[2] == r["n"])
        seen = [x for x in rows if x[0] == me[0] and (x[1], x[2]) <= (me[1], me[2])]
        for column, m, w in (("a_w", "a", 3), ("b_w", "b", 5), ("b_x", "b", 2)):
            low = me[1] - w * 1_000_000
            want = sum(x[3] == m and (x[1] >= low if edge == "closed" else x[1] > low) for x in seen)
            assert r[column] == want
    assert "a_x" not in df.columns


def test_key_of_two_columns(spark):
    rows = random_rows(9, 200)
    df = rolling_counts(
        frame(spark, rows),
        key=["k", "kind"],
        ts=F.col("ts"),
        order=F.col("n"),
        measures={"own": F.lit(True)},
        windows=WINDOWS,
        edge="open",
    )
    want = brute(rows)
    for r in df.filter("kind <> 'c'").collect():
        assert (r.own_short, r.own_long) == tuple(want[r["n"]][f"{r.kind}_{w}"] for w in WINDOWS)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["k", "l"]), st.integers(0, 16), st.sampled_from("ab")),
        min_size=1,
        max_size=25,
    )
)
def test_rolling_counts_property(spark, drawn):
    check(spark, [(k, t * 500_000, n, kind) for n, (k, t, kind) in enumerate(drawn)])


def test_golden_rolling_boundary(spark):
    rows = [("i", t * 1_000_000, n, "a") for n, t in enumerate((0, 1, 300, 301))]
    got = counted(spark, rows, windows={"w": 300})
    assert [got[n]["a_w"] for n in range(4)] == [1, 2, 2, 2]


def test_golden_cross_boundary_is_inclusive(spark):
    rows = [("i", 0, 0, "a"), ("i", 300_000_000, 1, "b")]
    assert counted(spark, rows, windows={"w": 300})[1]["a_w"] == 1


def test_rows_without_key_or_time_are_dropped(spark):
    rows = [("i", 0, 0, "a"), (None, 0, 1, "a"), ("i", None, 2, "a")]
    assert set(counted(spark, rows)) == {0}


def test_bucket_must_divide_the_windows(spark):
    with pytest.raises(ValueError):
        counted(spark, [("i", 0, 0, "a")], bucket=4)


def test_hot_key_is_split_by_time(spark):
    """No window operator gets all rows of a key: the big one is partitioned by key and bucket."""
    kinds = {"a": F.col("kind") == "a"}
    df = rolling_counts(
        frame(spark, random_rows(1, 50)),
        key="k",
        ts=F.col("ts"),
        order=F.col("n"),
        measures=kinds,
        windows=WINDOWS,
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    keyed = [line for line in plan.splitlines() if "Window [" in line]
    assert len(keyed) == 4
    row_level = [line for line in keyed if "__le_" in line or "__lt_" in line]
    assert len(row_level) == 2
    assert all("__b" in line.rsplit("], [", 2)[-2] for line in row_level)
    # Bucket sums meet by key and day; by key alone there is one row a day.
    rest = [line.rsplit("], [", 2)[-2] for line in keyed if line not in row_level]
    assert sum("__span" in by for by in rest) == 1


@pytest.mark.parametrize("bucket", [1, 3, 1000])
def test_latest_values(spark, bucket):
    rows = random_rows(11, 300)
    df = latest_values(
        frame(spark, rows),
        key="k",
        ts=F.col("ts"),
        order="n",
        values={"last_a": F.when(F.col("kind") == "a", F.col("n"))},
        bucket_seconds=bucket,
    )
    got = {r["n"]: r["last_a"] for r in df.collect()}
    for k, t, n, _ in rows:
        before = [r for r in rows if r[0] == k and r[3] == "a" and (r[1], r[2]) <= (t, n)]
        assert got[n] == (max(before, key=lambda r: (r[1], r[2]))[2] if before else None)


def test_kth_rows_are_selected_without_a_running_total(spark):
    import random

    from crowdpulse.operators.sequences import kth_rows

    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "b"]), n, rng.randrange(5 * 86_400)) for n in range(400)]
    df = spark.createDataFrame(rows, "key string, n long, s long").withColumn("ts", F.timestamp_seconds(F.lit(1_767_225_600) + F.col("s")))
    found = kth_rows(df, key="key", ts=F.col("ts"), order=F.col("n"), numbers=(1, 10, 100, 1000))
    want = []
    for key in ("hot", "b"):
        own = sorted((s, n) for k, n, s in rows if k == key)
        want += [(key, k, own[k - 1][1]) for k in (1, 10, 100, 1000) if k <= len(own)]
    assert sorted((r["key"], r.k, r.n) for r in found.collect()) == sorted(want)
    # Rows are ranked within (key, bucket) only: no window over a whole key sees rows.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number" in line]
    assert ranked and all("__b" in line.split("windowspecdefinition")[1] for line in ranked)


def test_carried_sums_keep_a_hot_key_in_small_groups(spark):
    """One key with half of all buckets: what meets in a task is a day of its buckets, or its days."""
    from crowdpulse.operators.sequences import SPAN, sums_before

    n = 20_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("key"),
        (F.col("id") * 60_000_000).alias("__b"),
        F.lit(1).alias("w"),
    )
    out = sums_before(rows, ["key"], {"before": F.col("w")})
    got = {r["__b"]: r.before for r in out.filter("key = 'hot'").collect()}
    assert got == {120_000_000 * k: k for k in range(n // 2)}
    largest = rows.groupBy("key", F.floor(F.col("__b") / SPAN)).count().agg(F.max("count")).first()[0]
    assert largest <= 720 and rows.filter("key = 'hot'").select(F.floor(F.col("__b") / SPAN)).distinct().count() <= 15


def test_windows_from_first_equal_a_walk(spark):
    import random

    from crowdpulse.operators.counters import windows_from_first

    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([rng.randrange(50_000), 10 * rng.randrange(5_000)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "image_id string, s long").withColumn("ts", F.timestamp_seconds(F.lit(1_767_225_600) + F.col("s")))
    want = []
    for key in ("hot", "b"):
        start, count = None, 0
        for s in sorted(s for k, s in rows if k == key):
            if start is None or s >= start + 300:
                want += [(key, start, count)] if start is not None else []
                start, count = s, 0
            count += 1
        want.append((key, start, count))
    got = windows_from_first(df, 300).select("image_id", (F.unix_seconds("window_start") - 1_767_225_600), "event_count")
    assert sorted(map(tuple, got.collect())) == sorted(want)
