"""Bounded alert memory: blocks walked through in parallel equal one walk through everything."""

import random
from collections import OrderedDict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from crowdpulse.operators import memory

START = datetime(2026, 1, 1)
SCHEMA = "image_id string, alert_type string, ts timestamp, event_id long, metric string, value long"


def plain(rows, size):
    """One memory per type, looked at row by row."""
    memories, out = {}, []
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        kept = memories.setdefault(r[1], OrderedDict())
        if r[0] in kept:
            continue
        kept[r[0]] = True
        out.append(r)
        if len(kept) > size:
            kept.popitem(last=False)
    return sorted(out)


def crossings(seed, n, images, hot=0.3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        image = "hot" if rng.random() < hot else f"i{rng.randrange(images)}"
        # Several crossings at one time: the event decides.
        rows.append((image, rng.choice(["viral", "popular"]), START + timedelta(seconds=rng.randrange(n // 3)), k, "m", 1))
    return rows


def found(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [1, 2, 10, 1000])
def test_blocks_equal_one_walk(spark, size):
    rows = crossings(size, 900, 30)
    got = memory.alerts_with_memory(found(spark, rows), size, block_rows=150)
    assert as_rows(got) == plain(rows, size)


def test_result_does_not_depend_on_blocks(spark):
    rows = crossings(7, 400, 12, hot=0.0)
    whole = as_rows(memory.alerts_with_memory(found(spark, rows), 5, block_rows=10_000))
    assert whole == plain(rows, 5)
    # Images in turn, one more than the memory holds: every start memory but the first depends on the one before.
    turns = [(f"i{k % 6}", "viral", START + timedelta(seconds=k), k, "m", 1) for k in range(300)]
    turns = turns[:100] + [("i0", "viral", START + timedelta(seconds=99), 1000, "m", 1)] + turns[100:]
    assert as_rows(memory.alerts_with_memory(found(spark, turns), 5, block_rows=60)) == plain(turns, 5)


def test_large_memory_alerts_once(spark):
    rows = crossings(3, 600, 40)
    once = {(r[0], r[1]) for r in rows}
    got = as_rows(memory.alerts_with_memory(found(spark, rows), 1000, block_rows=100))
    assert len(got) == len(once) and {(r[0], r[1]) for r in got} == once


def test_edges(spark):
    empty = found(spark, [])
    assert memory.alerts_with_memory(empty, 3).collect() == []
    odd = found(spark, [(None, "viral", START, 1, "m", 1), ("a", None, START, 2, "m", 1), ("a", "viral", None, 3, "m", 1), ("a", "viral", START, 4, "m", 1)])
    assert [r.event_id for r in memory.alerts_with_memory(odd, 1).collect()] == [4]
    with pytest.raises(ValueError):
        memory.alerts_with_memory(empty, 0)


def test_keys_and_orders_of_other_types(spark):
    rows = found(spark, crossings(5, 200, 8)).withColumn("user_id", F.crc32("image_id")).drop("image_id")
    rows = rows.withColumn("arrival", F.struct(F.col("ts").alias("arrived_at"), F.lit(0).alias("partition"), F.col("event_id").alias("offset")))
    got = memory.alerts_with_memory(rows, 3, key="user_id", order="arrival", block_rows=50)
    assert got.dtypes == rows.dtypes
    raw = [(r.user_id, r.alert_type, r.ts, r.event_id) for r in rows.collect()]
    assert sorted((r.user_id, r.alert_type, r.ts, r.event_id) for r in got.collect()) == plain(raw, 3)
