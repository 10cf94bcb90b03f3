"""Alerts with a bounded memory: an image alerts again once it was pushed out by later ones.

Per alert type the memory holds the last ``size`` alerts. A crossing alerts if its image is not
among them, so each decision depends on the alerts of all images before it. One task walking
through the whole sequence would not scale; here it is cut into blocks of time, and each block is
walked through from a guessed memory. Where the memory a block ends with is not the one the next
block began with, the next block is walked through again. The first block begins with the empty
memory, so each round makes at least one more block final, and what no longer changes is exact. The
guess is what no eviction would give, which is right at once for a memory larger than the images.

A task holds one type's crossings of one block; a memory holds ``size`` images.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.session import run_dir
from crowdpulse.sources.sinks import staged


def walk(keys: Iterable[str], before: Iterable[str], size: int) -> tuple[list[int], list[str]]:
    """Places of the keys that alert, and the memory after them, oldest first."""
    memory = deque(before)
    known, alerting = set(memory), []
    for place, key in enumerate(keys):
        if key in known:
            continue
        alerting.append(place)
        memory.append(key)
        known.add(key)
        if len(memory) > size:
            known.discard(memory.popleft())
    return alerting, list(memory)


def _newest(earlier: Column, later: Column, size: int) -> Column:
    """The last ``size`` entries of two lists, one after the other."""
    both = F.concat(earlier, later)
    return F.slice(both, F.greatest(F.size(both) - size + 1, F.lit(1)), size)


def alerts_with_memory(
    found: DataFrame, size: int, key: str = "image_id", order: str = "event_id", block_rows: int = 200_000
) -> DataFrame:
    """The rows of ``found`` (see ``alerts.crossings``) that alert when ``size`` images are remembered per type.

    Rows count in the order of time, then ``order``. Rows without key, type or time are left out;
    no rows give none. ``block_rows`` bounds the rows of a task; the result does not depend on it.
    """
    if size < 1:
        raise ValueError(f"a memory of {size} images")
    spark = found.sparkSession
    folder = run_dir(spark, "alert-memory")
    rows = staged(found.dropna(subset=[key, "alert_type", "ts"]), f"{folder}/found")
    blocks = max(1, -(-rows.count() // block_rows))
    # Range partitions come in order; written once, a block's rows stay the same.
    placed = rows.repartitionByRange(blocks, "ts", order).withColumn("__block", F.spark_partition_id())
    placed = staged(placed, f"{folder}/placed")
    cell = Window.partitionBy("alert_type", "__block").orderBy("ts", order)
    numbered = placed.withColumn("__n", F.row_number().over(cell)).withColumn("__prev", F.lag(key).over(cell))
    # Right after its own crossing an image is always remembered.
    numbered = numbered.filter(~F.col("__prev").eqNullSafe(F.col(key))).drop("__prev")
    numbered = staged(numbered.withColumn("__id", F.col(key).cast("string")), f"{folder}/numbered")

    every = rows.select("alert_type").distinct()
    every = every.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    todo = staged(_guess(numbered, every, size, blocks, folder), f"{folder}/todo-0")
    walked = None
    for round_ in range(blocks):
        done = staged(_walk_blocks(numbered, todo, size), f"{folder}/walked-{round_}")
        if walked is not None:
            kept = walked.join(todo, ["alert_type", "__block"], "left_anti")
            done = staged(kept.unionByName(done), f"{folder}/all-{round_}")
        walked = done
        ended = walked.select("alert_type", (F.col("__block") + 1).alias("__block"), F.col("after").alias("before"))
        began = walked.select("alert_type", "__block", F.col("before").alias("__began"))
        todo = ended.join(began, ["alert_type", "__block"]).filter("before != __began").drop("__began")
        todo = staged(todo, f"{folder}/todo-{round_ + 1}")
        if todo.isEmpty():
            break
    alerting = walked.select("alert_type", "__block", F.explode("alerting").alias("__n"))
    return numbered.join(alerting, ["alert_type", "__block", "__n"]).select(*found.columns)


def _guess(numbered: DataFrame, every: DataFrame, size: int, blocks: int, folder: str) -> DataFrame:
    """(alert_type, __block, before): the ``size`` newest images of which a crossing came before the block.

    Newest by first crossing. Lists of twice as many blocks are joined in each of log2(blocks) rounds.
    """
    first = numbered.groupBy("alert_type", "__id").agg(F.min(F.struct("__block", "__n")).alias("f"))
    rank = Window.partitionBy("alert_type", "f.__block").orderBy(F.desc("f.__n"))
    newest = first.withColumn("__r", F.row_number().over(rank)).filter(F.col("__r") <= size)
    own = newest.groupBy("alert_type", (F.col("f.__block") + 1).alias("__block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("f.__n", "__id"))), lambda e: e["__id"]).alias("before")
    )
    none = F.array().cast("array<string>")
    lists = every.join(own, ["alert_type", "__block"], "left").withColumn("before", F.coalesce("before", none))
    step = 1
    while step < blocks:
        lists = staged(lists, f"{folder}/guess-{step}")
        earlier = lists.select("alert_type", (F.col("__block") + step).alias("__block"), F.col("before").alias("e"))
        lists = lists.join(earlier, ["alert_type", "__block"], "left").select(
            "alert_type", "__block", _newest(F.coalesce("e", none), F.col("before"), size).alias("before")
        )
        step *= 2
    return lists


def _walk_blocks(numbered: DataFrame, todo: DataFrame, size: int) -> DataFrame:
    """(alert_type, __block, before, alerting, after) of the blocks of ``todo``."""

    def one(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if start.empty:
            return pd.DataFrame(columns=["alert_type", "__block", "before", "alerting", "after"])
        rows = rows.sort_values("__n")
        before = list(start["before"].iloc[0])
        places, after = walk(rows["__id"], before, size)
        numbers = rows["__n"].iloc[places].tolist()
        where = start[["alert_type", "__block"]].reset_index(drop=True)
        return where.assign(before=[before], alerting=[numbers], after=[after])

    keys = ["alert_type", "__block"]
    return (
        numbered.select(*keys, "__n", "__id")
        .join(todo.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .cogroup(todo.groupBy(*keys))
        .applyInPandas(one, "alert_type string, __block int, before array<string>, alerting array<int>, after array<string>")
    )
