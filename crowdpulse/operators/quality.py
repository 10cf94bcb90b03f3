"""Constraints of the tables as reports: each returns the rows that break a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crowdpulse.params import IMAGE_SOURCES, REVIEW_STATUSES, TARGET_TYPES

# Column defaults and required columns of each table.
DEFAULTS = {
    "users": {"tos_version_accepted": 1, "is_test_account": False},
    "images": {"source": "user_upload", "views": 0},
    "comments": {"moderator_hidden": False},
    "flags": {"review_status": "pending"},
    "moderation": {"policy_version": "v1"},
}
REQUIRED = {
    "users": ("id", "username", "tos_version_accepted", "is_test_account"),
    "images": ("id", "user_id", "s3_url", "source"),
    "comments": ("id", "image_id", "user_id", "content", "moderator_hidden"),
    "flags": ("id", "user_id", "reason", "review_status"),
    "moderation": ("id", "target_type", "target_id", "inference_mode", "risk_score", "policy_version"),
}
# Fixed values: (child table, child column, parent table); parents are keyed by id.
FOREIGN_KEYS = (
    ("images", "user_id", "users"),
    ("comments", "image_id", "images"),
    ("comments", "user_id", "users"),
    ("comments", "moderator_action_id", "moderation"),
    ("flags", "user_id", "users"),
    ("flags", "image_id", "images"),
    ("flags", "comment_id", "comments"),
    ("flags", "moderation_action_id", "moderation"),
)


def checks(table: str, this_year: Column | int) -> dict[str, Column]:
    """Check constraints of a table; a check passes when its value is null."""
    c = F.col
    by_table = {
        "users": {
            "tos_version": c("tos_version_accepted") >= 1,
            "year_of_birth": c("year_of_birth").between(F.lit(1900), F.lit(this_year)),
        },
        "images": {"source": c("source").isin(*IMAGE_SOURCES)},
        "comments": {},
        "flags": {
            "target": c("image_id").isNotNull() | c("comment_id").isNotNull(),
            "review_status": c("review_status").isin(*REVIEW_STATUSES),
        },
        "moderation": {
            "target_type": c("target_type").isin(*TARGET_TYPES),
            "risk_score": c("risk_score").between(0, 1),
        },
    }
    return by_table[table]


def check_violations(rows: DataFrame, table: str, this_year: Column | int, key: str = "id") -> DataFrame:
    """(table, rule, row key) for every failed check, all rules of a table in one pass."""
    rules = checks(table, this_year)
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()])
    )
    return rows.select(
        F.lit(table).alias("table"),
        F.explode(broken).alias("rule"),
        F.col(key).cast("string").alias("row_key"),
    )


def with_defaults(rows: DataFrame, table: str) -> DataFrame:
    return rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS[table].items() if c in rows.columns}
    )


def default_usage(rows: DataFrame, table: str) -> DataFrame:
    """Rows per value of each column with a default, after the defaults, in one pass."""
    names = [c for c in DEFAULTS[table] if c in rows.columns]
    pairs = [
        F.struct(F.lit(f"{table}.{c}").alias("column"), F.col(c).cast("string").alias("value")) for c in names
    ]
    return (
        with_defaults(rows, table)
        .select(F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.column", "p.value")
        .agg(F.count("*").alias("rows"))
    )


def null_counts(rows: DataFrame, table: str) -> DataFrame:
    """Nulls per required column of the table, counted in one pass."""
    names = [c for c in REQUIRED[table] if c in rows.columns]
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column", "nulls").select(F.lit(table).alias("table"), "column", "nulls")


def foreign_key_violations(
    children: dict[str, DataFrame],
    parents: dict[str, DataFrame],
    keys: tuple[tuple[str, str, str], ...] = FOREIGN_KEYS,
) -> DataFrame:
    """Missing parents per constraint with the number of child rows that name them.

    Child references and parents go through one shuffle on (parent table, key), counted before
    it: a hot parent is one row per task. Every table is read once.
    """
    present = [k for k in keys if k[0] in children and k[1] in children[k[0]].columns]
    names = list(parents)
    kinds = {children[c].schema[column].dataType for c, column, _ in present}
    kinds |= {parents[p].schema["id"].dataType for p in names}
    # Ids of one type are compared as they are; constraint and parent travel as numbers.
    kind = kinds.pop() if len(kinds) == 1 else StringType()
    named = []
    for table, rows in children.items():
        refs = [
            F.struct(
                F.lit(number).alias("c"),
                F.lit(names.index(parent)).alias("p"),
                F.col(column).cast(kind).alias("k"),
            )
            for number, (child, column, parent) in enumerate(present)
            if child == table
        ]
        if refs:
            named.append(rows.select(F.explode(F.array(*refs)).alias("r")).select("r.*"))
    known = [parents[n].select(F.lit(-1).alias("c"), F.lit(i).alias("p"), F.col("id").cast(kind).alias("k")) for i, n in enumerate(names)]
    counts = [F.count_if(F.col("c") == number).alias(f"n{number}") for number in range(len(present))]
    met = (
        reduce(DataFrame.unionByName, [*named, *known])
        .filter(F.col("k").isNotNull())
        .groupBy("p", "k")
        .agg(F.max(F.col("c") == -1).alias("known"), *counts)
        .filter("not known")
    )
    found = F.array(
        *[
            F.struct(F.lit(f"{child}.{column}").alias("constraint"), F.col(f"n{number}").alias("child_rows"))
            for number, (child, column, _) in enumerate(present)
        ]
    )
    rows = met.select("k", F.explode(found).alias("f")).filter("f.child_rows > 0")
    return rows.select("f.constraint", F.col("k").cast("string").alias("missing_key"), "f.child_rows")


def unique_violations(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def table_profile(rows: DataFrame) -> DataFrame:
    """Schema with row and value counts: one line per column."""
    kinds = F.create_map(*[F.lit(x) for f in rows.schema for x in (f.name, f.dataType.simpleString())])
    counted = rows.agg(
        F.count("*").alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns]
    )
    return counted.unpivot("__rows", rows.columns, "column", "present").select(
        "column", kinds[F.col("column")].alias("type"), F.col("__rows").alias("row_count"), "present"
    )


def first_rows(rows: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return rows.orderBy(*order).limit(n)
