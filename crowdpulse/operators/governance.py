"""Who and what may enter training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def birth_year(users: DataFrame) -> Column:
    """The year as a number; text that is none becomes null."""
    year = F.col("year_of_birth")
    if isinstance(users.schema["year_of_birth"].dataType, StringType):
        return year.try_cast("double")
    return year


def actor_policy(users: DataFrame) -> DataFrame:
    """Id, test mark and birth year of every account."""
    return users.select(
        F.col("id").alias("actor_id"),
        F.coalesce("is_test_account", F.lit(False)).alias("is_test_account"),
        birth_year(users).alias("year_of_birth"),
    )


def known_minor(at: Column, birth_year: Column, adult_age: int = 18) -> Column:
    """Calendar-year age below ``adult_age``; an unknown birth year is not a minor."""
    return F.coalesce(F.year(at) - birth_year < adult_age, F.lit(False))


def deleted(rows: DataFrame) -> Column:
    return F.col("deleted_at").isNotNull() if "deleted_at" in rows.columns else F.lit(False)


def images_with_policy(images: DataFrame, users: DataFrame, adult_age: int = 18) -> DataFrame:
    """Images of known uploaders with the three exclusion marks."""
    uploader = users.select(
        F.col("id").alias("user_id"),
        F.col("created_at").alias("user_created_at"),
        F.coalesce("is_test_account", F.lit(False)).alias("uploader_is_test"),
        birth_year(users).alias("__birth_year"),
    )
    return (
        images.join(uploader, "user_id")
        .withColumn("uploader_is_minor", known_minor(F.col("created_at"), F.col("__birth_year"), adult_age))
        .withColumn("image_is_deleted", deleted(images))
        .drop("__birth_year")
    )


def eligible_images(images: DataFrame, users: DataFrame, adult_age: int = 18) -> DataFrame:
    return (
        images_with_policy(images, users, adult_age)
        .filter(~F.col("uploader_is_test") & ~F.col("uploader_is_minor") & ~F.col("image_is_deleted"))
        .drop("uploader_is_test", "uploader_is_minor", "image_is_deleted")
    )


def eligibility_summary(marked: DataFrame) -> DataFrame:
    """One pass over :func:`images_with_policy`; the reasons overlap."""
    test, minor, gone = (
        F.col("uploader_is_test"),
        F.col("uploader_is_minor"),
        F.col("image_is_deleted"),
    )
    return marked.agg(
        F.count("*").alias("total_images"),
        F.count_if(test).alias("excluded_test"),
        F.count_if(minor).alias("excluded_minor"),
        F.count_if(gone).alias("excluded_deleted"),
        F.count_if(~test & ~minor & ~gone).alias("remaining"),
    )


def eligible_actions(actions: DataFrame, users: DataFrame, adult_age: int = 18) -> DataFrame:
    """Comments or flags whose actor is no test account and no known minor, not deleted.

    An actor without account row is allowed. A hot actor is on the left (many)
    side only, which the adaptive skew join splits.
    """
    joined = actions.join(actor_policy(users), F.col("user_id") == F.col("actor_id"), "left")
    return joined.filter(
        ~F.coalesce("is_test_account", F.lit(False))
        & ~known_minor(F.col("created_at"), F.col("year_of_birth"), adult_age)
        & ~deleted(actions)
    ).select(*actions.columns)


def stable_ids(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Ids as text, nulls kept."""
    return rows.withColumns({c: F.col(c).cast("string") for c in columns if c in rows.columns})


def without_excluded(training: DataFrame, excluded: DataFrame, key: str = "image_id") -> DataFrame:
    """Training rows whose image was not excluded later: the content of the next snapshot."""
    return training.join(excluded.select(key).distinct(), key, "left_anti")
