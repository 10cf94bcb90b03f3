"""Text and content expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdpulse.params import CATEGORIES, CATEGORY_COLUMNS

IMAGE_FILE = r"(?i)\.(jpe?g|png)$"


def present(text: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(text.cast("string"), F.lit("")) != ""


def caption_length(caption: Column) -> Column:
    return F.length(F.coalesce(caption, F.lit("")))


def has_caption(caption: Column) -> Column:
    return F.when(caption_length(caption) > 0, 1).otherwise(0)


def category_or(category: Column, default: str = "Unknown") -> Column:
    return F.coalesce(F.nullif(category, F.lit("")), F.lit(default))


def one_hot(category: Column) -> dict[str, Column]:
    """One 0/1 column per category; surrounding blanks are ignored, unknown is all zero."""
    name = F.trim(F.coalesce(category, F.lit("Unknown")))
    return {c: (name == v).cast("int") for c, v in zip(CATEGORY_COLUMNS, CATEGORIES)}


def file_extension(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def object_key(file_id: Column, name: Column) -> Column:
    return F.concat_ws(".", file_id, file_extension(name))


def object_url(endpoint: str, bucket: str, key: Column) -> Column:
    return F.concat_ws("/", F.lit(endpoint), F.lit(bucket), key)


def short_id(identifier: Column) -> Column:
    return F.substring(identifier.cast("string"), 1, 8)


def class_folder(file_name: Column) -> Column:
    """`3_17.jpg` belongs to folder `class_03`."""
    number = F.regexp_extract(file_name, r"^(\d+)_", 1)
    return F.when(number != "", F.concat(F.lit("class_"), F.lpad(number, 2, "0")))


def category_of_path(path: Column) -> Column:
    """Category of a file by its `class_NN` parent folder, else 'Unknown'."""
    index = F.regexp_extract(path, r"/class_(\d+)/[^/]*$", 1).try_cast("int")
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    return F.coalesce(F.try_element_at(names, index + 1), F.lit("Unknown"))
