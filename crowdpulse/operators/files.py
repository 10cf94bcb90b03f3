"""Image files in split and class folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions.content import IMAGE_FILE, category_of_path, class_folder

# The folders that hold image files.
SPLITS = ("training", "validation", "evaluation")


def image_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Image files only, with split, class folder and category read off the path."""
    p = F.col(path)
    return paths.filter(p.rlike(IMAGE_FILE)).withColumns(
        {
            "split": F.regexp_extract(p, "/(" + "|".join(SPLITS) + ")/", 1),
            "class": F.regexp_extract(p, r"/([^/]+)/[^/]*$", 1),
            "category": category_of_path(p),
        }
    )


def sorted_into_classes(names: DataFrame, split: str = "split", name: str = "name") -> DataFrame:
    """Target path of flat `N_x.jpg` files: {split}/class_NN/N_x.jpg; other files stay where they are."""
    folder = class_folder(F.col(name))
    return names.withColumn("path", F.concat_ws("/", F.lit(""), F.col(split), folder, F.col(name)))


def files_per_class(files: DataFrame) -> DataFrame:
    """File counts per class, per split (class `SUBTOTAL`) and over all (`TOTAL`)."""
    level = F.grouping_id()
    return (
        files.rollup("split", "class")
        .agg(F.count("*").alias("files"), level.alias("__level"))
        .select(
            F.when(F.col("__level") == 3, "TOTAL").otherwise(F.col("split")).alias("split"),
            F.when(F.col("__level") == 3, "TOTAL")
            .when(F.col("__level") == 1, "SUBTOTAL")
            .otherwise(F.col("class"))
            .alias("class"),
            "files",
        )
    )
