"""Reading the given tables and cutting lineage with tables in the shared folder."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
from pathlib import Path

import crowdpulse
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.session import run_dir


#: Rows and bytes of an Arrow batch: Spark's defaults, and smaller ones for long texts, of which a
#: worker holds a batch several times over.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b"),
}


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers, which need not have it installed. Once per application.

    Batches sent to them get smaller, unless the session has set a size of its own.
    """
    for name, (default, smaller) in BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, smaller)
    context = spark.sparkContext
    name = f"crowdpulse-{context.applicationId}.zip"
    if not any(os.path.basename(f) == name for f in context.listFiles + list(context._python_includes)):
        parent = Path(crowdpulse.__file__).resolve().parents[1]
        base = os.path.join(tempfile.mkdtemp(prefix="ship-"), name.removesuffix(".zip"))
        context.addPyFile(shutil.make_archive(base, "zip", parent, "crowdpulse"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    A lost executor costs a rerun of the tasks that read the table, not of what made it.
    The folder goes when the application ends.
    """
    spark = df.sparkSession
    folder = run_dir(spark, name)
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Free the shuffle files of finished steps now; Spark drops them when the driver collects garbage."""
    for _ in range(2):  # what Python let go first, then what that held
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; without this they stay until the application ends."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark._jvm
        for file in table.inputFiles():
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            break  # a staged table is one folder


def text_of(column: str = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """Whole rows as one column ``_doc`` beside ``more``, so that columns of any names can be joined to them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"), *more)


def unpacked(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``_doc``, some of them changed."""
    return [changed.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns]


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """The rows no model may learn from: crc32 of the id as text leaves 0. A null id is held out."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(rest == 0, F.lit(True))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)), F.lit(0))
