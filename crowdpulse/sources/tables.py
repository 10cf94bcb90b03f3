"""Table scans: relational, Parquet, catalog, snapshots, image files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.schemas import TABLES


def jdbc_table(
    spark: SparkSession, url: str, table: str, *, partition: tuple[str, str, str, int] | None = None, **options: str
) -> DataFrame:
    """A relational table. ``partition`` = (column, lower, upper, tasks) reads it in parallel.

    Filters and column lists are pushed to the database by Spark.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition:
        column, lower, upper, tasks = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", tasks)
        )
    return reader.load()


def parquet_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A Parquet table, with the fixed schema when it is one of the known tables."""
    reader = spark.read
    if table in TABLES:
        reader = reader.schema(TABLES[table])
    return reader.parquet(path)


def raw_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    return parquet_table(spark, f"{root}/raw/{table}/latest.parquet", table)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# A snapshot table has folders base=B/snapshot_id=N. Appended snapshots share the
# base of the last replacement (0 before the first); a replacing snapshot starts its
# own. The questions below list folders and open no file.


def snapshots(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(base, snapshot id) of all snapshots of a table, in order of the id."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/base=*/snapshot_id=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [str(f.getPath()).rstrip("/").split("/")[-2:] for f in found]
    return sorted(((int(b.split("=")[1]), int(s.split("=")[1])) for b, s in names), key=lambda x: x[::-1])


def current_snapshot(spark: SparkSession, path: str) -> int:
    """Highest snapshot id of a snapshot table."""
    return snapshots(spark, path)[-1][1]


def base_of(spark: SparkSession, path: str, snapshot_id: int | None = None) -> int:
    """The last replacement up to a snapshot (or at all); 0 for none or no table."""
    return max((b for b, s in snapshots(spark, path) if snapshot_id is None or s <= snapshot_id), default=0)


def read_as_of(spark: SparkSession, path: str, snapshot_id: int) -> DataFrame:
    """The table as it was at a snapshot: what was appended up to it since the last replacement.

    Other folders are pruned.
    """
    base = base_of(spark, path, snapshot_id)
    rows = spark.read.parquet(path).filter((F.col("base") == base) & (F.col("snapshot_id") <= snapshot_id))
    return rows.drop("base")


def rows_of(spark: SparkSession, path: str, snapshot_id: int) -> DataFrame:
    """The rows one snapshot wrote, without those of earlier ones: the content of a full rebuild."""
    return read_as_of(spark, path, snapshot_id).filter(F.col("snapshot_id") == snapshot_id)


def newest_per_row(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key out of repeated appends: the one of the latest snapshot."""
    rest = [c for c in rows.columns if c not in (*keys, "snapshot_id")]
    return (
        rows.groupBy(*keys)
        .agg(F.max(F.struct("snapshot_id", *rest)).alias("__n"))
        .select(*keys, "__n.*")
    )


def iceberg_as_of(spark: SparkSession, table: str, snapshot_id: int) -> DataFrame:
    """Snapshot read of an Iceberg table; needs the Iceberg runtime on the class path."""
    return spark.read.option("snapshot-id", snapshot_id).format("iceberg").load(table)


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Paths, sizes and times of all files below a folder; their content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
