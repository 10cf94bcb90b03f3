"""Keyed state in shared storage: hash buckets of the key, each with a fold and the batches after it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Fold = Callable[[DataFrame], DataFrame]


class BucketTable:
    """Rows by key in ``buckets`` hash buckets, read and folded bucket by bucket.

    A batch writes one folder per bucket it has rows for, ``bucket=B/batch_id=N``, and reads back
    only the buckets it touches. When a touched bucket has ``fold_every`` batches since its last
    fold, they are folded into ``bucket=B/folded=N`` (all batches before N), and what the fold before
    that one replaced is deleted: a reader that started before the fold still finds its files. So a
    batch's cost depends on its own buckets, not on the batches before it nor on keys elsewhere.

    Every folder is replaced as a whole, and a batch reads only folders of earlier batches, so a
    repeated batch finds the same state and leaves the same table. The number of buckets is part of
    the table: opening it with another one is an error.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = 16, fold_every: int = 8):
        self.spark, self.schema, self.key = spark, schema, key
        self.buckets, self.fold_every = buckets, fold_every
        self.path = f"{path}/of={buckets}"
        others = {n for n in re.findall(r"/of=(\d+)", self._glob(f"{path}/of=*")) if int(n) != buckets}
        if others:
            raise ValueError(f"{path} has {', '.join(sorted(others))} buckets, not {buckets}")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, "batch_id", batch_id)

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        placed = rows.select(*self.schema.names, self.bucket().alias("bucket"), F.lit(number).alias(kind))
        # Dynamic overwrite replaces the folders of this batch only. A large bucket is split over tasks.
        (
            placed.hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", kind)
            .parquet(self.path)
        )

    def touched(self, batch_id: int) -> list[int]:
        """The buckets a batch has rows in: at most ``buckets`` numbers."""
        found = self._glob(f"{self.path}/bucket=*/batch_id={batch_id}")
        return sorted(int(b) for b in re.findall(r"/bucket=(\d+)/", found))

    def batch(self, batch_id: int) -> DataFrame:
        return self._read([f"{self.path}/bucket={b}/batch_id={batch_id}" for b in self.touched(batch_id)])

    def before(self, batch_id: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of all earlier batches in some buckets (by default all)."""
        return self._read(self.folders(batch_id, buckets))

    def current(self) -> DataFrame:
        return self.before(1 << 62)

    def folders(self, batch_id: int, buckets: list[int] | None = None) -> list[str]:
        """The folders that make up the state before a batch."""
        out = []
        for b, (folds, batches) in sorted(self._listing(buckets).items()):
            start = max((n for n in folds if n <= batch_id), default=0)
            out += [f"{self.path}/bucket={b}/folded={start}"] if start else []
            out += [f"{self.path}/bucket={b}/batch_id={n}" for n in batches if start <= n < batch_id]
        return out

    def fold(self, batch_id: int, buckets: list[int], fold: Fold) -> None:
        """Fold those of the given buckets that have enough earlier batches; call it before reading them."""
        due, old = [], []
        for b, (folds, batches) in self._listing(buckets).items():
            last = max((n for n in folds if n <= batch_id), default=0)
            if sum(last <= n < batch_id for n in batches) < self.fold_every or last == batch_id:
                continue
            due.append(b)
            old += [f"{self.path}/bucket={b}/folded={n}" for n in folds if n < last]
            old += [f"{self.path}/bucket={b}/batch_id={n}" for n in batches if n < last]
        if not due:
            return
        self._write(fold(self.before(batch_id, due)), "folded", batch_id)
        for folder in old:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def _listing(self, buckets: list[int] | None) -> dict[int, tuple[list[int], list[int]]]:
        """Folds and batches of each bucket, in order."""
        if buckets is not None and not buckets:
            return {}
        wanted = "*" if buckets is None else "{" + ",".join(map(str, buckets)) + "}"
        out: dict[int, tuple[list[int], list[int]]] = {}
        for b, kind, n in re.findall(r"/bucket=(\d+)/(folded|batch_id)=(\d+)", self._glob(f"{self.path}/bucket={wanted}/*")):
            out.setdefault(int(b), ([], []))[kind == "batch_id"].append(int(n))
        return {b: (sorted(folds), sorted(batches)) for b, (folds, batches) in out.items()}

    def _glob(self, pattern: str) -> str:
        """Names of the folders that match, as one text (one call, however many there are)."""
        jvm = self.spark._jvm
        return jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(jvm.org.apache.hadoop.fs.Path(pattern)).mkString(" ")
