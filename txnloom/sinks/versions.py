"""Folders of micro-batches that are compacted in place.

A log holds one folder ``log=batch-N`` per micro-batch and, after compactions, one ``log=base-N`` that
replaces all batches up to N. A base counts once its success marker is there, so a reader's list of folders has either
the base or the batches it replaces, never both. Folders that a base replaced are removed by the next
compaction, so readers that listed them before can finish.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import exists, hadoop_path


class BatchLog:
    """Rows of micro-batches under ``path``; one writer, any number of readers."""

    def __init__(self, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()):
        self.path, self.schema, self.partition_by = path.rstrip("/"), schema, partition_by

    def folder(self, batch_id: int, kind: str = "batch") -> str:
        return f"{self.path}/log={kind}-{batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Store a batch; a replay overwrites it."""
        self._put(df, self.folder(batch_id))

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self._get(spark, [self.folder(batch_id)])

    def _put(self, df: DataFrame, folder: str) -> None:
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(folder)

    def _get(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders).select(*self.schema.fieldNames())

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        """Numbers of the folders that were written to their end."""
        _, root, fs = hadoop_path(spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        found = sorted(int(n.rsplit("-", 1)[1]) for n in names if n.startswith(f"log={kind}-"))
        return [n for n in found if exists(spark, f"{self.folder(n, kind)}/_SUCCESS")]

    def folders(self, spark: SparkSession) -> list[str]:
        """What a reader takes now: the newest base and the batches after it."""
        base = max(self._numbers(spark, "base"), default=-1)
        later = [self.folder(n) for n in self._numbers(spark, "batch") if n > base]
        return ([self.folder(base, "base")] if base >= 0 else []) + later

    def parts(self, spark: SparkSession, folder: str) -> list[str]:
        """Values of the one partition column inside a folder."""
        _, root, fs = hadoop_path(spark, folder)
        found = [s.getPath().getName().split("=", 1) for s in fs.listStatus(root) if s.isDirectory()]
        return sorted(f[1] for f in found if f[0] == self.partition_by[0])

    def latest(self, spark: SparkSession) -> int:
        """Number of the newest batch, -1 if there is none."""
        return max([*self._numbers(spark, "batch"), *self._numbers(spark, "base")], default=-1)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._get(spark, self.folders(spark))

    def compact(self, spark: SparkSession, batch_id: int, merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
        """Put everything up to a stored batch into one folder; ``merge`` may drop or join rows."""
        bases = self._numbers(spark, "base")
        if batch_id in bases:
            return
        replaced = max(bases, default=-1)
        self._put(merge(self.read(spark)), self.folder(batch_id, "base"))
        gone = [(n, "batch") for n in self._numbers(spark, "batch") if n <= replaced] + [(n, "base") for n in bases if n < replaced]
        for n, kind in gone:
            _, old, fs = hadoop_path(spark, self.folder(n, kind))
            fs.delete(old, True)
