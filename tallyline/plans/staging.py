"""Results written once as Parquet in a folder that all executors share.

A staged table survives the loss of any executor, keeps its true size for the
planner, and is read back with column pruning and filters.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder in the warehouse if that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as soon as each query ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Staging:
    """Tables and folders of one run of an operator.

    ``keep`` writes a table and reads it back; ``drop`` removes tables whose
    readers are done.  What is left goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tallyline-{name}-{uuid.uuid4().hex}"
        self._made = 0
        self._paths: dict[int, str] = {}
        files, path = file_system(spark, self.root)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def folder(self, name: str) -> str:
        """A fresh folder's path with its scheme, for writers of other formats."""
        self._made += 1
        files, path = file_system(self.spark, f"{self.root}/{self._made:03d}-{name}")
        return files.makeQualified(path).toString()

    def keep(self, df: DataFrame, name: str = "table", partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
        path = self.folder(name)
        with shuffles_dropped(self.spark):
            df.write.parquet(path, partitionBy=partition_by, compression=compression)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        stored._tallyline_staging = self  # the id stays taken as long as the entry is used
        return stored

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path:
                self.remove(path)

    def drop_partition(self, table: DataFrame, column: str, value: int) -> None:
        """Of a table kept by that column; other partitions can still be read."""
        self.remove(f"{self._paths[id(table)]}/{column}={value}")

    def remove(self, path: str) -> None:
        files, hadoop = file_system(self.spark, path)
        files.delete(hadoop, True)
