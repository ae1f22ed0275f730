"""Cutting lineage in storage that outlives any executor.

Tables are Parquet in the shared folder (see ``staging``): they have their
true size for the planner, and are read with column pruning and filters.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from .staging import Staging, shuffles_dropped


def checkpointed(df: DataFrame) -> DataFrame:
    return Staging(df.sparkSession, "table").keep(df)


def release(*tables: DataFrame) -> None:
    """Deletes what ``checkpointed`` has stored, when no plan reads it any more."""
    for table in tables:
        staging = getattr(table, "_tallyline_staging", None)
        if staging:
            staging.drop(table)


def checkpointed_by(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Stored as a table bucketed and sorted by ``keys``.

    Loops join against the result without shuffling or sorting it again.  The
    files are in the shared folder; the catalog knows the table only until its
    reader is made, so that no entry outlives the files.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tallyline_{uuid.uuid4().hex}"
    folder = Staging(spark, "buckets").folder(name)
    dealt = df.repartition(n, *keys)
    with shuffles_dropped(spark):
        dealt.write.format("parquet").bucketBy(n, *keys).sortBy(*keys).option("path", folder).saveAsTable(name)
    stored = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")  # of an external table only the entry goes
    return stored
