"""The stored inverted index: flat postings, or bitmaps, sorted by term.

Files are ranges of the key: a term lookup skips all other files by their
Parquet statistics, a term found in most documents is cut over as many files as
it needs, and a bloom filter on the term tells files apart whose range holds it
but that do not.

The table form is a catalog table whose location is one immutable version of
the index.  A new version is written beside the old one, then the location is
switched, so a reader that has resolved the table keeps the files it knows.
Old versions stay until ``drop_versions``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..plans.durable import checkpointed, release
from ..plans.staging import file_system

TERMS_IN_A_FILE = 100_000  # what a file's bloom filter is laid out for


def _write(rows: DataFrame, path: str, key: Sequence[str], stored: bool) -> None:
    """Rows not ``stored`` are stored first: the range partitioner samples them before it deals them out."""
    table = rows if stored else checkpointed(rows)
    ordered = table.repartitionByRange(*key).sortWithinPartitions(*key)
    ordered.write.option("parquet.bloom.filter.enabled#term", "true").option(
        "parquet.bloom.filter.expected.ndv#term", str(TERMS_IN_A_FILE)
    ).mode("overwrite").parquet(path)
    if not stored:
        release(table)


def write_index(
    postings: DataFrame, path: str | None = None, table: str | None = None, key: Sequence[str] = ("term", "docno"),
    versions: str | None = None, stored: bool = False,
) -> str:
    """Writes an index with a column ``term``; returns the path of its files.

    With ``path`` an earlier index there is replaced.  With ``table`` a new
    version becomes the table's; ``versions`` is the folder of all versions,
    needed when the table is new.  The postings are read twice; unless they are
    ``stored`` already, they are stored first.
    """
    if not table:
        _write(postings, path, key, stored)
        return path
    spark = postings.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        versions = _location(spark, table).rsplit("/", 1)[0]
    location = f"{versions.rstrip('/')}/version-{uuid.uuid4().hex}"
    _write(postings, location, key, stored)
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=location, source="parquet", schema=postings.schema)
    return location


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0].rstrip("/")


def read_index(spark: SparkSession, path: str | None = None, table: str | None = None) -> DataFrame:
    """The index; of a table, the version that is current now."""
    if table:
        spark.catalog.refreshTable(table)
        return spark.read.parquet(_location(spark, table))
    return spark.read.parquet(path)


def drop_versions(spark: SparkSession, table: str) -> int:
    """Deletes all versions but the current one, when no reader needs them; their number."""
    current = _location(spark, table)
    folder, name = current.rsplit("/", 1)
    files, path = file_system(spark, folder)
    old = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith("version-") and s.getPath().getName() != name]
    for version in old:
        files.delete(version, True)
    return len(old)
