"""Delimited and parquet tables of the star schema, and the general sink."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Column order and types of the `|`-separated star-schema files.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate date, l_commitdate date, "
        "l_receiptdate date, l_shipinstruct string, l_shipmode string, l_comment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int, "
        "o_comment string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_address string, c_nationkey int, c_phone string, "
        "c_acctbal double, c_mktsegment string, c_comment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, "
        "p_size int, p_container string, p_retailprice double, p_comment string"
    ),
    "supplier": (
        "s_suppkey bigint, s_name string, s_address string, s_nationkey int, s_phone string, "
        "s_acctbal double, s_comment string"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
}


def read_table(
    spark: SparkSession, path: str, table: str | None = None,
    schema: str | None = None, sep: str = "|",
) -> DataFrame:
    """A delimited file with positional columns; only columns used are parsed.

    ``table`` names one of the star-schema layouts, ``schema`` gives any other.
    """
    return spark.read.schema(schema or SCHEMAS[table]).csv(path, sep=sep)


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Tables of a folder by name, from ``name.parquet`` or ``name.tbl``."""
    if fmt == "parquet":
        return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    return {n: read_table(spark, f"{folder}/{n}.tbl", n) for n in names}


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result, replacing what is at ``path``; ``tsv`` gives text."""
    writer = df.write.mode("overwrite")
    if fmt == "tsv":
        writer.csv(path, sep="\t")
    else:
        writer.format(fmt).save(path)
