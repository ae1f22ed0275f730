"""Text corpora: lines, numbered lines and labelled feature documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.durable import checkpointed


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(text): one row per line of the files."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def number_lines(spark: SparkSession, path: str, out: str) -> DataFrame:
    """(docno, text): lines of text files, numbered from 0 in the order of file path and line.

    The numbers do not depend on how the files are split: lines are counted per
    split, and a line's number is its place in its split after all lines of
    earlier splits.  They are written with the text to ``out``, replacing what
    is there; everything downstream reads that table.
    """
    tagged = checkpointed(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
    ))
    sizes = tagged.groupBy("file", "start").agg(F.count("*").alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    offsets = sizes.select("file", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("file", "start").orderBy("at")) - 1
    numbered = tagged.withColumn("place", place).join(offsets, ["file", "start"])
    numbered.select((F.col("before") + F.col("place")).alias("docno"), "text").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def read_documents(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(docno, text) from a parquet table that already has an id column."""
    return spark.read.parquet(path).select(F.col(id_col).alias("docno"), F.col(text_col).alias("text"))


def document_lines(docs: DataFrame, id_col: str = "docno", text_col: str = "text") -> DataFrame:
    """(docno, line_no, text): every line of every document, empty ones too.

    (docno, line_no) identifies a line and does not depend on the plan.
    """
    return docs.select(
        F.col(id_col).alias("docno"),
        F.posexplode(F.split(text_col, "\n")).alias("line_no", "text"),
    )


def read_labeled(lines: DataFrame, feature_type: str = "int") -> DataFrame:
    """(doc_id, label, features) from lines ``id label f1 f2 ...``.

    Features keep their multiplicity and order.
    """
    part = F.split("text", " ")
    features = F.slice(part, 3, F.greatest(F.size(part) - 2, F.lit(0)))
    return lines.select(
        F.get(part, F.lit(0)).alias("doc_id"),
        F.get(part, F.lit(1)).alias("label"),
        features.cast(f"array<{feature_type}>").alias("features"),
    )
