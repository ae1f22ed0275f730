"""A corpus pipeline: documents to a mixed, clean training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next one's documents.  All but the last return
the columns of documents; the last returns them as often as the mix takes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from tallyline.plans import Staging


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), drop_toxic=True)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that appeared before; those with nothing left go."""
    return line_dedup.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.keep_one_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("mixing", source_mix),
]

# Quality weights and their draw have no SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is stored before the next begins."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, staging.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        staging.drop(before)
    return docs
