"""Linear models (feature, weight) and prediction files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .documents import read_lines


def parse_model(lines: DataFrame, model_id: str) -> DataFrame:
    """(model_id, feature, weight) from lines ``(feature,weight)``."""
    pattern = r"^\((.*),([^,]*)\)$"
    return lines.select(
        F.lit(model_id).alias("model_id"),
        F.regexp_extract("text", pattern, 1).alias("feature"),
        F.regexp_extract("text", pattern, 2).cast("double").alias("weight"),
    )


def read_model(spark: SparkSession, path: str, model_id: str, fmt: str = "text") -> DataFrame:
    """One model, from tuple text or from the native parquet form."""
    if fmt == "text":
        return parse_model(read_lines(spark, path), model_id)
    return spark.read.parquet(path).where(F.col("model_id") == model_id)


def read_models(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Several tuple-text models, ``{model_id: path}``, as one table."""
    return reduce(DataFrame.unionByName, (read_model(spark, p, m) for m, p in paths.items()))


def write_model(model: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store models, one folder per model id; ``text`` writes tuple lines."""
    if fmt == "text":
        line = F.concat(F.lit("("), F.col("feature"), F.lit(","), F.col("weight"), F.lit(")"))
        model = model.select("model_id", line.alias("value"))
    model.write.mode("overwrite").partitionBy("model_id").format(fmt).save(path)


def read_predictions(lines: DataFrame) -> DataFrame:
    """(doc_id, label, score, pred) from lines ``(doc,label,score,pred)``."""
    pattern = r"^\((.*),([^,]*),([^,]*),([^,]*)\)$"
    names = ["doc_id", "label", "score", "pred"]
    cols = [F.regexp_extract("text", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return lines.select(*cols).withColumn("score", F.col("score").cast("double"))
