"""Packed-parquet scan: ids, mask and labels = a copy of the ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path).select("input_ids", "attention_mask")
    return df.withColumn("labels", F.col("input_ids"))
