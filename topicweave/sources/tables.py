"""Readers for the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.functions import text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table. ``spark.topicweave.inputPartitions``, if set, deals its rows out to so many partitions, for files
    of one row group that a single task would read."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    dealt = spark.conf.get("spark.topicweave.inputPartitions", None)
    return rows.repartition(int(dealt)) if dealt else rows


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles: first line is the headline, the rest the description, language the category."""
    return table(spark, folder, "documents").select(
        "doc_id",
        text.first_line(F.col("text")).alias("headline"),
        text.after_first_line(F.col("text")).alias("description"),
        F.col("lang").alias("category"),
    )
