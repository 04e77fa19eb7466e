"""Newline-delimited JSON articles and inline corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicweave.functions import text
from topicweave.sources.lines import numbered_lines

ARTICLE = T.StructType([
    T.StructField("headline", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("category", T.StringType()),
])
KEYED_ARTICLE = T.StructType([T.StructField("doc_id", T.LongType()), *ARTICLE.fields])


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles whose lines carry their own ``doc_id``; other keys are not read."""
    return spark.read.schema(KEYED_ARTICLE).json(path).withColumnRenamed("short_description", "description")


def read_articles_by_position(spark: SparkSession, path: str) -> DataFrame:
    """Articles numbered by their line, as in files without a key."""
    parsed = numbered_lines(spark, path).select(
        F.col("at").alias("doc_id"), F.from_json("value", ARTICLE).alias("a")
    )
    return parsed.select("doc_id", "a.headline", F.col("a.short_description").alias("description"), "a.category")


def write_articles(articles: DataFrame, path: str) -> None:
    articles.withColumnRenamed("description", "short_description").write.mode("overwrite").json(path)


def read_labels(spark: SparkSession, labels: str, docs: str) -> DataFrame:
    """Quoted labels, one per line, aligned by line with a file of document ids."""
    left = numbered_lines(spark, labels).select("at", text.unquote(F.col("value")).alias("category"))
    right = numbered_lines(spark, docs).select("at", F.trim("value").cast("bigint").alias("doc_id"))
    return right.join(left, "at").select("doc_id", "category")


def inline(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)
