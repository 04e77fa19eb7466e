"""Top terms, best topics and orderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_with_ties(rows: DataFrame, n: int, group: str, value: str) -> DataFrame:
    """Rows whose value ranks in the first ``n`` of their group; ties at the edge are all kept."""
    order = Window.partitionBy(group).orderBy(F.desc(value))
    return rows.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") <= n).drop("_rank")


def top_strict(rows: DataFrame, n: int, group: str, value: str, tie: str = "word") -> DataFrame:
    """Exactly ``n`` rows per group, numbered from 1; ``tie`` decides between equal values."""
    order = Window.partitionBy(group).orderBy(F.desc(value), tie)
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def best_topic(vectors: DataFrame, vector: str = "g", name: str = "topic") -> DataFrame:
    """Topic with the largest weight, the first on ties; decided inside the row."""
    top = F.array_position(F.col(vector), F.array_max(vector)) - 1
    return vectors.withColumn(name, top.cast("int"))


def best_topics_with_ties(vectors: DataFrame, key: str = "doc_id", vector: str = "g") -> DataFrame:
    """One row per topic that reaches the document's largest weight."""
    return (
        vectors.select(key, F.array_max(vector).alias("top"), F.posexplode_outer(vector).alias("topic", "value"))
        .where(F.col("value") == F.col("top"))
        .select(key, "topic", "value")
    )


def top_topics(vectors: DataFrame, n: int, key: str = "doc_id", vector: str = "g") -> DataFrame:
    """The ``n`` heaviest topics of each document, sorted inside the row."""
    pairs = F.transform(F.col(vector), lambda g, i: F.struct((-g).alias("neg"), i.alias("topic"), g.alias("value")))
    ranked = F.slice(F.array_sort(pairs), 1, n)
    return vectors.select(key, F.posexplode_outer(ranked).alias("at", "pair")).select(
        key, (F.col("at") + 1).alias("place"), "pair.topic", "pair.value"
    )


def sorted_terms(rows: DataFrame, value: str = "beta") -> DataFrame:
    return rows.orderBy("topic", F.desc(value), "word")


def category_order(vectors: DataFrame, labels: DataFrame, vector: str = "g") -> DataFrame:
    """Categories by the mean of weight times topic number (topics numbered from 1)."""
    long = vectors.select("doc_id", F.posexplode_outer(vector).alias("at", "value"))
    scored = long.join(labels.select("doc_id", "category"), "doc_id")
    return (
        scored.groupBy("category")
        .agg(F.avg(F.col("value") * (F.col("at") + 1)).alias("score"))
        .orderBy("score", "category")
    )
