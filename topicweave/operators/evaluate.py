"""Topics against labels: contingency, cost matrices, assignment, accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions import vectors


def topic_by_category(best: DataFrame, labels: DataFrame) -> DataFrame:
    return (
        best.select("doc_id", "topic").join(labels.select("doc_id", "category"), "doc_id")
        .groupBy("topic", "category").agg(F.count("*").alias("docs"))
    )


def confusion(pred: DataFrame, truth: str = "y", guess: str = "pred") -> DataFrame:
    return pred.groupBy(truth, guess).agg(F.count("*").alias("docs"))


def class_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("y").agg(F.count("*").alias("docs"), F.min("category").alias("category"))


def accuracy(pred: DataFrame, truth: str = "y", guess: str = "pred") -> DataFrame:
    return pred.agg(
        F.avg((F.col(truth) == F.col(guess)).cast("double")).alias("accuracy"), F.count("*").alias("docs")
    )


def accuracy_by_class(pred: DataFrame, truth: str = "y", guess: str = "pred") -> DataFrame:
    return pred.groupBy(truth).agg(
        F.avg((F.col(truth) == F.col(guess)).cast("double")).alias("accuracy"), F.count("*").alias("docs")
    )


def share_above(features: DataFrame, topic: int, threshold: float = 0.5, vector: str = "g") -> DataFrame:
    """Share of each category whose weight of one topic exceeds the threshold."""
    return features.groupBy("category").agg(
        F.avg((F.col(vector)[topic] > threshold).cast("double")).alias("share"), F.count("*").alias("docs")
    )


def _class_topic(features: DataFrame, k: int, cell) -> DataFrame:
    """``(y, topic, cost)``: one partial aggregate per topic, so each class costs K numbers whatever its size."""
    sums = [cell(F.col("g")[i], i).alias(f"_c{i}") for i in range(k)]
    packed = F.array(*[F.col(f"_c{i}").cast("double") for i in range(k)])
    return features.groupBy("y").agg(*sums).select("y", F.posexplode_outer(packed).alias("topic", "cost"))


def assignment_cost(features: DataFrame, k: int) -> DataFrame:
    """Class size minus the class's total weight on the topic."""
    return _class_topic(features, k, lambda g, i: F.count("*") - F.sum(g))


def squared_cost(features: DataFrame, k: int, form: str = "one_hot") -> DataFrame:
    """Squared distance to the class indicator by column (``one_hot``), or to 1 everywhere (``plain``)."""
    if form == "plain":
        return _class_topic(features, k, lambda g, i: F.sum(F.pow(F.lit(1.0) - g, F.lit(2.0))))
    return _class_topic(
        features, k,
        lambda g, i: F.sum(F.pow(F.when(F.col("y") == i, F.lit(1.0)).otherwise(F.lit(0.0)) - g, F.lit(2.0))),
    )


def _flat_costs(cost: DataFrame, k: int) -> Column:
    """The K x K costs as one array by ``y * k + topic``, read as a scalar; cells of a class without documents are 0."""
    found = cost.agg(F.map_from_entries(F.collect_list(F.struct(
        (F.col("y") * k + F.col("topic")).cast("int").alias("at"), "cost"))).alias("cells"))
    at = F.sequence(F.lit(0), F.lit(k * k - 1))
    return found.select(F.transform(at, lambda i: F.coalesce(F.element_at("cells", i), F.lit(0.0)))).scalar()


def match_topics(cost: DataFrame, k: int, method: str = "exact") -> DataFrame:
    """One topic per class: ``(y, topic, total_cost)``.

    ``exact``: the least total cost, the first permutation on ties; a table of topic subsets is extended class by class, so
    it holds at most ``2 ** k`` rows. ``greedy``: each class in turn takes the cheapest topic left, for many classes;
    it is a heuristic. The caller chooses, whatever the number of classes.
    """
    if method not in ("exact", "greedy"):
        raise ValueError(f"no method {method}")
    spark = cost.sparkSession
    topics = F.sequence(F.lit(0), F.lit(k - 1))
    paths = spark.range(1).select(
        F.array().cast("array<int>").alias("path"), F.lit(0.0).alias("total"), _flat_costs(cost, k).alias("cells")
    )
    if method == "greedy":
        # one pass over the classes inside the row
        def cheapest(acc: Column, y: Column) -> Column:
            left = F.array_except(topics, acc["path"])
            best = F.array_min(F.transform(left, lambda t: F.struct(F.get(F.col("cells"), y * k + t).alias("c"), t.alias("t"))))
            return F.struct(F.concat(acc["path"], F.array(best["t"])).alias("path"), (acc["total"] + best["c"]).alias("total"))

        start = F.struct(F.array().cast("array<int>").alias("path"), F.lit(0.0).alias("total"))
        paths = paths.select(F.aggregate(topics, start, cheapest).alias("r")).select("r.path", "r.total")
    for y in range(k) if method == "exact" else ():
        step = paths.withColumn("_t", F.explode(F.array_except(topics, F.col("path"))))
        cell = F.element_at("cells", F.col("_t") + F.lit(1 + y * k))
        paths = step.select(
            F.concat("path", F.array("_t")).alias("path"), (F.col("total") + cell).alias("total"), "cells"
        )
        best = F.min(F.struct("total", "path")).alias("best")
        paths = paths.groupBy(F.sort_array("path").alias("_used")).agg(
            best, F.first("cells").alias("cells")
        ).select("best.path", "best.total", "cells")
    best = paths.agg(F.min(F.struct("total", "path")).alias("best"))
    return best.select(
        F.posexplode_outer("best.path").alias("y", "topic"), F.col("best.total").alias("total_cost")
    )


def mapped_prediction(best: DataFrame, mapping: DataFrame) -> DataFrame:
    """Class of each document's best topic; the mapping holds one row per class, so it may be broadcast."""
    by_topic = mapping.select("topic", F.col("y").alias("pred"))
    return best.join(F.broadcast(by_topic), "topic")


def rearranged(features: DataFrame, mapping: DataFrame, k: int) -> DataFrame:
    """Feature vectors permuted so that entry y belongs to class y."""
    order = mapping.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("y", "topic"))), lambda m: m["topic"]).alias("o")
    ).scalar()
    return (
        features.withColumn("_o", order)
        .withColumn("g", F.array(*[F.element_at("g", F.col("_o")[i] + 1) for i in range(k)]))
        .drop("_o")
    )


def predicted(features: DataFrame, eta: list[list[float]], vector: str = "g") -> DataFrame:
    """Class with the largest score ``g . eta``."""
    return features.withColumn("pred", vectors.first_argmax(vectors.times_matrix(F.col(vector), eta)))
