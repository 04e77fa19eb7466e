"""Topic assignments and the count tables behind them.

Blocks are ``(doc_id, word, n, c)`` with ``c`` the n copies split over the topics; tokens are
``(doc_id, word, rep, z)`` with one topic each. Count tables hold one array of K counts per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions import draws, vectors
from topicweave.operators import skew


def token_copies(counts: DataFrame) -> DataFrame:
    """One row per token, numbered 1..n inside each (document, word) pair."""
    return counts.select("doc_id", "word", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("rep"))


def random_topic(k: int, seed, doc: Column, word: Column, rep: Column) -> Column:
    return F.pmod(draws.hash_uint32(doc, word, rep, seed), F.lit(k)).cast("int")


def seeded_topic(k: int, seed, doc: Column, word: Column, rep: Column, y: Column, weight: float) -> Column:
    """Own class with probability ``weight``, every other topic with an equal share of the rest; no class: all alike."""
    rest = (1.0 - weight) / (k - 1)
    shares = [F.when(y.isNull(), F.lit(1.0 / k)).when(y == i, F.lit(weight)).otherwise(F.lit(rest)) for i in range(k)]
    return draws.pick(draws.uniform(doc, word, rep, seed), draws.running_totals(shares))


def split_counts(zs: Column, k: int) -> Column:
    """Array of topics to K counts."""
    def holds(i: int):
        return lambda z: z == i

    return F.array(*[F.size(F.filter(zs, holds(i))) for i in range(k)])


def random_blocks(counts: DataFrame, k: int, seed) -> DataFrame:
    reps = F.sequence(F.lit(1), F.col("n").cast("int"))
    zs = F.transform(reps, lambda r: random_topic(k, seed, F.col("doc_id"), F.col("word"), r))
    return counts.withColumn("_z", zs).withColumn("c", split_counts(F.col("_z"), k)).drop("_z")


def random_tokens(counts: DataFrame, k: int, seed) -> DataFrame:
    return token_copies(counts).withColumn(
        "z", random_topic(k, seed, F.col("doc_id"), F.col("word"), F.col("rep"))
    )


def label_seeded_tokens(counts: DataFrame, labels: DataFrame, k: int, seed, weight: float = 0.8) -> DataFrame:
    """Initial topics leaning to the document's class ``y``."""
    labelled = skew.lookup(counts, labels.select("doc_id", "y"), "doc_id", spread="word", how="left")
    copies = labelled.select(
        "doc_id", "word", "y", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("rep")
    )
    return copies.withColumn(
        "z", seeded_topic(k, seed, F.col("doc_id"), F.col("word"), F.col("rep"), F.col("y"), weight)
    ).drop("y")


def own_counts(rows: DataFrame, k: int) -> list[Column]:
    """Per-topic contribution of one row: its block counts, or 1 at its token's topic."""
    if "c" in rows.columns:
        return [F.col("c")[i] for i in range(k)]
    return [(F.col("z") == i).cast("int") for i in range(k)]


def counts_by(rows: DataFrame, key: str, k: int, *extra: Column) -> DataFrame:
    """``(key, cnt array<bigint>)``; K plain sums, so partial aggregation shrinks the data before the shuffle."""
    sums = [F.sum(own).alias(f"_s{i}") for i, own in enumerate(own_counts(rows, k))]
    packed = F.array(*[F.col(f"_s{i}") for i in range(k)]).alias("cnt")
    grouped = rows.groupBy(key).agg(*sums, *extra)
    names = [c for c in grouped.columns if not c.startswith("_s")]
    return grouped.select(*names, packed)


def topic_totals(by_word: DataFrame, k: int) -> DataFrame:
    """One row: K topic totals and the number of distinct terms."""
    sums = F.array(*[F.sum(F.col("cnt")[i]) for i in range(k)])
    return by_word.agg(sums.alias("nk"), F.count("*").alias("terms"))


def gamma(by_doc: DataFrame, k: int, alpha: float) -> DataFrame:
    """P(topic | document) as ``(doc_id, g array<double>)``."""
    cnt = F.col("cnt")
    whole = vectors.total(vectors.items(cnt, k)) + F.lit(k * alpha)
    return by_doc.select("doc_id", F.array(*[(cnt[i] + F.lit(alpha)) / whole for i in range(k)]).alias("g"))


def beta(by_word: DataFrame, k: int, prior: float) -> DataFrame:
    """P(term | topic) as ``(word, b array<double>)``."""
    totals = topic_totals(by_word, k).select(F.struct("nk", "terms")).scalar()
    cnt, t = F.col("cnt"), F.col("_t")
    return by_word.withColumn("_t", totals).select(
        "word",
        F.array(*[
            (cnt[i] + F.lit(prior)) / (t["nk"][i] + F.lit(prior) * t["terms"]) for i in range(k)
        ]).alias("b"),
    )


def tidy(matrix: DataFrame, key: str, vector: str, value: str) -> DataFrame:
    """Vectors to long rows ``(key, topic, value)``.

    The outer form adds no filter on the vector, which would be pushed down and repeat the vector's expressions.
    """
    return matrix.select(key, F.posexplode_outer(vector).alias("topic", value))


def spread_topics(long: DataFrame, key: str, value: str, k: int, prefix: str = "topic_") -> DataFrame:
    """Long rows to one column per topic."""
    wide = long.groupBy(key).pivot("topic", list(range(k))).agg(F.first(value))
    return wide.select(key, *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(k)])


def gather_topics(wide: DataFrame, key: str, value: str, k: int, prefix: str = "topic_") -> DataFrame:
    """One column per topic back to long rows."""
    pairs = ", ".join(f"{i}, {prefix}{i}" for i in range(k))
    return wide.select(key, F.expr(f"stack({k}, {pairs}) as (topic, {value})"))


def mass_by_document(rows: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """Assigned and counted tokens of each document, and whether they agree."""
    assigned = counts_by(rows, "doc_id", k).select(
        "doc_id", vectors.total(vectors.items(F.col("cnt"), k)).alias("assigned")
    )
    counted = counts.groupBy("doc_id").agg(F.sum("n").alias("counted"))
    both = counted.join(assigned, "doc_id", "left").withColumn("assigned", F.coalesce("assigned", F.lit(0)).cast("bigint"))
    return both.withColumn("conserved", F.col("assigned") == F.col("counted"))


def mass_by_table(rows: DataFrame, k: int) -> DataFrame:
    """Token totals of the three count tables, one row each."""
    def whole(df: DataFrame, name: str) -> DataFrame:
        cell = vectors.total(vectors.items(F.col("cnt"), k))
        return df.agg(F.sum(cell).alias("tokens")).select(F.lit(name).alias("source"), "tokens")

    by_doc, by_word = counts_by(rows, "doc_id", k), counts_by(rows, "word", k)
    nk = topic_totals(by_word, k).select(
        F.lit("topics").alias("source"), vectors.total(vectors.items(F.col("nk"), k)).alias("tokens")
    )
    return whole(by_doc, "documents").unionByName(whole(by_word, "words")).unionByName(nk)
