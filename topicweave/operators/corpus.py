"""Term-count tables ``(doc_id, word, n)``: counting, filtering, merging, dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions import text
from topicweave.operators import skew
from topicweave.session import materialize

BUCKET_DIGITS = 3


def count_words(tokens: DataFrame, weight: str | None = None, document: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    amount = F.count("*") if weight is None else F.sum(weight)
    return tokens.groupBy(*document, "word").agg(amount.cast("bigint").alias("n"))


def terms_per_document(counts: DataFrame) -> DataFrame:
    return counts.groupBy("doc_id").agg(F.count_if(F.col("n") > 0).alias("terms"))


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("word").agg(F.count_if(F.col("n") > 0).alias("docs"))


def keep_long_documents(counts: DataFrame, more_than: int = 10) -> DataFrame:
    """Documents with more than ``more_than`` distinct terms, counted in a window: one scan, one shuffle by document."""
    terms = F.count_if(F.col("n") > 0).over(Window.partitionBy("doc_id"))
    return counts.withColumn("_terms", terms).where(F.col("_terms") > more_than).drop("_terms")


def drop_rare_terms(counts: DataFrame, at_most: int = 1, counted_by: tuple[str, ...] | None = None) -> DataFrame:
    """Terms found in more than ``at_most`` documents.

    ``counted_by``: the counts come from :func:`count_words` by these columns, which are never null, and words that aren't either. A term
    of one document then is one row, and these rows leave by a join on the keys of the counting: the others stay where they are.
    """
    if counted_by and at_most == 1:
        # counted through n, as in key_sizes, so that both sides share the counting
        once = counts.groupBy("word").agg(F.count_if(F.col("n") > 0).alias("_docs"), *[F.max(c).alias(c) for c in counted_by]).where("_docs = 1").drop("_docs")
        return counts.join(once.hint("shuffle_hash"), [*counted_by, "word"], "left_anti")
    sizes = document_frequency(counts)
    kept = sizes.where(F.col("docs") > at_most).select("word")
    return skew.lookup(
        counts, kept, "word", spread="doc_id", how="left_semi", sizes=sizes.withColumnRenamed("docs", "rows"), hashed=True
    )


def long_document_share(counts: DataFrame, more_than: int = 10) -> DataFrame:
    return terms_per_document(counts).agg(
        F.avg((F.col("terms") > more_than).cast("double")).alias("share"), F.count("*").alias("docs")
    )


def length_histogram(counts: DataFrame, width: int = 10) -> DataFrame:
    lower = (F.floor(F.col("terms") / width) * width).cast("bigint")
    return terms_per_document(counts).groupBy(lower.alias("at_least")).agg(F.count("*").alias("docs"))


def term_map(counts: DataFrame, normalize=text.normalize_word) -> DataFrame:
    """``(word, norm)`` for the distinct terms that normalisation changes."""
    return (
        counts.select("word").distinct().withColumn("norm", normalize(F.col("word")))
        .where(F.col("word") != F.col("norm"))
    )


def apply_term_map(counts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace every mapped word; rows may collide afterwards (see :func:`merge_counts`)."""
    return (
        skew.lookup(counts, mapping, "word", spread="doc_id", how="left")
        .select("doc_id", F.coalesce("norm", "word").alias("word"), "n")
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """Sum the counts of rows that share document and word."""
    return count_words(counts, weight="n")


def normalized_counts(counts: DataFrame, normalize=text.normalize_word) -> DataFrame:
    """Normalise by expression and merge: no map table, one aggregation."""
    return merge_counts(counts.withColumn("word", normalize(F.col("word"))))


def later_duplicates(tokens: DataFrame) -> DataFrame:
    """Tokens ``(doc_id, pos, word)`` flagged when the word stood earlier in the document: one shuffle by both."""
    first = F.min("pos").over(Window.partitionBy("doc_id", "word"))
    return tokens.select("doc_id", "pos", "word", (F.col("pos") > first).alias("is_later"))


def duplicate_keys(counts: DataFrame) -> DataFrame:
    return counts.groupBy("doc_id", "word").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def merge_integrity(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: distinct keys and token mass on both sides of a merge."""
    def summary(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.countDistinct("doc_id", "word").alias(f"{side}_keys"),
            F.count("*").alias(f"{side}_rows"),
            F.sum("n").alias(f"{side}_tokens"),
        )

    left = summary(before, "before").select(F.lit(1).alias("one"), "*")
    right = summary(after, "after").select(F.lit(1).alias("one"), "*")
    return left.join(right, "one").drop("one")


def corpus_size(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.countDistinct("doc_id").alias("docs"),
        F.countDistinct("word").alias("terms"),
        F.count("*").alias("pairs"),
        F.sum("n").alias("tokens"),
        F.min("doc_id").alias("min_doc_id"),
        F.max("doc_id").alias("max_doc_id"),
    )


def dense_ids(df: DataFrame, key: str, name: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Distinct keys numbered 0, 1, 2, ... in the order of their md5.

    The hash prefix spreads any key set evenly over ``16 ** digits`` buckets; rows are numbered inside their bucket and
    shifted by the size of the buckets before it. Only the bucket sizes meet in one task.
    """
    keys = df.select(key).distinct().withColumn("_md5", F.md5(F.col(key).cast("string")))
    return _numbered(keys.withColumn("_bucket", F.substring("_md5", 1, digits)), ["_md5", key], name).select(key, name)


def _numbered(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered by ``_bucket`` and, inside it, by ``order``; one row per bucket meets in one task."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keys.groupBy("_bucket").agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        keys.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, "_bucket")
        .withColumn(name, (F.col("_start") + F.col("_at")).cast("bigint"))
    )


def class_ids(labels: DataFrame, column: str = "category", name: str = "y") -> DataFrame:
    """Label values numbered in sorted order. Sampled splitters deal them into ranges of about equal size, which are numbered one by
    one; what they share at their beginnings doesn't matter."""
    values = labels.select(column).distinct().repartitionByRange(column).withColumn("_bucket", F.spark_partition_id())
    ranges = materialize(values, "class-ranges")  # the ranges must not be drawn again between their counting and their use
    return _numbered(ranges, [column], name).select(column, F.col(name).cast("int").alias(name))


def with_class_ids(labels: DataFrame, column: str = "category", name: str = "y") -> DataFrame:
    return labels.join(class_ids(labels, column, name), column)


def document_term_matrix(counts: DataFrame, docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(doc_idx, term_idx, n)`` from the dimension tables ``(doc_id, doc_idx)`` and ``(word, term_idx)``."""
    by_doc = skew.lookup(counts, docs, "doc_id", spread="word")
    return skew.lookup(by_doc, terms, "word", spread="doc_id").select("doc_idx", "term_idx", "n")


def bag_of_words(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per document: sorted ``(term_idx, n)`` pairs."""
    return (
        skew.lookup(counts, terms, "word", spread="doc_id")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("term_idx", "n"))).alias("bag"))
    )


def subset_by_category(counts: DataFrame, labels: DataFrame, categories) -> DataFrame:
    """Counts of the documents in the named categories."""
    kept = labels.where(F.col("category").isin(list(categories))).select("doc_id")
    return skew.lookup(counts, kept, "doc_id", spread="word", how="left_semi")


def vocabulary_matches(counts: DataFrame, pattern: str) -> DataFrame:
    return counts.select("word").distinct().where(F.col("word").rlike(pattern))


def vocabulary_share(counts: DataFrame, test: Column) -> DataFrame:
    return counts.select("word").distinct().agg(
        F.avg(test.cast("double")).alias("share"),
        F.sum(test.cast("bigint")).alias("hits"),
    )
