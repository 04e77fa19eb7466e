"""From raw documents to token ids: quality rules, exact dedup, near-duplicate join, source mix, byte-level BPE.

Every stage reads what the one before it wrote and works on all of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from topicweave.llm.common import temporary_names
from topicweave.operators import corpus
from topicweave.session import materialize
from topicweave.sources.tables import table


def same_row(id_: str, key: str, theirs: str) -> Column:
    """Rows are known by their id, null included, and the digest of their text."""
    return F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(theirs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned rules reject; rows that share an id are judged by their own texts."""
    verdicts = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    id_, key, theirs = temporary_names(docs.columns, "id_", "key", "theirs")
    rejected = verdicts.where(~F.col("kept")).select(F.col("doc_id").cast("long").alias(id_), F.col("text_digest").alias(theirs)).distinct()
    return docs.withColumn(key, exact_dedup.digest()).join(rejected, same_row(id_, key, theirs), "left_anti").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.without_copies(docs, exact_dedup.new_index(spark))


def own_ids(docs: DataFrame) -> DataFrame:
    """``id_, key, own``: an id of its own, above all others, for each text of rows without id or with an id that several texts share."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id_"), exact_dedup.digest().alias("key")).distinct()
    texts = materialize(texts, "ids-of-texts")
    shared = texts.where("id_ is not null").groupBy("id_").agg(F.count("*").alias("n")).where("n > 1").select("id_")
    many = texts.join(shared, "id_", "left_semi").unionByName(texts.where("id_ is null"))
    named = many.select("id_", "key", F.concat_ws(":", F.col("id_").cast("string"), F.hex("key")).alias("name"))
    above = (texts.agg(F.max("id_")).first()[0] or 0) + 1
    numbers = corpus.dense_ids(named, "name", "number")
    return materialize(named.join(numbers, "name").select("id_", "key", (F.col("number") + above).alias("own")), "own-ids")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id; texts that have no id, or share one, count as documents of their own behind
    all others."""
    id_, key, theirs, own, gone_ = temporary_names(docs.columns, "id_", "key", "theirs", "own", "gone_")
    named = own_ids(docs).select(F.col("id_").alias(id_), F.col("key").alias(theirs), F.col("own").alias(own))
    known = docs.withColumn(key, exact_dedup.digest()).join(named, same_row(id_, key, theirs), "left")
    known = known.withColumn(own, F.coalesce(own, F.col("doc_id").cast("long"))).select(*docs.columns, own)
    found = ngram_join.joined(known.select(F.col(own).alias("doc_id"), "text"), counted=False)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone_)).distinct()
    return known.join(gone, F.col(own) == F.col(gone_), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row, with their digests."""
    return bpe.encode_table(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The learned rules and the fitted mix have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
