"""Exact deduplication against a persistent digest index.

The index is a Parquet table ``(digest, keep_id)``, bucketed and sorted by digest, in a folder that all executors
reach. A batch is reduced to one row per digest, anti-joined with the index by sort-merge, and what is new is appended. The index side
isn't shuffled; Spark sorts each bucket when it reads it, since appends leave several sorted files. The number of buckets grows with the
index. Texts stay where they are: only digests and ids move.

Defined cases: a null text counts as empty; of equal texts of a batch the largest ``doc_id`` stays, unless the index
already holds the text; a row without id stays only if no row of its group has one; rows that repeat both id and text are
one document given several times, of which one row stays. An empty batch gives an empty result. Adding a batch again
gives the same decisions, so a job that broke off can simply be run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from topicweave.llm.common import temporary_names, whole
from topicweave.operators import skew
from topicweave.session import materialize, scratch_path


def digest(text: str | Column = "text") -> Column:
    """SHA-256 of the UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(whole(text), 256))


class DigestIndex:
    """Digests of all texts seen so far, below ``path``; a new session opens the index by the same path.

    ``path/layout`` names the number of buckets in use, ``path/<buckets>`` holds their files. When a bucket would hold more than
    ``bucket_rows`` digests, the index is written anew with more buckets and the note changed last, so a job that breaks off on the way
    leaves the former index in use. ``buckets`` is the number to begin with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, bucket_rows: int = 1_000_000):
        self.spark, self.path, self.bucket_rows = spark, path, bucket_rows
        files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/layout/_SUCCESS")
        if files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(files):
            buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()["buckets"]
        else:
            self._note(buckets)
        self._use(buckets)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/{buckets}'")

    def _use(self, buckets: int) -> None:
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}_{buckets}"

    def _note(self, buckets: int) -> None:
        note = self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1)
        note.write.mode("overwrite").parquet(f"{self.path}/layout")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def _write(self, rows: DataFrame, buckets: int, mode: str) -> None:
        dealt = rows.repartition(buckets, "digest").write.mode(mode).format("parquet").option("path", f"{self.path}/{buckets}")
        dealt.bucketBy(buckets, "digest").sortBy("digest").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def _grow(self, more: int) -> None:
        """Enough buckets for ``more`` digests besides those that are held."""
        wanted, former = self.buckets, self.table()
        rows = former.count() + more
        while wanted * self.bucket_rows < rows:
            wanted *= 2
        if wanted > self.buckets:
            self._use(wanted)
            self._write(former, wanted, "overwrite")
            self._note(wanted)

    def add(self, docs: DataFrame) -> DataFrame:
        """Decide on every row of ``docs (doc_id, text, ...)`` and append the new digests.

        Returns ``doc_id, keep_id, group_size, kept, digest``, one row per input row; ``group_size`` counts the batch.
        """
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"))
        rows = materialize(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("times")), "digests")
        groups = rows.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"), F.count("*").alias("rows"))
        groups = materialize(groups, "digest-groups")
        self._grow(groups.count())
        fresh = groups.select("digest", "keep_id").hint("merge").join(self.table(), "digest", "left_anti")
        self._write(fresh, self.buckets, "append")
        keepers = groups.select("digest", "group_size").hint("merge").join(self.table(), "digest")
        # a text under very many ids is looked up in pieces
        return (
            skew.lookup(rows, keepers, "digest", spread="doc_id", sizes=groups.select("digest", "rows"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select(
                "doc_id", "keep_id", "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "digest",
            )
        )


def new_index(spark: SparkSession, **layout) -> DigestIndex:
    """An empty index below the shared folder."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"), **layout)


def without_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key, place, id_, key_ = temporary_names(docs.columns, "digest", "place", "id_", "digest_")
    kept = index.add(docs).where("kept").select(F.col("doc_id").alias(id_), F.col("digest").alias(key_))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_))
    stay = docs.withColumn(key, digest()).join(kept, same, "left_semi")
    first = Window.partitionBy("doc_id", key).orderBy(F.xxhash64(*docs.columns))
    return stay.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*docs.columns)
