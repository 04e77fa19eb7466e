"""Column helpers that several operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.session import scratch_path

#: Words are runs of anything but these six ASCII characters.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def whole(text: str | Column = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """All words in order; an empty array for an empty text."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def characters_in(text: Column, alphabet: str) -> Column:
    """How many characters of ``text`` belong to ``alphabet``."""
    return (F.length(text) - F.length(F.translate(text, alphabet, ""))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also when lambdas inside refer to it."""
    return F.transform(F.array(value), body)[0]


def uniform(*key: Column, seed: int = 0) -> Column:
    """A draw in [0, 1) that depends on the key alone, so retries and partitions don't change it."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 52)) / F.lit(float(1 << 52))


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """About ``rows`` rows at most, drawn by a hash of ``key``; all rows if there are fewer."""
    total = df.count()
    return df if total <= rows else df.where(uniform(F.col(key), seed=seed) < rows / total)


def temporary_names(columns: Sequence[str], *wanted: str) -> list[str]:
    """Names for helper columns that no column of the input has, whatever its case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bucket_number(spark: SparkSession, rows: int, bucket_rows: int = 1 << 16) -> int:
    """Buckets for a table of ``rows`` rows: no fewer than the partitions of a shuffle, so joins keep the table where it lies."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // bucket_rows))


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Like ``materialize``, dealt into buckets by ``key``: joins and windows on this column don't shuffle the table again."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key).write.format("parquet").option("path", scratch_path(spark, label))
    dealt.bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def slices(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in a text column without nulls; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits spread over each other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
