"""Lookups that stay balanced when one key owns a large share of the rows.

A key is hot when it owns more than ``share`` of all rows, so there are at most ``1 / share`` hot keys whatever the
size of the data: their list is the only thing broadcast. A hot key is cut into ``ceil(rows / (share * total))``
pieces; the lookup row is repeated once per piece, at most ``2 / share`` extra rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1.0 / 1024


def key_sizes(facts: DataFrame, key: str) -> DataFrame:
    """``(key, rows)``. Counting through ``n`` keeps that column in the plan, so the aggregation below is shared with
    the branch that needs the counts themselves."""
    rows = F.count_if(F.col("n") > 0) if "n" in facts.columns else F.count("*")
    return facts.groupBy(key).agg(rows.alias("rows"))


def hot_keys(sizes: DataFrame, key: str, rows: str = "rows", share: float = HOT_SHARE) -> DataFrame:
    """``(key, pieces)`` for the hot keys only; at most ``1 / share`` rows."""
    unit = sizes.select((F.sum(rows) * F.lit(share)).alias("unit")).scalar()
    return (
        sizes.select(key, F.col(rows).alias("rows"), unit.alias("unit"))
        .where(F.col("rows") > F.col("unit"))
        .select(key, F.ceil(F.col("rows") / F.col("unit")).cast("int").alias("pieces"))
    )


def with_pieces(facts: DataFrame, hot: DataFrame, key: str, name: str) -> DataFrame:
    """Attach the number of pieces of each row's key (1 unless hot)."""
    return (
        facts.join(F.broadcast(hot.withColumnRenamed("pieces", name)), key, "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit(1)))
    )


def piece_of(pieces: Column, spread: Column) -> Column:
    return F.when(pieces > 1, F.pmod(F.xxhash64(spread), pieces).cast("int")).otherwise(F.lit(0))


def repeat_rows(lookup: DataFrame, pieces: str, name: str) -> DataFrame:
    """One copy of each lookup row per piece."""
    return lookup.withColumn(name, F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))).drop(pieces)


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    how: str = "inner",
    sizes: DataFrame | None = None,
    share: float = HOT_SHARE,
    hashed: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``table`` (one row per ``key``) with hot keys cut into pieces by ``spread``.

    ``sizes`` gives ``(key, rows)`` of the facts when the caller has it already. ``hashed``: the table's rows are short, so a task holds
    its part of them in memory and the facts need no sort.
    """
    hot = hot_keys(key_sizes(facts, key) if sizes is None else sizes, key, share=share)
    left = with_pieces(facts, hot, key, "_pieces").withColumn("_piece", piece_of(F.col("_pieces"), F.col(spread)))
    right = repeat_rows(with_pieces(table, hot, key, "_pieces"), "_pieces", "_piece")
    right = right.hint("shuffle_hash") if hashed else right
    return left.drop("_pieces").join(right, [key, "_piece"], how).drop("_piece")
