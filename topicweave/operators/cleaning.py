"""Row filters, projections and token rows for article tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions import lexicon, text


def literal_table(df: DataFrame, values: Iterable, name: str, kind: str) -> DataFrame:
    """One-column table of driver-side literals."""
    return df.sparkSession.createDataFrame([(v,) for v in values], f"{name} {kind}")


def listed(df: DataFrame, values: Iterable | DataFrame, name: str, kind: str) -> DataFrame:
    """The values as a table to join with: a table is taken as it is, by its first column; no side is forced to broadcast."""
    if isinstance(values, DataFrame):
        return values.select(F.col(values.columns[0]).cast(kind).alias(name))
    return literal_table(df, values, name, kind)


def drop_rows(df: DataFrame, ids: Iterable[int] | DataFrame, key: str = "doc_id") -> DataFrame:
    return df.join(listed(df, ids, key, "bigint"), key, "left_anti")


def recode_category(df: DataFrame, mapping: dict[str, str], column: str = "category") -> DataFrame:
    return df.withColumn(column, text.recode(F.col(column), mapping))


def clean_fields(articles: DataFrame) -> DataFrame:
    """Possessives stripped from both text fields, written back under the same names."""
    return articles.withColumns({
        "headline": text.strip_possessives(F.col("headline")),
        "description": text.strip_possessives(F.col("description")),
    })


def field_rows(articles: DataFrame) -> DataFrame:
    """Two rows per article, tagged ``desp`` and ``hdl``, with the tagged key beside them."""
    return articles.select(
        "doc_id",
        "category",
        F.expr("stack(2, 'desp', description, 'hdl', headline) as (indicator, text)"),
    ).withColumn("doc_indicator", F.concat_ws("_", "doc_id", "indicator"))


def token_rows(
    df: DataFrame,
    tokenizer: Callable[[Column], Column] = text.words,
    column: str = "text",
    name: str = "word",
    keys: tuple[str, ...] = ("doc_id",),
    position: bool = False,
) -> DataFrame:
    """One row per token; any Column -> array<string> function serves as tokenizer."""
    tokens = tokenizer(F.col(column))
    if position:
        return df.select(*keys, F.posexplode(tokens).alias("pos", name))
    return df.select(*keys, F.explode(tokens).alias(name))


def without_stop_words(tokens: DataFrame, stop_words: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """The own list is fixed and short, so it may be broadcast; any other is joined as its size asks."""
    if stop_words is None:
        return tokens.join(F.broadcast(literal_table(tokens, lexicon.stop_word_list(), "word", "string")), "word", "left_anti")
    return tokens.join(listed(tokens, stop_words, "word", "string"), "word", "left_anti")


def blank_fields(articles: DataFrame) -> DataFrame:
    """Articles whose headline or description is blank, with one flag per field."""
    flagged = articles.select(
        "doc_id",
        (F.trim("headline") == "").alias("no_headline"),
        (F.trim("description") == "").alias("no_description"),
    )
    return flagged.where(F.col("no_headline") | F.col("no_description"))


def tokenless(articles: DataFrame, counts: DataFrame) -> DataFrame:
    """Articles left without a single counted word."""
    return articles.join(counts.select("doc_id").distinct(), "doc_id", "left_anti")


def split_key(df: DataFrame, column: str, names: tuple[str, ...], sep: str) -> DataFrame:
    parts = F.split(F.col(column), sep)
    return df.select("*", *[parts[i].alias(n) for i, n in enumerate(names)])
