"""From raw articles to the filtered term-count table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.functions import lexicon, text
from topicweave.operators import cleaning, corpus, skew


def document_tokens(docs: DataFrame, min_terms: int | None = None, column: str = "text") -> DataFrame:
    """``(doc_id, word)`` without stop words, for tables with one row per document.

    The length rule counts distinct words inside the row, so short documents leave before any shuffle.
    """
    stop = lexicon.stop_word_list()
    tokens = F.col("tokens")
    rows = docs.select("doc_id", text.words(F.col(column)).alias("tokens"))
    if min_terms is not None:
        listed = F.array(*[F.lit(w) for w in stop])
        tokens = F.when(F.size(F.array_except(tokens, listed)) > min_terms, tokens)
    # the outer form infers no filter below the projection, which would tokenise every text again
    exploded = rows.select("doc_id", F.explode_outer(tokens).alias("word"))
    return exploded.where(F.col("word").isNotNull() & ~F.col("word").isin(stop))


def term_counts(docs: DataFrame, min_terms: int | None = None) -> DataFrame:
    return corpus.count_words(document_tokens(docs, min_terms))


def filtered_counts(docs: DataFrame, min_terms: int = 10, rare: int = 1) -> DataFrame:
    """Long documents first, then terms found in several of them; not repeated."""
    tokens = document_tokens(docs, min_terms)
    none = F.lit(0).cast(tokens.schema["doc_id"].dataType)
    document = {"_id": F.coalesce("doc_id", none), "_none": F.isnull("doc_id")}
    counts = corpus.count_words(tokens.select("word", *[c.alias(name) for name, c in document.items()]), document=tuple(document))
    kept = corpus.drop_rare_terms(counts, rare, counted_by=tuple(document))
    return kept.select("word", F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "n")


def article_counts(
    articles: DataFrame,
    recodes: dict[str, str] | None = None,
    bad_ids=(),
    min_terms: int = 10,
    rare: int = 1,
    merge_plurals: bool = True,
) -> DataFrame:
    """The whole way from articles ``(doc_id, headline, description, category)`` to ``(doc_id, category, word, n)``.

    Unusable rows go (``bad_ids``: numbers or a table), categories are recoded, possessives stripped, both fields tokenised and counted
    without stop words; then long documents are kept, terms of several documents among them, and plural forms merged into their
    singular. These two rules are not repeated, so a document may end with fewer terms than the first one asks for.
    """
    rows = cleaning.drop_rows(articles, bad_ids) if isinstance(bad_ids, DataFrame) or bad_ids else articles
    rows = cleaning.clean_fields(cleaning.recode_category(rows, lexicon.CATEGORY_RECODES if recodes is None else recodes))
    joined = rows.select("doc_id", F.concat_ws("\n", "headline", "description").alias("text"))
    counts = filtered_counts(joined, min_terms, rare)
    counts = corpus.normalized_counts(counts) if merge_plurals else counts
    return skew.lookup(counts, rows.select("doc_id", "category"), "doc_id", spread="word").select("doc_id", "category", "word", "n")
