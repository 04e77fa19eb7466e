"""Statistics of a whole text as column expressions: word, symbol and repetition counts.

Null and empty texts have zero everywhere. Everything is computed inside the row by JVM functions, so no word is shuffled;
the work for a text of n words is O(n log n).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import SPACES, characters_in, let, whole, words

# Fixed values.
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
MARKS = "!?"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "symbol_share", "capital_share", "digit_share", "mark_share", "distinct_share", "mean_word", "dup_line_share", "words_per_line",
)


def repeated_window_words(word_list: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words which the text holds twice or more, first one included.

    Windows are sorted with their places; equal neighbours are the repeated ones.
    """
    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(1), F.size(w) - width + 1),
            lambda i: F.struct(F.concat_ws(" ", *[w[i + (k - 1)] for k in range(width)]).alias("t"), i.alias("p")),
        ))

    def repeated(s: Column) -> Column:
        return F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["t"] == x["t"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["t"] == x["t"], F.lit(False)))

    def covered(s: Column) -> Column:
        spans = F.transform(repeated(s), lambda x: F.array(*[x["p"] + k for k in range(width)]))
        return F.size(F.array_distinct(F.flatten(spans)))

    count = F.when(F.size(word_list) > width, let(word_list, lambda w: let(windows(w), covered))).otherwise(0)
    return count.cast("long")


def duplicate_lines(text: Column) -> tuple[Column, Column]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return F.size(lines).cast("long"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def with_statistics(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """``doc_id`` with COUNTS, SHARES and ``text_digest`` (SHA-256), which tells rows of one id apart. ``repeats=False`` leaves out
    ``n_repeat_words``, the costly one."""
    text = F.col("_t")
    lines, dup = duplicate_lines(text)
    spread = docs.select("doc_id", whole().alias("_t")).withColumn("_w", words(text))
    counted = spread.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        characters_in(text, SYMBOLS).alias("n_symbols"),
        dup.alias("n_dup_lines"),
        *([repeated_window_words(F.col("_w")).alias("n_repeat_words")] if repeats else []),
        lines.alias("_lines"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        characters_in(text, CAPITALS).alias("_capitals"),
        characters_in(text, DIGITS).alias("_digits"),
        characters_in(text, MARKS).alias("_marks"),
        F.unhex(F.sha2(text, 256)).alias("text_digest"),
    )

    def share(part: str, of: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(of)), F.lit(0.0))

    return counted.select(
        "doc_id", *[c for c in COUNTS if c in counted.columns],
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("_capitals", "word_chars").alias("capital_share"),
        share("_digits", "word_chars").alias("digit_share"),
        share("_marks", "word_chars").alias("mark_share"),
        share("_distinct", "n_words").alias("distinct_share"),
        share("word_chars", "n_words").alias("mean_word"),
        share("n_dup_lines", "_lines").alias("dup_line_share"),
        share("n_words", "_lines").alias("words_per_line"), "text_digest",
    )


def one_row_each(stats: DataFrame) -> DataFrame:
    """One row of each id: the one with the least digest, so reruns agree."""
    rest = [c for c in stats.columns if c != "doc_id"]
    least = F.min_by(F.struct(*rest), "text_digest").alias("_row")
    return stats.groupBy("doc_id").agg(least).select("doc_id", "_row.*")
