"""Grouping spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so words become reduced words over a small alphabet. Every reduced word generates its
neighbourhood of one edit, which over few symbols is short, and these are joined with the reduced vocabulary. Words whose reduced words
are equal or neighbours are candidates; the edit distance of the words themselves decides. Being near is mutual, so each pair is
generated from one side only: from the longer reduced word by deletion, else by replacing a symbol with a lower one.

Everything is a shuffle join on distinct keys. *Symbols*: letters are dealt to them by their counts, so that all are about equally
frequent; their number grows with the vocabulary, and is doubled until no reduced word has more than ``crowd`` words, at last up to one
symbol a letter, where every reduced word is one word. Neighbours travel as 64-bit keys, whatever the length of a word. The letter counts (90 at most) are all that reaches the driver.

A word's form is its most frequent near word, if that is ``factor`` times as frequent, so forms lead upwards in frequency and end after
few steps; roots are found by doubling these steps.

Defined cases: a null text has no words; a null id is hashed as the empty string; ties between near words go to the smallest in
code-point order; repeated rows count each time; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import let, mixed, slices, whole
from topicweave.session import materialize

# Fixed values.
LETTERS = r"A-Za-zÀ-ÿ"
FIRST = "!"  # the first symbol; the others follow in ASCII
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of reduced words that are worked on at once, and rows of a batch that leaves.
BATCH, ROWS = 1 << 17, 1 << 16


# -- words -------------------------------------------------------------------------------------------------------------

def runs(text: Column, shortest: int) -> Column:
    """Maximal runs of letters with ``shortest`` letters or more, A-Z in lower case."""
    found = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    return F.transform(found, lambda run: F.translate(run, CAPITALS, SMALL))


def worn(run: Column, doc_id: Column, every: int) -> Column:
    """The run, or, where its checksum with the id is a multiple of ``every``, the run without one letter."""
    def without(h: Column) -> Column:
        place = (h % F.length(run)).cast("int")
        return F.when(h % every == 0, F.concat(run.substr(F.lit(1), place), run.substr(place + 2, F.length(run)))).otherwise(run)

    return let(F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary")), without)


def vocabulary(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """``word, n`` of the words with ``shortest`` letters that occur ``least`` times."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(ids.alias("id"), F.explode(runs(whole(), shortest)).alias("run"))
    words = found.select(worn(F.col("run"), F.col("id"), every).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# -- reduced words -----------------------------------------------------------------------------------------------------

def dealt(counts: dict[str, int], symbols: int) -> tuple[str, str]:
    """Letters and the symbol of each: the most frequent first, always to the symbol with the fewest so far."""
    load, given = [0] * symbols, {}
    for letter, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        symbol = load.index(min(load))
        given[letter], load[symbol] = chr(ord(FIRST) + symbol), load[symbol] + n
    return "".join(given), "".join(given.values())


def reduced_alphabet(words: DataFrame, shortest: int, crowd: int) -> tuple[str, str]:
    """Letters and their symbols, few enough that neighbourhoods are short and enough that no reduced word is crowded."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    counts = {r["letter"]: r["count"] for r in letters.collect() if r["letter"]}
    symbols = math.ceil(words.count() ** (1 / shortest)) + 1
    while True:
        letters, marks = dealt(counts, max(1, min(symbols, len(counts))))
        if symbols >= len(counts):
            return letters, marks
        largest = words.groupBy(F.translate("word", letters, marks)).count().agg(F.max("count")).first()[0]
        if largest <= crowd:
            return letters, marks
        symbols *= 2


class Reduced:
    """Keys of the reduced words of a batch and of their neighbours.

    The key of a word is the exclusive or of one hash for each place and symbol, so replacing a symbol changes one term, and deleting one
    joins what stands before it with what stands behind it, one place further to the front. All words of a batch are done at once.
    """

    def __init__(self, words: pa.Array):
        self.words = words.cast(pa.large_binary())
        offsets = np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset:self.words.offset + len(words) + 1]
        data = np.frombuffer(self.words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        self.symbol, self.lengths = data.astype(np.int64) - ord(FIRST), np.diff(offsets)
        self.begins = offsets[:-1] - offsets[0]
        self.place = np.arange(len(data)) - np.repeat(self.begins, self.lengths)
        self.here = self.term(self.place, self.symbol)
        self.before = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(self.here)])
        self.keys = self.before[self.begins + self.lengths] ^ self.before[self.begins]

    @staticmethod
    def term(place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return mixed((place * 128 + symbol + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words and keys: each word itself, then without one symbol, then with a lower symbol in one place."""
        word = np.repeat(np.arange(len(self.lengths)), self.lengths)
        ahead = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(self.term(self.place - 1, self.symbol))])
        end, begin = (self.begins + self.lengths)[word], self.begins[word]
        at = np.arange(len(word))
        # of equal symbols side by side any may go, so the first does
        gone = at[(self.place == 0) | (self.symbol != np.concatenate([[-1], self.symbol[:-1]]))]
        deleted = self.before[gone] ^ self.before[begin[gone]] ^ ahead[end[gone]] ^ ahead[gone + 1]
        put = np.repeat(at, self.symbol)
        lower = np.arange(len(put)) - np.repeat(np.cumsum(self.symbol) - self.symbol, self.symbol)
        replaced = self.keys[word[put]] ^ self.here[put] ^ self.term(self.place[put], lower)
        return (
            np.concatenate([np.arange(len(self.lengths)), word[gone], word[put]]), np.concatenate([self.keys, deleted, replaced]))


def keyed(words: DataFrame, letters: str, marks: str) -> DataFrame:
    """``reduced, key, word, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BATCH, "reduced"):
                keys = pa.array(Reduced(part.column("reduced")).keys.view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("reduced"), keys, *part.columns[1:]], names=["reduced", "key", "word", "n"])

    reduced = words.select(F.translate("word", letters or " ", marks or " ").alias("reduced"), "word", "n")
    return reduced.mapInArrow(run, "reduced string, key long, word string, n long")


def neighbourhoods(reduced: DataFrame) -> DataFrame:
    """``key, neighbour`` for the neighbourhood of each reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BATCH, "reduced"):
                made = Reduced(part.column("reduced"))
                word, neighbour = made.neighbours()
                for at in range(0, len(word), ROWS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[at:at + ROWS].view(np.int64)) for x in (made.keys[word], neighbour)], names=["key", "neighbour"])

    return reduced.mapInArrow(run, "key long, neighbour long")


def near_pairs(words: DataFrame, shortest: int = 7, crowd: int = 32) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of words with one letter inserted, deleted or replaced, once.

    Equal keys of different reduced words only add candidates, and a pair of keys is taken once whichever side made it.
    """
    known = materialize(keyed(words, *reduced_alphabet(words, shortest, crowd)), "reduced-words")
    generated = neighbourhoods(known.select("reduced", "key").distinct().select("reduced"))
    met = generated.join(known.select(F.col("key").alias("neighbour")).distinct(), "neighbour").select(
        F.least("key", "neighbour").alias("low"), F.greatest("key", "neighbour").alias("high")).distinct()
    a = known.select(F.col("key").alias("low"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = known.select(F.col("key").alias("high"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    candidates = met.join(a, "low").join(b, "high").where((F.col("low") != F.col("high")) | (F.col("a") < F.col("b")))
    return candidates.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


# -- forms and roots ---------------------------------------------------------------------------------------------------

def with_forms(words: DataFrame, pairs: DataFrame, factor: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n``."""
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best")
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), best)
    often = -F.col("best.rank") >= factor * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.rank")).alias("form_n"))


def with_roots(forms: DataFrame, factor: int = 10) -> DataFrame:
    """Adds ``root``: the last word that forms lead to, the word itself if it has none."""
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    largest = forms.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(largest, factor)))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        links = materialize(links, "links")
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(
    docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, factor: int = 10, crowd: int = 32,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs (doc_id, text)``."""
    words = materialize(vocabulary(docs, shortest, least, every), "vocabulary")
    forms = materialize(with_forms(words, near_pairs(words, shortest, crowd), factor), "forms")
    return with_roots(forms, factor).select("word", "form", "root", "n", "n_near", "form_n")
