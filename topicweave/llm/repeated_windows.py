"""Removing passages that stand earlier in the corpus: windows of ``width`` words, found by super-k-mers.

A window's minimiser is the least hash among its words that aren't frequent; a window of frequent words only has the hash of the whole
window instead. Consecutive windows with one minimiser travel as one packed string, the words of all of them, to the bucket of that
minimiser. Equal windows have equal minimisers, so they meet in one bucket, and there sorting numbers the windows exactly: words by
their bytes, then tuples of numbers, up to the full width. The first occurrence of each window goes back to its document; every other
window of a document is a repeat.

Scale. *Frequent words* own more than ``share`` of all words; they are found over the whole corpus by a table of 2^20 counters a task,
of which a task reports only those that could matter, so at most ``4 / (3 * share)`` counters reach the driver. They decide routing
alone, never results; without them no minimiser draws more than ``width * share`` of the windows. *Copies*: equal strings of a task are
sent once, with their first place; what comes back are first occurrences, so a passage that every document holds adds a few rows.
*Buckets* hold about ``bucket_words`` words and are worked through one by one; their number grows with the corpus.

Order: a window starts earlier in a smaller id, or further to the front of the same document. Defined cases: a null text has no words
and an empty result; rows without id come first; rows that share an id are ordered by a hash of the text; rows that share id and text
are one document and get equal results; a document of fewer words than a window keeps all; an empty table gives an empty table; other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import mixed, slices, whole
from topicweave.session import materialize

NO_ID = -(1 << 63)
SLOTS = 1 << 20
ABSENT = np.uint64(2**64 - 1)
#: Windows in one packed string at most; longer runs are cut, which changes no window.
LONGEST = 64
#: Bytes of packed strings that a task gathers before it sends them.
GATHERED = 32 << 20
#: Level of compression of packed strings, most of what the job shuffles: an eighth less than at the default, for about 25 seconds a GB.
LEVEL = 5
TEXT_BYTES = 4 << 20
PLACE = "doc_id long, text_hash long"


# -- words and windows of some texts -----------------------------------------------------------------------------------

class Words:
    """The words of some texts: ``buffer`` holds them with a space behind each, ``begins`` where they begin, ``counts`` how many each
    text has."""

    def __init__(self, texts: list[bytes]):
        lists = [t.split() for t in texts]  # at the six ASCII characters that separate words
        self.counts = np.array([len(x) for x in lists], np.int64)
        self.buffer = b" ".join(chain.from_iterable(lists)) + b" " * bool(self.counts.sum())
        self.begins = np.concatenate([[0], np.flatnonzero(np.frombuffer(self.buffer, np.uint8) == 32) + 1])

    def hashes(self) -> np.ndarray:
        """A polynomial of the bytes of each word. It only routes, so equal hashes of different words do no harm."""
        if len(self.begins) == 1:
            return np.zeros(0, np.uint64)
        lengths = np.diff(self.begins)
        powers = np.cumprod(np.full(lengths.max(), 0x9E3779B97F4A7C15, np.uint64))
        place = np.arange(len(self.buffer)) - np.repeat(self.begins[:-1], lengths)
        terms = np.frombuffer(self.buffer, np.uint8).astype(np.uint64) * powers[place]
        return mixed(np.add.reduceat(terms, self.begins[:-1]))


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SLOTS)).astype(np.int64)


def over_windows(values: np.ndarray, width: int, combine: Callable) -> np.ndarray:
    """``combine`` of the values of each window, by windows of doubled width; the last two may overlap."""
    have = 1
    while have < width and len(values):
        step = min(have, width - have)
        values, have = combine(values[:-step], values[step:]), have + step
    return values


def packed_runs(words: Words, width: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, windows, minimiser`` of each run of windows: number of its text, first word in the text, length, hash."""
    hashes, n = words.hashes(), int(words.counts.sum())
    if n < width:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    least = over_windows(np.where(frequent[slots(hashes)], ABSENT, hashes), width, np.minimum)
    alone = least == ABSENT
    if alone.any():
        least[alone] = over_windows(hashes, width, lambda a, b: mixed(a * np.uint64(0x9E3779B97F4A7C15) + b))[alone]
    at = np.flatnonzero(text[:n - width + 1] == text[width - 1:])
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    runs = np.flatnonzero(new)
    new |= (np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % LONGEST == 0
    runs = np.flatnonzero(new)
    first_word = np.cumsum(words.counts) - words.counts
    of = text[at[runs]]
    return of, at[runs] - first_word[of], np.diff(np.append(runs, len(at))), least[runs]


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for part in slices(batch, TEXT_BYTES):
            yield part, Words(part.column("text").cast(pa.binary()).to_pylist())


# -- frequent words ----------------------------------------------------------------------------------------------------

def frequent_slots(docs: DataFrame, share: float) -> tuple[np.ndarray, int]:
    """Counters of words that own ``share`` of all words, and the number of words.

    A task leaves out counters below a quarter of the share of its own words, so a counter above the share reports three quarters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for _, words in texts_of(batches):
            counts += np.bincount(slots(words.hashes()), minlength=SLOTS)
        total = counts.sum()
        often = np.flatnonzero(counts > total * share / 4)
        yield pa.RecordBatch.from_pydict({"slot": np.append(often, -1), "n": np.append(counts[often], total)})

    counted = docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "frequent-words")
    total = (counted.where("slot = -1").select("n").first() or [0])[0]
    often = counted.where((F.col("slot") >= 0) & (F.col("n") > 0.75 * share * total)).select("slot").collect()
    return np.array([r["slot"] for r in often], np.int64), total


# -- packed strings ----------------------------------------------------------------------------------------------------

class Gathered:
    """Packed strings of a task with the first place of each, until they are sent."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.places: list[tuple[int, int, int]] = []
        self.minimisers: list[int] = []
        self.bytes = 0

    def add(self, string: bytes, place: tuple[int, int, int], minimiser: int) -> None:
        number = self.number.setdefault(string, len(self.places))
        if number == len(self.places):
            self.places.append(place)
            self.minimisers.append(minimiser)
            self.bytes += len(string)
        elif place < self.places[number]:
            self.places[number] = place

    def sent(self, buckets: int) -> pa.RecordBatch:
        """One row a bucket: strings by line, behind the columns of their places, compressed."""
        bucket = np.array(self.minimisers, np.uint64) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        strings, places = list(self.number), np.array(self.places, np.int64).reshape(-1, 3)
        numbers, begins = np.unique(bucket[order], return_index=True)
        blobs, sizes, counts = [], [], []
        for group in np.split(order, begins[1:]) if len(order) else []:
            blob = places[group].T.tobytes() + b"\n".join(strings[i] for i in group) + b"\n"
            blobs.append(pa.Codec("zstd", compression_level=LEVEL).compress(blob, asbytes=True))
            sizes.append(len(blob))
            counts.append(len(group))
        return pa.RecordBatch.from_pydict(
            {"bucket": numbers.astype(np.int64), "strings": np.array(counts, np.int64), "size": np.array(sizes, np.int64),
             "blob": pa.array(blobs, pa.binary())})


def packed_strings(docs: DataFrame, width: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """``bucket, strings, size, blob``: the super-k-mers of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(SLOTS, bool)
        often[frequent] = True
        gathered = Gathered()
        for batch, words in texts_of(batches):
            ids, hashes = (batch.column(c).to_numpy() for c in ("doc_id", "text_hash"))
            text, start, windows, minimiser = packed_runs(words, width, often)
            first_word = np.cumsum(words.counts) - words.counts
            word = first_word[text] + start
            begins, ends = words.begins[word], words.begins[word + windows + width - 1] - 1
            for row in zip(begins.tolist(), ends.tolist(), ids[text].tolist(), hashes[text].tolist(), start.tolist(), minimiser.tolist()):
                gathered.add(words.buffer[row[0]:row[1]], row[2:5], row[5])
                if gathered.bytes > GATHERED:
                    yield gathered.sent(buckets)
                    gathered = Gathered()
        yield gathered.sent(buckets)

    return docs.mapInArrow(run, "bucket long, strings long, size long, blob binary")


# -- buckets -----------------------------------------------------------------------------------------------------------

def numbered(columns: list[np.ndarray]) -> np.ndarray:
    """Equal numbers for equal tuples, different ones for different tuples."""
    code, size = columns[0], int(columns[0].max()) + 1
    for column in columns[1:]:
        span = int(column.max()) + 1
        if size * span >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            size = int(code.max()) + 1
        code, size = code * span + column, size * span
    return np.unique(code, return_inverse=True)[1]


def window_numbers(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A number for the window at each start, equal exactly for equal windows; ``words`` are numbers of words."""
    have = 1
    while have < width:
        if width <= 3 * have:
            offsets = sorted({0, min(have, width - have), width - have})
            return numbered([words[starts + o] for o in offsets])
        words = numbered([words[:len(words) - 2 * have], words[have:len(words) - have], words[2 * have:]])
        have *= 3
    return numbered([words[starts]])


def first_windows(rows: list[tuple[int, bytes]], width: int) -> pa.RecordBatch:
    """``doc_id, text_hash, start, windows``: runs of windows of a bucket that stand nowhere earlier. ``rows``: strings, blob."""
    places = np.concatenate([np.frombuffer(blob, np.int64, 3 * n).reshape(3, n) for n, blob in rows], axis=1)
    lines = b"".join(blob[24 * n:] for n, blob in rows)
    data = np.frombuffer(lines, np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    last = np.flatnonzero(data[ends] == 10)
    first = np.concatenate([[0], last[:-1] + 1])
    offsets = np.concatenate([[0], ends + 1])
    spaced = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(lines.replace(b"\n", b" "))])
    words = spaced.dictionary_encode().indices.to_numpy().astype(np.int64)
    windows = last - first - width + 2
    line = np.repeat(np.arange(len(first)), windows)
    inside = np.arange(len(line)) - np.repeat(np.cumsum(windows) - windows, windows)
    number = window_numbers(words, first[line] + inside, width)
    is_first = np.ones(len(number), bool)
    again = np.flatnonzero(np.bincount(number)[number] > 1)
    if len(again):
        of = line[again]
        order = np.lexsort((places[2][of] + inside[again], places[1][of], places[0][of], number[again]))
        same = number[again][order]
        is_first[again] = False
        is_first[again[order[np.concatenate([[True], same[1:] != same[:-1]])]]] = True
    kept = np.flatnonzero(is_first)
    new = np.concatenate([[True], (kept[1:] != kept[:-1] + 1) | (inside[kept[1:]] == 0)])
    runs = np.flatnonzero(new)
    of = line[kept[runs]]
    return pa.RecordBatch.from_pydict({
        "doc_id": places[0][of], "text_hash": places[1][of], "start": places[2][of] + inside[kept[runs]],
        "windows": np.diff(np.append(runs, len(kept)))})


def first_occurrences(packed: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_hash, start, windows`` of the windows that stand nowhere earlier, bucket by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "strings", "size", "blob"))):
                if row[0] != bucket and rows:
                    yield first_windows(rows, width)
                    rows = []
                bucket = row[0]
                rows.append((row[1], pa.Codec("zstd").decompress(row[3], row[2], asbytes=True)))
        if rows:
            yield first_windows(rows, width)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, f"{PLACE}, start long, windows long")


# -- documents ---------------------------------------------------------------------------------------------------------

def kept_words(words: list[bytes], firsts: list[dict] | None, width: int) -> list[bytes]:
    """The words that no repeated window covers."""
    if len(words) < width:
        return words
    repeat = np.ones(len(words) - width + 1, np.int64)
    for run in firsts or ():
        repeat[run["start"]:run["start"] + run["windows"]] = 0
    at = np.flatnonzero(repeat)
    if not len(at):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:len(repeat)] += repeat
    edges[width:] -= repeat
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def without_repeats(docs: DataFrame, width: int = 20, share: float = 1 / 16384, bucket_words: int = 300_000) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row of ``docs (doc_id, text)``: ``kept`` are the words that stay, with single spaces."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("id_"), whole().alias("text")).select(
        "id_", F.coalesce("id_", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    frequent, total = frequent_slots(keyed, share)
    packed = packed_strings(keyed.drop("id_"), width, frequent, max(1, total // bucket_words))
    runs = first_occurrences(packed, width).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "windows")).alias("firsts"))
    runs = materialize(runs, "first-windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, TEXT_BYTES):
                texts, firsts = part.column("text").cast(pa.binary()).to_pylist(), part.column("firsts").to_pylist()
                words = [t.split() for t in texts]
                kept = [kept_words(w, f, width) for w, f in zip(words, firsts)]
                yield pa.RecordBatch.from_arrays([
                    part.column("id_"), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64()),
                    pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n_words", "n_removed", "kept"])

    joined = keyed.join(runs, ["doc_id", "text_hash"], "left").select("id_", "text", "firsts")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
