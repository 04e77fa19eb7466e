"""Repeated windows against brute force over all windows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import clashing, empty, odd, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from topicweave.llm import repeated_windows as rw

COLUMNS = ["doc_id", "n_words", "n_removed", "kept"]


def brute(rows, hashes, width=20):
    """Each row with the words that no window covers which stands earlier by (id, hash of the text, start)."""
    words = [(-(1 << 63) if i is None else i, h, (t or "").encode().split()) for (i, t), h in zip(rows, hashes)]
    first = {}
    for i, h, w in words:
        for s in range(len(w) - width + 1):
            key, place = b" ".join(w[s:s + width]), (i, h, s)
            first[key] = min(first.get(key, place), place)
    out = []
    for (doc_id, _), (i, h, w) in zip(rows, words):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[b" ".join(w[s:s + width])] != (i, h, s):
                gone.update(range(s, s + width))
        out.append((doc_id, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def expected(docs, width=20):
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    return brute([(r["doc_id"], r["text"]) for r in rows], [r["h"] for r in rows], width)


@pytest.fixture(scope="module")
def passages(spark):
    """Shared passages amid other words, passages that overlap themselves, texts of frequent words only, repeated ids."""
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = [[draw.choice(vocabulary) for _ in range(draw.randint(15, 70))] for _ in range(6)]
    rows = []
    for i in range(220):
        text = []
        for _ in range(draw.randint(0, 4)):
            text += [draw.choice(vocabulary) for _ in range(draw.randint(0, 40))]
            text += draw.choice(shared) if draw.random() < 0.7 else []
        if i % 3 == 0:
            text += ["the", "same", "line"] * draw.randint(1, 30)
        if i % 10 == 0:
            text += [draw.choice(["a", "b"]) for _ in range(60)]
        rows.append((i, draw.choice([" ", "\n", " \t ", "\x0b\x0c\r"]).join(text)))
    rows += [(5, "other text " + " ".join(shared[0])), (5, "other text " + " ".join(shared[0])), (None, " ".join(shared[0])),
             (None, " ".join(shared[1])), (None, None), (-3, " ".join(shared[2] * 3)), (900, " ".join(shared[3])),
             (901, "é " * 300), (902, "x" * 100_000), (903, "Ab " * 4000)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


@pytest.mark.parametrize("options", [{}, {"width": 3}, {"width": 7, "share": 0.01, "bucket_words": 50}, {"share": 1e-9}, {"width": 1}])
def test_equals_brute_force(passages, options):
    got = found(rw.without_repeats(passages, **options))
    assert got == expected(passages, options.get("width", 20))
    assert sum(r[2] for r in got) > 1000


def test_long_runs_flushes_and_slices_change_nothing(passages, monkeypatch):
    words = rw.Words([b"a b " * 300, b"", b"a b " * 20])
    none = np.zeros(rw.SLOTS, bool)
    text, start, windows, minimiser = rw.packed_runs(words, 20, none)
    assert windows.max() <= rw.LONGEST and len(set(minimiser.tolist())) == 1
    assert sum(windows[text == 0]) == 581 and sum(windows[text == 2]) == 21 and list(start[text == 2]) == [0]
    few = rw.Gathered()
    few.add(b"x y", (3, 0, 9), 1)
    few.add(b"x y", (2, 5, 1), 1)
    few.add(b"x z", (2, 5, 4), 8)
    assert few.places == [(2, 5, 1), (2, 5, 4)] and few.sent(7).to_pydict()["strings"] == [2]


def test_windows_are_numbered_exactly():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 3, 5000)
    for width in (1, 2, 3, 4, 9, 10, 20, 27, 28):
        starts = np.arange(len(words) - width + 1)
        got = rw.window_numbers(words, starts, width)
        by = {}
        for s, n in zip(starts, got):
            assert by.setdefault(tuple(words[s:s + width]), n) == n
        assert len(set(got)) == len(by)


def test_frequent_words_are_found_over_all_tasks(spark):
    rows = [(i, "often " * 5 + " ".join(f"v{i}_{k}" for k in range(95))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    slots, total = rw.frequent_slots(docs, 0.04)
    assert total == 6000 and list(slots) == [int(rw.Words([b"often"]).hashes()[0] % np.uint64(rw.SLOTS))]


def test_odd_tables(spark, odd, clashing, empty):
    assert found(rw.without_repeats(odd)) == found(rw.without_repeats(clashing)) == expected(odd)
    assert rw.without_repeats(empty).collect() == []
    blank = spark.createDataFrame([(None, None), (1, " ")], "doc_id long, text string")
    assert found(rw.without_repeats(blank)) == [(1, 0, 0, ""), (None, 0, 0, "")]


def test_packed_strings_travel_well_compressed():
    """Overlapping runs of words of many texts take less than at the codec's default level."""
    draw, gathered = random.Random(4), rw.Gathered()
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(3000)]
    for d in range(400):
        text = draw.choices(words, k=120)
        for start in range(0, 90, 10):
            gathered.add(" ".join(text[start:start + 30]).encode(), (d, hash((d,)), start), start)
    row = gathered.sent(1).to_pylist()[0]
    raw = pa.Codec("zstd").decompress(row["blob"], row["size"], asbytes=True)
    assert row["strings"] == len(gathered.number) and len(row["blob"]) < len(pa.Codec("zstd").compress(raw, asbytes=True))
