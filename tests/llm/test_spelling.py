"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from llm_fixtures import clashing, empty, odd, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from topicweave.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
SMALL = str.maketrans(spelling.CAPITALS, spelling.SMALL)


def brute_words(rows, shortest=7, least=2, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, factor=10, **options):
    words = brute_words(rows, **options)
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    forms = {w: b for w, b in best.items() if words[b] >= factor * words[w]}

    def root(w):
        return root(forms[w]) if w in forms else w

    return sorted((w, forms.get(w), root(w), n, len(near[w]), words.get(forms.get(w))) for w, n in words.items())


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.fixture(scope="module")
def variants(spark):
    """Chains of forms, ties, letters outside ASCII, one word in a third of all places."""
    draw = random.Random(3)
    words = ["mountain", "fountain", "straßen", "naïveté", "àéîõüÿß", "abcdefg", "bcdefgh", "xyzxyzx", "mountains"]
    rows = []
    for i in range(400):
        text = []
        for _ in range(30):
            w = "mountain" if draw.random() < 0.34 else draw.choice(words)
            if draw.random() < 0.15:
                at, kind = draw.randrange(len(w)), draw.randrange(3)
                new = draw.choice("aeß×÷z")
                w = w[:at] + (new if kind < 2 else "") + w[at + (kind > 0):]
            if draw.random() < 0.02:
                w = w[0] + "q" + w[1:] + "k"
            text.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((i, draw.choice([" ", ", ", "1", "-", "\n"]).join(text)))
    rows += [(None, "mountaim " * 9), (None, None), (7, ""), (8, "aaaaaaa aaaaaab " * 2), (9, "ÉCOLIERS écoliers Écoliers " * 3)]
    rows += [(10_000 + i, "mountain mountaim montain montan " + "montane " * (i % 5 == 0)) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("options", [{}, {"every": 3, "factor": 2}, {"shortest": 3, "least": 1, "every": 5}])
def test_equals_brute_force(variants, options):
    assert found(spelling.variants(variants, **options)) == brute([tuple(r) for r in variants.collect()], **options)


def test_any_alphabet_gives_the_same_pairs(variants, monkeypatch):
    words = spelling.vocabulary(variants)
    want = sorted(map(tuple, spelling.near_pairs(words).select(F.least("a", "b"), F.greatest("a", "b")).collect()))
    assert len(want) == len(set(want)) > 50
    counts = Counter("".join(r["word"] for r in words.collect()))
    for symbols in (1, 2, 5, len(counts)):
        monkeypatch.setattr(spelling, "reduced_alphabet", lambda *_, s=symbols: spelling.dealt(counts, s))
        assert sorted(map(tuple, spelling.near_pairs(words).select(F.least("a", "b"), F.greatest("a", "b")).collect())) == want


def test_symbols_grow_until_nothing_is_crowded(spark):
    rows = [("".join("ab"[i >> k & 1] for k in range(8)), 5) for i in range(256)]
    words = spark.createDataFrame(rows, "word string, n long")
    letters, marks = spelling.reduced_alphabet(words, 7, 1)
    assert sorted(letters) == ["a", "b"] and len(set(marks)) == 2
    assert spelling.near_pairs(words, 7, 1).count() == 256 * 8 // 2


def test_chains_of_forms_lead_to_their_end(spark):
    rows = [(f"aaaaaaa{'b' * i}", 10 ** i) for i in range(10)] + [("zzzzzzz", 10 ** 9)]
    words = spark.createDataFrame(rows, "word string, n long")
    forms = spelling.with_forms(words, spelling.near_pairs(words))
    roots = {r["word"]: r["root"] for r in spelling.with_roots(forms).collect()}
    assert roots == {w: "zzzzzzz" if w == "zzzzzzz" else "aaaaaaa" + "b" * 9 for w, _ in rows}


def test_odd_tables(spark, odd, clashing, empty):
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], shortest=3)
    assert found(spelling.variants(odd, shortest=3)) == found(spelling.variants(clashing, shortest=3)) == want
    assert spelling.variants(empty).collect() == []
    assert spelling.variants(spark.createDataFrame([(None, None), (1, "x y")], "doc_id long, text string")).collect() == []
    long = spark.createDataFrame([(1, "a" * 200_000 + " " + "a" * 200_000)], "doc_id long, text string")
    [row] = spelling.variants(long, every=1 << 33).collect()
    assert (len(row["word"]), row["n"], row["n_near"]) == (200_000, 2, 0)
