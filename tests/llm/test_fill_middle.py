"""Fill-in-the-middle against a plain version, and the way back."""

import hashlib
import re

import pytest
from llm_fixtures import clashing, empty, odd, workers_find_the_package  # noqa: F401
from pyspark.sql import functions as F

from topicweave.llm import fill_middle

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def plain_version(doc_id, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in fill_middle.MARKERS) or h[2] % 100 >= 100 - plain:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def found(made):
    return sorted(map(tuple, made.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def texts(spark, odd):
    more = [(1000 + i, x) for i, x in enumerate(
        ["<P>", "a<S>b", "<M", "<<P>", "<", "<P", "P>", "\0a\x7f", "\U0001f600" * 3, "<S", "é<", "a" * 300_000, "é" * 50_000, "\n"])]
    more += [(2000 + i, f"one<two {i} <Pé> drei>\n" * (i % 7)) for i in range(150)]
    return odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))


@pytest.mark.parametrize("options", [{}, {"seed": 5, "plain": 0, "spm": 50}, {"plain": 100}])
def test_equals_plain_version(texts, options):
    made = fill_middle.fill_in_middle(texts, **options)
    assert found(made) == sorted((plain_version(r.doc_id, r.text, **options) for r in texts.collect()), key=str)


def test_every_form_occurs_and_leads_back(texts):
    made = fill_middle.fill_in_middle(texts)
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    back = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((r.doc_id, r.text or "") for r in texts.collect()), key=str)


def test_small_slices_make_the_same_rows(texts):
    assert found(fill_middle.fill_in_middle(texts, slice_bytes=10)) == found(fill_middle.fill_in_middle(texts))


def test_odd_tables(spark, clashing, empty, odd):
    assert found(fill_middle.fill_in_middle(clashing)) == found(fill_middle.fill_in_middle(odd))
    assert fill_middle.fill_in_middle(empty).collect() == []
    blank = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert found(fill_middle.fill_in_middle(blank)) == [(None, 0, "plain", None, None, "")]


def test_markers_that_could_be_confused_are_refused(odd):
    for markers in (("<P>", "<P>x", "<M>"), ("aba", "<S>", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(odd, markers=markers)
    own = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
    made = fill_middle.fill_in_middle(odd.where("doc_id = 11"), markers=own, plain=0)
    assert all(m in made.first().output for m in own)
