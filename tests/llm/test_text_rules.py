import re
from collections import Counter

import pytest
from llm_fixtures import SF, clashing, empty, labels, odd, workers_find_the_package  # noqa: F401

from topicweave.llm import quality_rules, quality_trees, text_stats
from topicweave.llm.histogram_trees import Training, fit


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:]))
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("name", ["odd", "clashing", "real"])
def test_counts(spark, request, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if name == "real" else request.getfixturevalue(name)
    want = sorted((str(r["doc_id"]), *counts(r["text"])) for r in docs.select("doc_id", "text").collect())
    got = text_stats.with_statistics(docs).collect()
    assert sorted((str(r["doc_id"]), *[r[c] for c in text_stats.COUNTS]) for r in got) == want


def test_rules_find_a_planted_conjunction(spark):
    rows = [(i, float(i % 10), float(i % 7), i % 10 > 6 and i % 7 <= 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, a double, b double, junk boolean")
    found = quality_rules.learn(df, ["a", "b"], "junk")
    assert df.where(found.rejects() != df["junk"]).count() == 0
    assert {c.feature for c in found.rules[0].conditions} == {"a", "b"}


def test_verdicts(spark, odd, clashing, empty, labels):
    for docs in (odd, clashing):
        got = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
        assert len(got) == 58 and got[0]["base_failed"] and got[13]["base_failed"] and not got[0]["kept"] and got[6]["kept"]
    assert quality_rules.judge(empty, labels).count() == 0
    assert not quality_rules.learn(odd.selectExpr("doc_id", "1D a", "null junk"), ["a"], "junk").rules


def test_junk_goes_and_clean_stays(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    passed = [d for d in known if not got[d]["base_failed"]]
    assert sum(got[d]["kept"] == bool(known[d]) for d in passed) >= 0.97 * len(passed)


def test_trees_score_held_out_rows(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_trees.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_trees_on_odd_tables(odd, clashing, empty, labels):
    for docs in (odd, clashing):
        rows = quality_trees.scored(docs, labels).collect()
        assert len(rows) == 59 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_trees.scored(empty, labels).count() == 0
    assert {r["score"] for r in quality_trees.scored(odd, labels.where("quality = 5")).collect()} == {0.5}


def test_flat_forest_equals_recursion():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(500, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] < -0.1)).astype(float)
    forest = fit(x, y, Training(trees=30, depth=3))

    def walk(row, node):
        while forest.below[node] != node:
            node = forest.below[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.above[node]
        return forest.value[node]

    want = [forest.base + sum(walk(r, n) for n in forest.roots) for r in x]
    assert np.allclose(forest.margin(x), want) and ((forest.score(x) > 0.5) == y).mean() > 0.97
