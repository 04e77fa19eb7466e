import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import SF, clashing, empty, labels, odd, workers_find_the_package  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicweave.llm import mixing, sharding, url_filter


def brute_targets(sizes, weights, share, most):
    """Excess given out again and again until no source is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, left = dict.fromkeys(names, 0.0), set(), share * sum(sizes.values())
    while left > 1e-6 and len(stopped) < len(names):
        open_ = [s for s in names if s not in stopped]
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in open_:
            if target[s] >= most * sizes[s]:
                left, target[s] = left + target[s] - most * sizes[s], float(most * sizes[s])
                stopped.add(s)
    return target


@pytest.mark.parametrize("name", ["odd", "clashing", "real"])
def test_mix(spark, request, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if name == "real" else request.getfixturevalue(name)
    plan = mixing.plan(docs)
    rows, again = plan.collect(), mixing.plan(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == docs.count()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    want = brute_targets(sizes, (3, 1, 2), 1.5, 2)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        if name == "real":
            assert abs(target[s] - taken[s]) <= 0.01 * target[s]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times"] for r in rows)
    words = Counter(r["source"] for r in mixed.select("source", F.explode(F.split(F.trim("text"), r"\s+")).alias("w")).where("w <> ''").collect())
    if name == "real":
        assert all(words[s] == taken[s] for s in taken)


def test_mix_of_nothing(empty):
    assert mixing.plan(empty).count() == mixing.mixed(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=7), st.integers(0, 300))
def test_fit_is_the_nearest_sum(counts, budget):
    lengths, numbers = np.array(list(counts)), np.array(list(counts.values()))
    got = mixing.fit(lengths, numbers, budget)
    assert (got >= 0).all() and (got <= numbers).all()
    reachable = {0}
    for size, most in zip(lengths, numbers):
        reachable = {r + int(size) * k for r in reachable for k in range(int(most) + 1)}
    assert int((got * lengths).sum()) == min(reachable, key=lambda r: (abs(r - budget), r))


def test_fit_of_large_budgets_is_exact():
    draw = np.random.default_rng(2)
    lengths = np.unique(draw.integers(1, 9000, 700))
    counts = draw.integers(1, 300, len(lengths))
    for budget in (5_000, 70_000, 4_000_000, int((lengths * counts).sum()) - 12_345):
        got = mixing.fit(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all() and int((got * lengths).sum()) == budget


@pytest.mark.parametrize("name", ["odd", "clashing", "real"])
def test_shards(spark, request, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if name == "real" else request.getfixturevalue(name)
    rows = sharding.sharded(docs, 4).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append((r["text"] or "").encode())
    assert len(rows) == docs.count() and {r["law"] for r in rows} == {"bytes"}
    bytes_, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        assert any((len(t) + 8, zlib.crc32(t)) == (r["size"], r["text_crc32"]) for t in texts[r["doc_id"]])
        bytes_[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(len(g) for g in groups.values()) == 1
    share, largest = sum(bytes_.values()) / 4, max(r["size"] for r in rows)
    if name == "real":
        assert all(abs(bytes_[k] - share) < 0.05 * share + largest for k in range(4))


def test_a_text_larger_than_shards_is_cut(spark):
    rows = [(i, "same text") for i in range(3000)] + [(3000 + i, f"text {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.sharded(docs, 6).groupBy("shard").agg(F.sum("size").alias("b"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    assert len(got) == 6 and all(r["m"] == r["n"] - 1 for r in got)
    assert max(r["b"] for r in got) < 1.25 * min(r["b"] for r in got)


def test_shards_of_nothing(empty):
    assert sharding.sharded(empty, 4).count() == 0


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[: min([i for c in "?#" if (i := path.find(c)) >= 0], default=len(path))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "https://EXAMPLE.net/en/x?y", "http://notexample.net/en/", "ftp://example.com/de/",
    "http://xexample.com/de/", "http://É.org/fr/?a=1&b=2#c", "http://a.org?/fr/", "http://a.org/fr", "http://a.b://c.net/x", "http://net/", "http://net/en/",
    "http://user:p@w.example.com:80/de/1\n2", "http://x.org/fr/" + "y" * 50000,
]


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 2)] + [(None, "http://a.net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit(1)).withColumn("suffix", F.lit(1))
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = brute_url(rows[r["page_id"]][1] if r["page_id"] is not None else "http://a.net/")
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict is None or verdict == r["verdict"]
    assert url_filter.judge(pages.where("page_id < 0")).count() == 0


def test_url_trees_learn_from_labels(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.com/{'a/' * (i % 6)}{i}") for i in range(600)], "page_id bigint, url string")
    labelled = pages.withColumn("blocked", F.col("page_id") % 6 > 3)
    got = url_filter.judge(pages, labelled).collect()
    assert sum((r["verdict"] == "block") == (r["page_id"] % 6 > 3) for r in got) == 600


def test_long_documents_may_pass_the_budget():
    assert list(mixing.fit([300_000], [3], 500_000)) == [2]
    assert list(mixing.fit([300_000], [3], 440_000)) == [1]


def test_urls_are_allowed_where_one_class_is_labelled(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a"), (2, None), (3, "http://other.xyz/")], "page_id bigint, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_fit_is_within_half_the_longest_document():
    draw = np.random.default_rng(4)
    for _ in range(20):
        lengths = np.unique(np.concatenate([draw.integers(1, 90, 3), draw.integers(100_000, 400_000, 3)]))
        counts = draw.integers(1, 6, len(lengths))
        budget = int(draw.integers(0, (lengths * counts).sum()))
        got = mixing.fit(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all() and abs(int((got * lengths).sum()) - budget) <= lengths.max() / 2
