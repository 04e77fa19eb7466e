import hashlib
import re
from collections import defaultdict
from itertools import combinations

import pytest
from llm_fixtures import SF, clashing, empty, labels, odd, workers_find_the_package  # noqa: F401

from topicweave.llm import exact_dedup, ngram_join


def test_exact_groups(spark, odd, clashing):
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r["text"] or ""].append(r["doc_id"])
    for docs in (odd, clashing):
        got = exact_dedup.new_index(spark).add(docs).collect()
        assert len(got) == 59
        for r in got:
            group = next(ids for t, ids in texts.items() if hashlib.sha256(t.encode()).digest() == r["digest"])
            assert r["group_size"] == len(group) and r["keep_id"] == max((i for i in group if i is not None), default=None)
        assert sum(r["kept"] for r in got) == len(texts)
        left = exact_dedup.without_copies(docs, exact_dedup.new_index(spark))
        assert left.columns == docs.columns
        assert sorted((r["text"] or "" for r in left.collect())) == sorted(texts)


def test_index_persists_and_grows(spark, odd, empty):
    index = exact_dedup.new_index(spark, buckets=4)
    first, second = odd.where("doc_id < 8 or doc_id is null"), odd.where("doc_id >= 4")
    assert index.add(empty).count() == 0
    a = {r["doc_id"]: r["kept"] for r in index.add(first).collect()}
    again = {r["doc_id"]: r["kept"] for r in index.add(first).collect()}
    assert a == again and a[7] and not a[6] and a[4] and not a[3] and a[1] and not a[0]
    b = {r["doc_id"]: r for r in exact_dedup.DigestIndex(spark, index.path).add(second).collect()}
    assert b[4]["kept"] and b[7]["kept"] and not b[6]["kept"] and b[8]["kept"]
    assert index.table().count() == odd.selectExpr("coalesce(text, '')").distinct().count()


def test_index_grows_its_buckets_and_is_found_by_a_new_session(spark, odd):
    index = exact_dedup.new_index(spark, buckets=2, bucket_rows=8)
    first, second = odd.where("doc_id < 120"), odd.where("doc_id >= 110 or doc_id is null")
    decided = [index.add(first).collect(), index.add(second).collect()]
    texts = odd.selectExpr("coalesce(text, '')").distinct().count()
    assert index.buckets == 16 and index.table().count() == texts
    other = exact_dedup.DigestIndex(spark.newSession(), index.path, bucket_rows=8)
    assert other.buckets == 16 and other.table().count() == texts
    assert sorted(map(str, other.add(second).collect())) == sorted(map(str, decided[1]))
    whole = {r["digest"] for part in decided for r in part if r["kept"]}
    assert len(whole) == texts


def test_a_text_under_many_ids(spark):
    rows = [(i, "same") for i in range(4000)] + [(i, f"text {i}") for i in range(4000, 5000)] + [(None, "same")] * 3
    got = exact_dedup.new_index(spark).add(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == 1001
    assert {(r["keep_id"], r["group_size"]) for r in got if r["doc_id"] is None or r["doc_id"] < 4000} == {(3999, 4003)}


def brute_components(docs):
    sets = {}
    for doc_id, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = ({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in {p for h in holders.values() for p in combinations(sorted(h), 2)}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_components_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.joined(docs).collect()}
    assert got == want


@pytest.mark.parametrize("how", [{}, {"neighbours": (1,), "hot": 1, "block": 7}, {"neighbours": (1,), "hot": 10**6}, {"frequent": 0, "hot": 3, "block": 4}])
def test_families_of_near_copies(spark, how):
    """Chains of edits: many links hold between neighbours only, and frequent passages link nothing by themselves."""
    import random

    draw, docs = random.Random(4), []
    passage = [f"p{i}" for i in range(20)]
    for family in range(6):
        words = [f"f{family}x{i}" for i in range(90)]
        for _ in range(25):
            words = list(words)
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = f"e{draw.random()}"
            docs.append((len(docs), " ".join(words + passage)))
    draw.shuffle(docs)
    got = ngram_join.joined(spark.createDataFrame(docs, "doc_id bigint, text string"), ngram_join.Similarity(**how))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_components(docs)


def test_join_on_odd_tables(odd, clashing, empty):
    want = brute_components([(r["doc_id"], r["text"]) for r in odd.where("doc_id is not null").collect()])
    for docs in (odd, clashing):
        got = ngram_join.joined(docs).collect()
        assert len(got) == 59
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert ngram_join.joined(empty).count() == 0


def test_prefix_lengths():
    how = ngram_join.Similarity()
    for n in range(1, 300):
        # the fewest shared shingles a similar set needs, and one more than can be missed
        least = min(m for m in range(1, n + 1) if 100 * m >= 80 * n)
        assert how.prefix(n) == n - least + 1


def brute_links(docs):
    """For each row the number of other rows with a similar set, and the pairs of different sets."""
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}))
    alike = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    counts = sorted((d, sum(alike(a, b) for j, b in enumerate(sets) if i != j)) for i, ((d, _), a) in enumerate(zip(docs, sets)))
    rep = {s: min(d for (d, _), x in zip(docs, sets) if x == s) for s in sets}
    size = {s: sets.count(s) for s in rep}
    found = sorted((rep[a], rep[b], size[a], size[b]) for a in rep for b in rep if rep[a] < rep[b] and alike(a, b))
    return counts, found


@pytest.mark.parametrize("how", [{}, {"neighbours": (1,), "hot": 1, "block": 7, "tile": 5}, {"hot": 3, "tile": 8, "tile_shingles": 900}])
def test_every_link_is_counted(spark, how):
    """Two families in which many different sets are similar, some of them in several copies, and texts that are alone."""
    import random

    draw, docs = random.Random(9), []
    for family in range(2):
        words = [f"f{family}x{i}" for i in range(200)]
        for _ in range(30):
            edited = list(words)
            for _ in range(draw.randint(1, 4)):
                edited[draw.randrange(len(edited))] = f"e{draw.random()}"
            docs += [" ".join(edited)] * draw.choice((1, 1, 1, 3))
    docs += ["", "too short", "too short", "alone " * 3 + "with these seven words of text"]
    draw.shuffle(docs)
    docs = list(enumerate(docs))
    counts, found = brute_links(docs)
    assert len(found) > 300
    table, how = spark.createDataFrame(docs, "doc_id bigint, text string"), ngram_join.Similarity(**how)
    assert sorted((r["doc_id"], r["n_links"]) for r in ngram_join.joined(table, how).collect()) == counts
    assert sorted(map(tuple, ngram_join.pairs(table, how).collect())) == found


def test_links_of_rows_that_share_an_id(spark):
    base = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(base), " ".join(base[:-1] + ["x"]), " ".join(f"v{i}" for i in range(60))
    docs = [(3, a), (5, a), (5, c), (6, b), (7, c), (7, c)]
    got = ngram_join.joined(spark.createDataFrame(docs + [(None, c)], "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in got if r["doc_id"] is not None) == brute_links(docs)[0]
    assert [r["n_links"] for r in got if r["doc_id"] is None] == [None]


def test_histograms_never_hide_a_shared_shingle():
    import numpy as np

    draw = np.random.default_rng(5)
    for n in (1, 7, 400, 20_000):
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], draw.integers(0, 1 << 63, n, dtype=np.uint64)]))
        x, y = (np.frombuffer(ngram_join.histogram(s, 256), np.uint8).astype(int) for s in (a, b))
        assert x.sum() == len(a) and np.minimum(x, y).sum() >= len(np.intersect1d(a, b))
    assert ngram_join.histogram(np.arange(256 * 300, dtype=np.uint64), 256) is None
