"""Packed chains against plain loops, and several chains against single ones."""

from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicweave.functions.digests import md5_heads
from topicweave.operators import heads, packed
from topicweave.plans import gibbs, study


def uniform(*parts):
    return (int(md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def plain_sweeps(rows, model, sweeps, factor=None):
    """Topics of all copies by (document, word, copy) after synchronous sweeps, one copy at a time."""
    k, block = model.k, model.grain == "block"
    z = {(d, w, r): int(md5(f"{d}|{w}|{r}|{model.seed}".encode()).hexdigest()[:8], 16) % k for d, w, n in rows for r in range(1, n + 1)}
    for sweep in range(1, sweeps + 1):
        nd, nw, nk, own = {}, {}, np.zeros(k), {}
        for (d, w, r), t in z.items():
            nd.setdefault(d, np.zeros(k))[t] += 1
            nw.setdefault(w, np.zeros(k))[t] += 1
            own.setdefault((d, w), np.zeros(k))[t] += 1
            nk[t] += 1
        drawn = {}
        for (d, w, r), t in z.items():
            mine = own[d, w] if block else np.eye(k)[t]
            p = (nd[d] - mine + model.alpha) * (nw[w] - mine + model.beta) / (nk - mine + model.beta * len(nw))
            p = p * factor(d, mine, nd[d]) if factor else p
            bounds = np.cumsum(p)
            drawn[d, w, r] = int((uniform(d, w, r, f"{model.seed}.{sweep}") * bounds[-1] >= bounds[:-1]).sum())
        z = drawn
    return z


def corpus(documents=23, seed=1):
    draw = np.random.default_rng(seed)
    return sorted({(int(d), f"w{int(w)}"): (int(d), f"w{int(w)}", int(n)) for d, w, n in zip(
        draw.integers(0, documents, 160), draw.integers(0, 30, 160), draw.integers(1, 5, 160))}.values())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, word string, n bigint").repartition(3)


@pytest.mark.parametrize("grain, k", [("block", 3), ("block", 31), ("token", 5)])
def test_sweeps_equal_a_plain_loop(spark, monkeypatch, grain, k):
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    monkeypatch.setattr(packed, "CELLS", 64)
    rows, model = corpus(), gibbs.Model(k=k, grain=grain, seed=3)
    chain = gibbs.Chain(spark, model).start(table(spark, rows)).run(2)
    assert chain.buckets > 2
    want = plain_sweeps(rows, model, 2)
    state = chain.state().collect()
    if grain == "token":
        assert {(r["doc_id"], r["word"], r["rep"]): r["z"] for r in state} == want
    else:
        for r in state:
            got = np.bincount([want[r["doc_id"], r["word"], i] for i in range(1, r["n"] + 1)], minlength=k)
            assert r["c"] == got.tolist()
        assert len(state) == len(rows)


@pytest.mark.parametrize("kind", ["label", "ratio"])
def test_heads_weigh_the_draws(spark, kind):
    rows, eta = corpus(), np.array([[1.5, -1.0, 0.3], [-0.7, 0.9, 0.1], [0.2, 0.4, -2.0]])
    classes = {d: d % 3 for d in range(15)}

    def factor(d, own, counts):
        length, size = counts.sum(), own.sum()
        if kind == "label":
            if d not in classes:
                return np.ones(3)
            moved = np.array([[np.exp(eta[c] @ (counts - own + size * np.eye(3)[i]) / length) for i in range(3)] for c in range(3)])
            return moved[classes[d]] / moved.sum(axis=0)
        first, second = np.exp(eta @ counts / length), np.exp(eta @ (counts - own) / (length - size)) if length > size else np.ones(3)
        return (first / first.sum()) / (second / second.sum())

    model = gibbs.Model(k=3, grain="token", head=gibbs.Head(kind, tuple(map(tuple, eta.tolist()))))
    labels = spark.createDataFrame(sorted(classes.items()), "doc_id bigint, y int")
    chain = gibbs.Chain(spark, model).start(table(spark, rows), labels).run(2)
    assert {(r["doc_id"], r["word"], r["rep"]): r["z"] for r in chain.state().collect()} == plain_sweeps(rows, model, 2, factor)


def test_chains_side_by_side_equal_single_ones(spark):
    models = [gibbs.Model(k=2), gibbs.Model(k=4, seed=9, alpha=0.3), gibbs.Model(k=2, seed=8, beta=0.2)]
    parts = [corpus(seed=s) for s in (1, 2, 3)]
    rows = [(c, *r) for c, part in enumerate(parts) for r in part]
    both = gibbs.Chains(spark, models).start(spark.createDataFrame(rows, "chain int, doc_id bigint, word string, n bigint")).run(2, keep_from=2)
    for c, (model, part) in enumerate(zip(models, parts)):
        one = gibbs.Chain(spark, model).start(table(spark, part)).run(2, keep_from=2)
        for name, key in (("state", ("doc_id", "word")), ("gamma", ("doc_id",)), ("beta", ("word",))):
            got = getattr(both, name)().where(F.col("chain") == c).drop("chain")
            assert sorted(map(str, got.collect())) == sorted(map(str, getattr(one, name)().collect())), name
        kept = both.samples("beta").where(F.col("chain") == c).drop("chain")
        assert sorted(map(str, kept.collect())) == sorted(map(str, one.samples("beta").collect()))


def test_features_equal_those_of_the_weights(spark):
    chain = gibbs.Chain(spark, gibbs.Model(k=3)).start(table(spark, corpus())).run(1)
    blocks = gibbs.block_probabilities(gibbs.weigh(chain.state(), chain.model), 3)
    want = {r["doc_id"]: r["g"] for r in heads.mean_probabilities(blocks, 3).collect()}
    got = {r["doc_id"]: r["g"] for r in chain.block_features().collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[d], want[d], atol=1e-12) for d in got)


def test_a_head_learns_between_sweeps(spark):
    rows = [(d, f"{'ab'[d % 2]}{w}", 2) for d in range(30) for w in range(6)]
    labels = spark.createDataFrame([(d, d % 2) for d in range(20)], "doc_id bigint, y int")
    chain = gibbs.Chain(spark, gibbs.Model(k=2)).start(table(spark, rows), labels).learn_head(2, 6, rate=4.0)
    eta = np.array(chain.model.head.eta)
    assert not np.allclose(eta, 0.5) and chain.documents().count() == 30
    topics = {r["doc_id"]: int(np.argmax(r["counts"])) for r in chain.documents().collect()}
    assert len({topics[d] for d in range(0, 20, 2)} | {topics[d] for d in range(1, 20, 2)}) == 2
    best = {c: int(np.argmax(eta[c])) for c in (0, 1)}
    assert sum(topics[d] == best[d % 2] for d in range(20)) >= 18


def test_members_and_classes_of_sets(spark):
    docs = spark.createDataFrame([(1, "b", "x"), (2, "a", "x"), (3, "c", "y"), (4, None, "y")], "doc_id bigint, lang string, source string")
    sets = [study.CategorySet("lang", ("b", "a", "zz")), study.CategorySet("source", ("y",)), study.CategorySet("lang", ("c", "b"))]
    rows = study.members(docs, sets)
    assert sorted(map(tuple, rows.collect())) == [(0, 1, "b"), (0, 2, "a"), (1, 3, "y"), (1, 4, "y"), (2, 1, "b"), (2, 3, "c")]
    assert sorted(map(tuple, study.set_classes(rows).collect())) == [(0, "a", 0), (0, "b", 1), (1, "y", 0), (2, "b", 0), (2, "c", 1)]


def test_digests_of_many_texts():
    texts = ["x" * i for i in range(130)] + ["é" * i for i in range(70)] + [f"{i}|wörter|1|7.{i}" for i in range(5000)]
    want = [int(md5(t.encode()).hexdigest()[:8], 16) for t in texts]
    assert md5_heads(pa.array(texts)).tolist() == want and md5_heads(pa.array(texts)[100:]).tolist() == want[100:]
    assert md5_heads(pa.array([], pa.string())).tolist() == []


def test_buckets_grow_with_the_corpus_instead_of_their_number():
    """Each bucket holds the frequent words once more, so ten times the pairs must not mean ten times the rows of words."""
    small, large, huge = (gibbs.bucket_number(n, 1, 12) for n in (2_000_000, 20_000_000, 2_000_000_000))
    assert small == 31 and large == 48 and huge == -(-2_000_000_000 // gibbs.MOST_PAIRS)
    assert gibbs.bucket_number(0, 1, 4) == gibbs.bucket_number(10, 3, 4) == 1
    assert gibbs.bucket_number(40_000_000, 4, 12) == 12


def test_the_state_holds_text_only_with_words(spark, monkeypatch):
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    chain = gibbs.Chain(spark, gibbs.Model(k=3)).start(table(spark, corpus())).run(1)
    assert [f.name for f in chain.documents().schema.fields if "string" in f.dataType.simpleString()] == []
    assert chain._rows().where("doc_id is not null and word is not null").count() == 0


def test_labels_meet_documents_in_their_bucket(spark, monkeypatch):
    """Rows of words have no document; a join on it would send them all to one task."""
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    plans, write = [], gibbs.Chains._write
    monkeypatch.setattr(gibbs.Chains, "_write", lambda self, rows, sweep: (plans.append(rows._jdf.queryExecution().toString()), write(self, rows, sweep))[1])
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id bigint, y int")
    chain = gibbs.Chain(spark, gibbs.Model(k=2)).start(table(spark, corpus()), labels)
    assert " Join" not in plans[0] and "SortMergeJoin" not in plans[0]
    found = sorted((r["doc_id"], r["y"]) for r in chain.documents().where("doc_id < 4").collect() if r["doc_id"] != 2)
    assert found == [(0, 1), (0, 1), (1, 0), (3, None)] and chain.documents().count() == 24


def test_documents_without_id_count_for_words_only(spark):
    rows = corpus() + [(None, "w1", 3), (None, "only", 2)]
    chain = gibbs.Chain(spark, gibbs.Model(k=3)).start(table(spark, rows))
    assert chain.word_sums().where("word = 'only'").count() == 1
    weighted = {(r["doc_id"], r["word"]): r["p"] for r in chain.weights().collect()}
    state = spark.createDataFrame(
        [(d, w, n, np.bincount([int(md5("|".join(str(x) for x in (d, w, r, 7) if x is not None).encode()).hexdigest()[:8], 16) % 3
                                for r in range(1, n + 1)], minlength=3).tolist()) for d, w, n in rows], "doc_id bigint, word string, n bigint, c array<int>")
    want = {(r["doc_id"], r["word"]): r["p"] for r in gibbs.weigh(state, chain.model).collect()}
    assert weighted.keys() == want.keys() and all(np.allclose(weighted[x], want[x], atol=1e-12) for x in want)
    assert chain.run(1).word_sums().where("word = 'only'").count() == 0


@pytest.mark.parametrize("kind", ["label", "ratio"])
def test_weights_of_a_chain_equal_the_column_expressions(spark, monkeypatch, kind):
    monkeypatch.setattr(packed, "CELLS", 64)
    eta, labels = [[1.5, -1.0, 0.3], [-0.7, 0.9, 0.1], [0.2, 0.4, -2.0]], spark.createDataFrame([(d, d % 3) for d in range(15)], "doc_id bigint, y int")
    model = gibbs.Model(k=3, head=gibbs.Head(kind, tuple(map(tuple, eta))))
    chain = gibbs.Chain(spark, model).start(table(spark, corpus()), labels)
    boost = gibbs.label_boost(eta, 3) if kind == "label" else gibbs.ratio_boost(eta, 3)
    want = {(r["doc_id"], r["word"]): r for r in gibbs.weigh(chain.state(), model, boost, labels).collect()}
    got = chain.weights().collect()
    assert len(got) == len(want)
    for r in got:
        same = want[r["doc_id"], r["word"]]
        assert np.allclose(r["p"], same["p"], rtol=1e-10) and (r["n"], r["doc_n"]) == (same["n"], same["doc_n"])


def test_likelihood_of_a_chain_needs_no_stored_probabilities(spark, monkeypatch):
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    monkeypatch.setattr(packed, "CELLS", 64)
    chain = gibbs.Chain(spark, gibbs.Model(k=4)).start(table(spark, corpus()))
    labels = spark.createDataFrame([(d, d % 3) for d in range(15)] + [(3, 0), (4, 2), (5, None)], "doc_id bigint, y int")
    blocks = gibbs.block_probabilities(gibbs.weigh(chain.state(), chain.model), 4)
    eta = np.random.default_rng(8).normal(size=(4, 3)).tolist()
    known = labels.where("y is not null")
    assert np.allclose(heads.slda_loglik(chain, labels, eta, 4).first(), heads.slda_loglik(blocks, known, eta, 4).first())
    got, want = (heads.as_matrix(heads.slda_gradient(source, known, eta, 4), 4, 3) for source in (chain, blocks))
    assert np.allclose(got, want)
    assert "double" not in chain.bound(labels)[0].schema.simpleString()
    (eta1, history1), (eta2, history2) = (heads.fit_slda(source, known, 4, 3, steps=3) for source in (chain, blocks))
    assert np.allclose(eta1, eta2) and np.allclose(history1, history2)


def test_words_travel_by_shard_not_one_by_one(spark, monkeypatch):
    """A sweep moves a row for each bucket and shard of words, and arrays of documents as bytes; sums by word stay exact."""
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    monkeypatch.setattr(gibbs, "SHARD_PAIRS", 40)
    rows = corpus() + [(900, "w1", 300), (901, "ключ", 2)]
    chain = gibbs.Chain(spark, gibbs.Model(k=3)).start(table(spark, rows)).run(1)
    assert chain.buckets > 2 and chain.shards > 2
    assert chain._word_rows().count() <= chain.buckets * chain.shards < chain.word_sums().count()
    assert {f.dataType.simpleString() for f in chain.documents().select("number", "n", "z").schema.fields} == {"binary"}
    want = {}
    for r in chain.state().collect():
        want[r["word"]] = want.get(r["word"], np.zeros(3, int)) + np.array(r["c"])
    sums = chain.word_sums().collect()
    assert all(r["counts"] == want[r["word"]].tolist() for r in sums)
    assert sorted(r["word"] for r in sums if r["first"]) == sorted(want) == sorted(r["word"] for r in chain.word_sums(only_first=True).collect())
    totals, terms = chain.totals()[0]
    assert terms == len(want) and totals.tolist() == sum(want.values()).tolist()


def test_numbers_of_a_bucket_are_as_wide_as_needed():
    for values, width in (([0, 3, 255], 1), ([0, 256, 7], 2), ([70_000, 1, 2], 4), ([], 1)):
        lengths = np.array([1, 0, len(values) - 1]) if values else np.array([0, 0])
        column = packed.as_bytes(np.array(values, np.int64), lengths)
        assert [len(x) for x in column.to_pylist()] == (lengths * width).tolist()
        assert packed.of_bytes(pa.chunked_array([column[:1], column[1:]]), len(values)).tolist() == values
    words, at = pa.array(["a", "b"]), np.arange(2)
    for counts, kind in ((np.array([[1, 2], [3, 4]]), pa.int32()), (np.array([[1, 2**31], [3, 4]]), pa.int64())):
        table = packed.words_table(words, at, counts)
        assert table["counts"].type.value_type == kind and packed.joined_words([table, table])[2].tolist() == [*counts.tolist()] * 2


def test_a_started_chain_keeps_no_counts_beside_its_state(spark, tmp_path):
    chain = gibbs.Chain(spark, gibbs.Model(k=3), str(tmp_path / "chain")).start(table(spark, corpus()))
    assert sorted(x.name for x in (tmp_path / "chain").iterdir()) == ["state-0"]
    chain.start(table(spark, corpus()).repartition(2), written=True).run(1)
    assert chain.gamma().count() == 23
