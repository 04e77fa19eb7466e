"""Matrix sums, batches, running moments and the online fit against plain array code."""

from hashlib import md5

import numpy as np
from pyspark.sql import functions as F

from topicweave.operators import diagnostics, heads, matrix_sums, moments
from topicweave.plans import variational


def features(spark, rows=200, k=5, classes=5, seed=2):
    draw = np.random.default_rng(seed)
    g = draw.dirichlet(np.ones(k), rows)
    y = draw.integers(0, classes, rows)
    data = [(i, int(y[i]), g[i].tolist()) for i in range(rows)]
    return g, y, spark.createDataFrame(data, "doc_id bigint, y int, g array<double>").repartition(3)


def blocks(spark, documents=30, k=20, classes=20):
    draw = np.random.default_rng(4)
    rows, labels = [], [(d, int(draw.integers(0, classes))) for d in range(documents - 3)]
    for d in range(documents):
        for w in range(int(draw.integers(1, 9))):
            rows.append((d, f"w{w}", int(draw.integers(1, 4)), draw.dirichlet(np.ones(k)).tolist()))
    df = spark.createDataFrame(rows, "doc_id bigint, word string, n bigint, p array<double>")
    return rows, dict(labels), df, spark.createDataFrame(labels, "doc_id bigint, y int")


def plain_likelihood(rows, labels, eta):
    total, gradient = 0.0, np.zeros_like(eta)
    for d, y in labels.items():
        n, p = np.array([r[2] for r in rows if r[0] == d], float), np.array([r[3] for r in rows if r[0] == d])
        length = n.sum()
        raised = np.exp(eta / length)
        logs = (n[:, None] * np.log(p @ raised)).sum(axis=0)
        g, chance = n @ p / length, np.exp(logs - np.logaddexp.reduce(logs))
        total += g @ eta[:, y] - np.logaddexp.reduce(logs)
        gradient[:, y] += g
        slopes = sum(n[m] * p[m][:, None] * raised / length / (p[m] @ raised) for m in range(len(n)))
        gradient -= chance * slopes
    return total, gradient


def test_likelihood_of_many_topics_and_classes(spark):
    rows, labels, df, own = blocks(spark)
    eta = np.random.default_rng(5).normal(size=(20, 20))
    value, gradient = plain_likelihood(rows, labels, eta)
    found = heads.slda_loglik(df, own, eta.tolist(), 20).first()
    assert abs(found["loglik"] - value) < 1e-9 and found["docs"] == len(labels)
    got = np.array(heads.as_matrix(heads.slda_gradient(df, own, eta.tolist(), 20), 20))
    assert np.allclose(got, gradient, atol=1e-10)
    plan = heads.slda_gradient(df, own, eta.tolist(), 20)._jdf.queryExecution().toString()
    assert len(plan) < 60_000


def test_ascent_equals_single_steps_and_halves_its_length(spark):
    rows, labels, df, own = blocks(spark, documents=12, k=4, classes=3)
    packed = matrix_sums.packed_blocks(df, own).cache()
    for rate in (1.0, 4000.0):
        eta, history = matrix_sums.ascend(packed, 4, 3, steps=4, rate=rate, tries=2)
        want, length = np.zeros((4, 3)), rate
        values = [plain_likelihood(rows, labels, want)[0]]
        for _ in range(4):
            slope = plain_likelihood(rows, labels, want)[1] / len(labels)
            while plain_likelihood(rows, labels, want + length * slope)[0] < values[-1]:
                length /= 2
            want = want + length * slope
            values.append(plain_likelihood(rows, labels, want)[0])
        assert np.allclose(history, values) and np.allclose(eta, want) and (rate == 1.0 or length < rate)


def test_class_statistics(spark):
    g, y, df = features(spark)
    for r in heads.class_statistics(df.withColumn("fold", F.col("doc_id") % 2), 5, "fold", "y").collect():
        mine = g[(y == r["y"]) & (np.arange(len(g)) % 2 == r["fold"])]
        assert r["n"] == len(mine) and np.allclose(r["s"], mine.sum(axis=0)) and np.allclose(np.reshape(r["gram"], (5, 5)), mine.T @ mine)
    assert heads.class_statistics(df.where("y < 0"), 5, "y").count() == 0


def test_models_are_scored_run_by_run(spark):
    g, y, df = features(spark, rows=700, k=3, classes=3)
    etas = np.random.default_rng(6).normal(size=(4, 2, 3, 3))
    models = spark.createDataFrame([(r, f, etas[r, f].ravel().tolist()) for r in range(4) for f in range(2)], "run int, fold int, eta array<double>")
    got = heads.score_models(df.withColumn("fold", (F.col("doc_id") % 2).cast("int")), models, 3, 4).collect()
    assert len(got) == 8
    for r in got:
        mine = np.arange(700) % 2 == r["fold"]
        assert (r["hits"], r["docs"]) == (int(((g @ etas[r["run"], r["fold"]]).argmax(axis=1) == y)[mine].sum()), 350)


def test_batches_are_the_smallest_hashes_of_each_step(spark):
    _, _, df = features(spark, rows=60)
    got = heads.minibatches(df, 7, 4, "s")
    for step in range(4):
        ids = sorted(range(60), key=lambda i: (int(md5(f"{i}|s.{step}".encode()).hexdigest()[:8], 16), i))[:7]
        assert sorted(r["doc_id"] for r in got.where(F.col("step") == step).collect()) == sorted(ids)
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert heads.minibatches(df.limit(3), 7, 2, "s").count() == 6


def test_running_moments_equal_those_of_the_stored_samples(spark):
    draw = np.random.default_rng(7)
    x = 1e-3 + 1e-9 * draw.normal(size=(6, 12, 3)).cumsum(axis=1)
    x[5] = 0.25  # no variance
    samples = spark.createDataFrame([(f"w{w}", t, x[w, t].tolist()) for w in range(6) for t in range(12)], "word string, iter int, b array<double>")
    long = samples.select("word", "iter", F.posexplode("b").alias("topic", "value"))
    means = {(r["word"], r["topic"]): r["mean"] for r in diagnostics.posterior_mean(long, "word", "topic").collect()}
    for cuts, lags in (((0, 5, 7, 12), 4), ((0, 1, 2, 12), 11), ((0, 12), 0)):
        held = moments.Moments(spark, "word", "b", lags)
        for low, high in zip(cuts, cuts[1:]):
            held.add(samples.where(F.col("iter").between(low, high - 1)))
        found = held.mean().collect()
        assert len(found) == 18 and all(abs(r["mean"] - means[r["word"], r["topic"]]) < 1e-15 and r["sweeps"] == 12 for r in found)
        got = {(r["word"], r["topic"], r["lag"]): r["acf"] for r in held.autocorrelation().collect()}
        for w in range(5):
            for i in range(3):
                s = x[w, :, i] - x[w, :, i].mean()
                want = [(s[h:] * s[:12 - h]).sum() / (s * s).sum() for h in range(lags + 1)]
                assert np.allclose([got[f"w{w}", i, h] for h in range(lags + 1)], want, atol=1e-5)
        assert len(got) == 15 * (lags + 1)


def test_online_topics_keep_their_mass_and_decay(spark, toy):
    settings, how = variational.Settings(k=2), variational.Online(batches=2)
    topics = variational.fit_online(toy, settings, how, updates=1)
    start = {r["word"]: r["l"] for r in variational.topic_table(toy, settings).collect()}
    assert topics.count() == len(start) and all(min(r["l"]) > 0 for r in topics.collect())
    whole = variational.fit_online(toy, settings, variational.Online(batches=1, delay=1.0, decay=0.5), updates=1).collect()
    # the first update of a single batch has weight 1, so nothing of the start is left
    assert abs(sum(sum(r["l"]) for r in whole) - (10 + 5 * 2 * 0.5)) < 1e-9
    assert variational.fit_online(toy, settings, how, passes=2).count() == 5


def test_online_batches_look_up_a_word_once_for_each_bucket(spark):
    """Documents lie packed, so rows of a mini-batch are words, not pairs."""
    rows = [(d, f"w{w}", 1 + (d + w) % 3) for d in range(40) for w in range(6)]
    counts = spark.createDataFrame(rows, "doc_id bigint, word string, n bigint")
    made, update = [], variational.online_update

    def seen(topics, batch, *rest):
        made.append((batch.where("word is not null").count(), batch.where("word is null").count()))
        return update(topics, batch, *rest)

    try:
        variational.online_update = seen
        got = variational.fit_online(counts, variational.Settings(k=2), variational.Online(batches=1), updates=1)
    finally:
        variational.online_update = update
    assert made == [(6, 1)]
    l, w = {f"w{w}": np.array([(int(md5(f"w{w}|{i}|7".encode()).hexdigest()[:8], 16) + 0.5) / 2**32 + 0.5 for i in (0, 1)]) for w in range(6)}, {}
    total = sum(l.values())
    for word, row in l.items():
        w[word] = np.exp(variational.digamma(row) - variational.digamma(total))
    sums = {word: np.zeros(2) for word in l}
    for d in range(40):
        own = [(word, n) for e, word, n in rows if e == d]
        share = np.full(2, 0.5 + sum(n for _, n in own) / 2)
        for _ in range(3):
            p = {word: n * (x := np.exp(variational.digamma(share) - variational.digamma(share.sum())) * w[word]) / x.sum() for word, n in own}
            share = 0.5 + sum(p.values())
        for word in p:
            sums[word] += p[word]
    assert all(np.allclose(r["l"], 0.5 + sums[r["word"]]) for r in got.collect())


def test_ascent_looks_at_one_length_while_it_holds(spark, monkeypatch):
    _, _, df, own = blocks(spark, documents=12, k=4, classes=3)
    packed, seen, plain = matrix_sums.packed_blocks(df, own).cache(), [], matrix_sums.likelihood
    monkeypatch.setattr(matrix_sums, "likelihood", lambda rows, etas, **how: (seen.append(len(etas)), plain(rows, etas, **how))[1])
    matrix_sums.ascend(packed, 4, 3, steps=3, rate=1.0)
    assert seen == [1, 1, 1, 1]
    seen.clear()
    matrix_sums.ascend(packed, 4, 3, steps=2, rate=4000.0, tries=4)
    assert seen[:3] == [1, 1, 3] and len(seen) <= 8
