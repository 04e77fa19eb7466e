import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicweave.functions import vectors
from topicweave.operators import diagnostics, evaluate, heads, ranking, topic_counts
from topicweave.plans import gibbs, variational


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("grain", ["block", "token"])
def test_chain_keeps_mass_and_normalises(spark, toy, grain):
    model = gibbs.Model(k=2, grain=grain)
    chain = gibbs.Chain(spark, model).start(toy).run(3, keep_from=2)
    mass = topic_counts.mass_by_document(chain.state(), toy, 2)
    assert mass.count() == 3 and mass.where("not conserved").count() == 0
    assert {r["tokens"] for r in topic_counts.mass_by_table(chain.state(), 2).collect()} == {10}
    for r in chain.gamma().collect():
        assert abs(sum(r["g"]) - 1) < 1e-12
    beta = np.array([r["b"] for r in chain.beta().collect()])
    assert np.allclose(beta.sum(axis=0), 1)
    assert {r["iter"] for r in chain.samples("gamma").select("iter").distinct().collect()} == {2, 3}


def test_chain_does_not_depend_on_partitions_and_resumes(spark, toy):
    model = gibbs.Model(k=3)
    first = gibbs.Chain(spark, model).start(toy).run(3)
    other = gibbs.Chain(spark, model).start(toy.repartition(7)).run(1)
    again = gibbs.Chain(spark, model, path=other.path).resume(1).run(2)
    pick = lambda c: rows(c.state().select("doc_id", "word", F.col("c").cast("string")))
    assert pick(first) == pick(again)


def test_zero_head_leaves_the_sweep_unchanged(spark, toy, toy_labels):
    def after(head):
        chain = gibbs.Chain(spark, gibbs.Model(k=2, head=head)).start(toy, toy_labels).run(1)
        return rows(chain.state().select("doc_id", "word", F.col("c").cast("string")))

    for kind in ("ratio", "label"):
        assert after(gibbs.Head(kind, ((0.5, 0.5), (0.5, 0.5)))) == after(None)


def test_variational_mass(spark, toy):
    state = variational.fit(toy, variational.Settings(k=2), passes=2)
    assert abs(state.agg(F.sum(F.col("c")[0] + F.col("c")[1])).first()[0] - 10) < 1e-9


def test_matching_is_exact(spark):
    random.seed(3)
    k = 4
    cost = [[random.random() for _ in range(k)] for _ in range(k)]
    best = min(itertools.permutations(range(k)), key=lambda p: sum(cost[i][p[i]] for i in range(k)))
    df = spark.createDataFrame([(i, j, cost[i][j]) for i in range(k) for j in range(k)], "y int, topic int, cost double")
    assert [r["topic"] for r in evaluate.match_topics(df, k).orderBy("y").collect()] == list(best)


def test_matching_with_an_empty_class_and_greedily(spark):
    rows = [(0, [0.1, 0.8, 0.1]), (2, [0.2, 0.1, 0.7]), (2, [0.1, 0.1, 0.8])]
    features = spark.createDataFrame(rows, "y int, g array<double>")
    for method in ("exact", "greedy"):
        found = evaluate.match_topics(evaluate.assignment_cost(features, 3), 3, method).orderBy("y").collect()
        assert [r["topic"] for r in found] == [1, 0, 2]
    k = 31
    many = spark.createDataFrame([(i, j, float((i + j) % k)) for i in range(k) for j in range(k)], "y int, topic int, cost double")
    assert [r["topic"] for r in evaluate.match_topics(many, k, "greedy").orderBy("y").collect()] == [(k - i) % k for i in range(k)]


def test_partial_labels_lose_no_token(spark, toy):
    some = spark.createDataFrame([(0, 0), (1, 1)], "doc_id bigint, y int")
    seeded = topic_counts.label_seeded_tokens(toy, some, 2, 3)
    assert seeded.count() == toy.agg(F.sum("n")).first()[0]
    head = gibbs.Head("label", ((0.5, -0.5), (-0.5, 0.5)))
    chain = gibbs.Chain(spark, gibbs.Model(k=2, head=head)).start(toy, some).run(3)
    assert topic_counts.mass_by_document(chain.state(), toy, 2).where("not conserved").count() == 0


def test_resume_checks_what_it_finds(spark, toy):
    chain = gibbs.Chain(spark, gibbs.Model(k=2)).start(toy).run(3)
    again = gibbs.Chain(spark, gibbs.Model(k=2), path=chain.path).resume(3)
    assert sorted(map(str, again.state().collect())) == sorted(map(str, chain.state().collect()))
    for model, sweep in ((gibbs.Model(k=2, seed=8), 3), (gibbs.Model(k=2), 1)):
        with pytest.raises(ValueError):
            gibbs.Chain(spark, model, path=chain.path).resume(sweep)


def test_many_topics(spark, toy):
    chain = gibbs.Chain(spark, gibbs.Model(k=31)).start(toy).run(1)
    assert topic_counts.mass_by_document(chain.state(), toy, 31).where("not conserved").count() == 0


def test_traces_keep_all_coefficients(spark, tmp_path):
    from topicweave.sources import samples

    rows = [(r, s, [float(r * 100 + s * 10 + i) for i in range(16)], float(s)) for r in (1, 2) for s in range(3)]
    trace = spark.createDataFrame(rows, "run int, step int, eta array<double>, loss double")
    samples.write_trace(trace, f"{tmp_path}/t", 4)
    got = samples.read_trace(spark, f"{tmp_path}/t")
    assert sorted(map(tuple, got.select("run", "step", "eta", "loss").collect())) == sorted(rows)
    (tmp_path / "own").mkdir()
    text = "eta[0]   eta[1]   l2_loss\n1 2 3\n"
    (tmp_path / "own" / "seed80init_val0fold1.txt").write_text(text + text + "4 5 6\n")
    got = samples.read_trace(spark, f"{tmp_path}/own", r"seed(\d+)init_val(\d+)fold(\d+)").orderBy("step", "loss").collect()
    assert [(r["run"], r["step"], r["eta"], r["loss"]) for r in got] == [
        ("80-0-1", 0, [1.0, 2.0], 3.0), ("80-0-1", 0, [1.0, 2.0], 3.0), ("80-0-1", 1, [4.0, 5.0], 6.0)]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "run=1.txt").write_text("eta[0] l2_loss\n1 broken\n")
    with pytest.raises(Exception, match="not a trace line"):
        samples.read_trace(spark, f"{tmp_path}/bad").collect()


def test_digamma_is_the_slope_of_log_gamma(spark):
    for x in (0.1, 0.5, 1.0, 7.3, 400.0):
        got = spark.range(1).select(vectors.digamma(F.lit(x))).first()[0]
        assert abs(got - (math.lgamma(x + 1e-5) - math.lgamma(x - 1e-5)) / 2e-5) < 1e-5


def test_quantiles_match_numpy(spark):
    random.seed(5)
    values = [random.random() ** 3 for _ in range(501)] + [0.25] * 300
    df = spark.createDataFrame([("a", v) for v in values] + [("b", v / 2) for v in values[:7]], "g string, x double")
    got = {(r["g"], r["prob"]): r["quantile"] for r in diagnostics.quantiles(df, "x", [0.0, 0.03, 0.5, 0.97, 1.0], ["g"], bins=16).collect()}
    for (g, p), value in got.items():
        base = values if g == "a" else [v / 2 for v in values[:7]]
        assert abs(value - np.quantile(base, p)) < 1e-12
    assert len(got) == 10


def test_autocorrelation_matches_definition(spark):
    x = [1.0, 3.0, 2.0, 5.0, 4.0, 4.5]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "s int, iter int, value double")
    got = {r["lag"]: r["acf"] for r in diagnostics.autocorrelation(df, 2, "s").collect()}
    c = np.array(x) - np.mean(x)
    for h in range(3):
        assert abs(got[h] - (c[h:] * c[: len(c) - h]).sum() / (c * c).sum()) < 1e-12


def test_ties(spark):
    long = spark.createDataFrame([(0, "a", 3.0), (0, "b", 2.0), (0, "c", 2.0), (0, "d", 1.0)], "topic int, word string, beta double")
    assert [r["word"] for r in ranking.top_with_ties(long, 2, "topic", "beta").orderBy("word").collect()] == ["a", "b", "c"]
    assert [r["word"] for r in ranking.top_strict(long, 2, "topic", "beta").orderBy("place").collect()] == ["a", "b"]
    g = spark.createDataFrame([(1, [0.4, 0.4, 0.2])], "doc_id bigint, g array<double>")
    assert ranking.best_topic(g).first()["topic"] == 0
    assert ranking.best_topics_with_ties(g).count() == 2


@pytest.fixture(scope="module")
def small(spark, toy, toy_labels):
    model = gibbs.Model(k=2)
    state = gibbs.Chain(spark, model).start(toy).state()
    blocks = gibbs.block_probabilities(gibbs.weigh(state, model), 2).cache()
    return blocks, toy_labels, heads.mean_probabilities(blocks, 2).join(toy_labels, "doc_id").cache()


def test_likelihood_gradient_by_differences(small):
    blocks, labels, _ = small
    eta = [[0.3, -0.4], [0.1, 0.8]]
    grad = heads.as_matrix(heads.slda_gradient(blocks, labels, eta, 2), 2)
    for i in range(2):
        for j in range(2):
            up, down = [r[:] for r in eta], [r[:] for r in eta]
            up[i][j] += 1e-5
            down[i][j] -= 1e-5
            diff = (heads.slda_loglik(blocks, labels, up, 2).first()[0] - heads.slda_loglik(blocks, labels, down, 2).first()[0]) / 2e-5
            assert math.isclose(grad[i][j], diff, rel_tol=1e-5, abs_tol=1e-7)


def test_l2_and_softmax_gradients_by_differences(small):
    _, _, features = small
    eta = [[0.3, -0.4], [0.1, 0.8]]
    stats = heads.class_statistics(features, 2, "y")
    exact = heads.as_matrix(heads.l2_gradient(stats, eta, 2), 2)
    soft = heads.as_matrix(heads.softmax_gradient(features, eta, 2), 2)
    for i in range(2):
        for j in range(2):
            up, down = [r[:] for r in eta], [r[:] for r in eta]
            up[i][j] += 1e-5
            down[i][j] -= 1e-5
            for grad, loss in ((exact, heads.l2_loss), (soft, heads.softmax_loss)):
                diff = (loss(features, up, 2).first()[0] - loss(features, down, 2).first()[0]) / 2e-5
                assert math.isclose(grad[i][j], diff, rel_tol=1e-5, abs_tol=1e-7)


def test_restarts_meet_at_the_least_squares_solution(spark):
    random.seed(1)
    data = []
    for d in range(200):
        y = d % 2
        a = 0.7 + 0.2 * random.random() if y == 0 else 0.3 * random.random()
        data.append((d, [a, 1 - a], y))
    features = spark.createDataFrame(data, "doc_id bigint, g array<double>, y int")
    scores = heads.cross_validate(features, 2, restarts=3, folds=5, steps=200).collect()
    assert all(r["cv_score"] > 0.95 and r["test_accuracy"] > 0.95 for r in scores)
    etas = np.array([r["eta"] for r in scores])
    assert np.allclose(etas, etas[0], atol=1e-3)
    loss = heads.solve_l2(heads.class_statistics(features.withColumn("fold", F.lit(0)), 2, "fold", "y"), 2, "fold").first()
    eta = np.array(loss["eta"]).reshape(2, 2).tolist()
    assert math.isclose(loss["loss"], heads.l2_loss(features, eta, 2).first()[0], rel_tol=1e-9)


def test_vector_helpers(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],)], "v array<double>")
    got = df.select(
        vectors.permute(F.col("v"), [2, 0, 1]).alias("p"), vectors.first_argmax(F.col("v")).alias("m"),
        vectors.one_hot(F.lit(1), 3).alias("h"), vectors.log_sum_exp(vectors.items(F.col("v"), 3)).alias("l"),
    ).first()
    assert got["p"] == [4.0, 1.0, 2.0] and got["m"] == 2 and got["h"] == [0.0, 1.0, 0.0]
    assert abs(got["l"] - math.log(math.e + math.e**2 + math.e**4)) < 1e-12


def test_packed_variational_steps_equal_the_column_expressions(spark, monkeypatch):
    monkeypatch.setattr(gibbs, "BUCKET_PAIRS", 40)
    monkeypatch.setattr(gibbs, "SHARD_PAIRS", 40)
    draw = np.random.default_rng(4)
    pairs = {(int(d), f"w{int(w)}") for d, w in zip(draw.integers(0, 25, 170), draw.integers(0, 30, 170))}
    rows_ = [(d, w, 1 + (7 * d + len(w)) % 3) for d, w in sorted(pairs)] + [(None, "w1", 2), (None, "only", 1), (77, "ключ", 400)]
    counts, settings = spark.createDataFrame(rows_, "doc_id bigint, word string, n bigint").repartition(3), variational.Settings(k=3)
    slow = variational.start(counts, settings)
    for passes in range(4):
        got = {(r["doc_id"], r["word"], r["n"]): r["c"] for r in variational.fit(counts, settings, passes).collect()}
        want = {(r["doc_id"], r["word"], r["n"]): r["c"] for r in slow.collect()}
        assert got.keys() == want.keys() and len(got) == len(rows_) - (2 if passes else 0)
        assert all(np.allclose(got[x], want[x], rtol=1e-9, atol=1e-12) for x in want)
        slow = variational.update(slow, settings)
