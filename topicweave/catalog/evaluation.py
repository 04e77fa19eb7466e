"""Checkable queries: topics against labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicweave.catalog.base import ARTICLES, CORPUS, hash32, in_list, long_sql, query, quoted, sweep_sql, uniform
from topicweave.catalog.modelling import ETA, GAMMA, K, LABELS, chain_sql, class_labels, gamma_after_sweep, gamma_sql
from topicweave.functions import vectors
from topicweave.operators import diagnostics, evaluate, ranking
from topicweave.plans import study
from topicweave.session import materialize
from topicweave.sources.tables import articles


def features(spark, folder):
    """``(doc_id, g, category, y)`` after one sweep."""
    return materialize(gamma_after_sweep(spark, folder).join(class_labels(spark, folder), "doc_id"), "features")


FEATURES = f"{GAMMA}, {LABELS}, f AS (SELECT g.*, category, y FROM g JOIN lab USING (doc_id))"
TOP = "greatest(" + ", ".join(f"g{i}" for i in range(K)) + ")"
BEST = "CASE " + " ".join(f"WHEN g{i} = {TOP} THEN {i}" for i in range(K)) + " END"
LONG_G = "lg AS (" + long_sql(K, "f", "doc_id", lambda i: f"g{i}", "value", ", category, y") + ")"


@query("w2_best_topic", f"WITH {GAMMA} SELECT doc_id, {BEST} AS topic FROM g")
def _(spark, folder):
    return ranking.best_topic(gamma_after_sweep(spark, folder)).select("doc_id", "topic")


@query("w2b_best_topics_with_ties", f"""WITH {FEATURES}, {LONG_G},
r AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY value DESC) AS rk FROM lg)
SELECT doc_id, topic, round(value, 9) AS value FROM r WHERE rk = 1""")
def _(spark, folder):
    rows = ranking.best_topics_with_ties(gamma_after_sweep(spark, folder))
    return rows.withColumn("value", F.round("value", 9))


@query("o5_top_topics", f"""WITH {FEATURES}, {LONG_G},
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, topic) AS place FROM lg)
SELECT doc_id, place::INT AS place, topic, round(value, 9) AS value FROM r WHERE place <= 3""")
def _(spark, folder):
    return ranking.top_topics(gamma_after_sweep(spark, folder), 3).withColumn("value", F.round("value", 9))


@query("o3_category_order", f"""WITH {FEATURES}, {LONG_G}
SELECT category, round(avg(value * (topic + 1)), 9) AS score FROM lg GROUP BY category ORDER BY score""")
def _(spark, folder):
    f = features(spark, folder)
    return ranking.category_order(f, f).withColumn("score", F.round("score", 9))


@query("p13_share_above", f"""WITH {FEATURES}
SELECT category, round(avg((g1 > 0.3)::INT), 9) AS share, count(*)::BIGINT AS docs FROM f GROUP BY category""")
def _(spark, folder):
    rows = evaluate.share_above(features(spark, folder), 1, 0.3)
    return rows.withColumn("share", F.round("share", 9))


@query("j4_join_metadata", f"""WITH {GAMMA}, {ARTICLES}
SELECT doc_id, {BEST} AS topic, headline, category FROM g LEFT JOIN articles USING (doc_id)""")
def _(spark, folder):
    best = ranking.best_topic(gamma_after_sweep(spark, folder)).select("doc_id", "topic")
    return best.join(articles(spark, folder).select("doc_id", "headline", "category"), "doc_id", "left")


@query("a7_topic_by_category", f"WITH {FEATURES} SELECT {BEST} AS topic, category, count(*)::BIGINT AS docs FROM f GROUP BY 1, 2")
def _(spark, folder):
    f = features(spark, folder)
    return evaluate.topic_by_category(ranking.best_topic(f), f)


@query("a31_topic_histogram", f"WITH {FEATURES} SELECT {BEST} AS topic, count(*)::BIGINT AS docs FROM f GROUP BY 1")
def _(spark, folder):
    return ranking.best_topic(features(spark, folder)).groupBy("topic").agg(F.count("*").alias("docs"))


@query("a30_box_statistics", f"WITH {FEATURES}, {LONG_G} " + " UNION ALL ".join(
    f"SELECT category, topic, {p}::DOUBLE AS prob, round(quantile_cont(value, {p}), 9) AS quantile FROM lg GROUP BY category, topic"
    for p in (0.0, 0.25, 0.5, 0.75, 1.0)))
def _(spark, folder):
    f = features(spark, folder)
    long = f.select("category", F.posexplode_outer("g").alias("topic", "value"))
    rows = diagnostics.quantiles(long, "value", [0.0, 0.25, 0.5, 0.75, 1.0], ["category", "topic"])
    return rows.withColumn("quantile", F.round("quantile", 9))


@query("a19_class_sizes", f"WITH {LABELS} SELECT y, count(*)::BIGINT AS docs, min(category) AS category FROM lab GROUP BY y")
def _(spark, folder):
    return evaluate.class_sizes(class_labels(spark, folder))


COST = "cost AS (SELECT y, topic, count(*) - sum(value) AS cost FROM lg GROUP BY y, topic)"


def permutations_sql(k: int, cost: str = "cost", name: str = "m") -> str:
    """CTE ``m(y, topic, total_cost)``: the cheapest one-to-one assignment by trying all of them."""
    tables = ", ".join(f"{cost} a{i}" for i in range(k))
    rows = " AND ".join(f"a{i}.y = {i}" for i in range(k))
    apart = " AND ".join(f"a{i}.topic <> a{j}.topic" for i in range(k) for j in range(i + 1, k))
    total = " + ".join(f"a{i}.cost" for i in range(k))
    order = ", ".join(f"a{i}.topic" for i in range(k))
    picks = " UNION ALL ".join(f"SELECT {i} AS y, t{i} AS topic, total_cost FROM best_{name}" for i in range(k))
    names = ", ".join(f"a{i}.topic AS t{i}" for i in range(k))
    return f"""best_{name} AS (SELECT {names}, {total} AS total_cost FROM {tables} WHERE {rows} AND {apart}
  ORDER BY total_cost, {order} LIMIT 1),
{name} AS ({picks})"""


MATCHED = f"{FEATURES}, {LONG_G}, {COST}, {permutations_sql(K)}"


@query("a14_assignment_cost", f"WITH {FEATURES}, {LONG_G}, {COST} SELECT y, topic, round(cost, 6) AS cost FROM cost")
def _(spark, folder):
    return evaluate.assignment_cost(features(spark, folder), K).withColumn("cost", F.round("cost", 6))


@query("a15_squared_cost", f"""WITH {FEATURES}, {LONG_G}
SELECT y, topic, round(sum(pow((y = topic)::INT - value, 2)), 6) AS cost FROM lg GROUP BY y, topic""")
def _(spark, folder):
    return evaluate.squared_cost(features(spark, folder), K).withColumn("cost", F.round("cost", 6))


@query("a15_plain_squared_cost", f"""WITH {FEATURES}, {LONG_G}
SELECT y, topic, round(sum(pow(1 - value, 2)), 6) AS cost FROM lg GROUP BY y, topic""")
def _(spark, folder):
    return evaluate.squared_cost(features(spark, folder), K, "plain").withColumn("cost", F.round("cost", 6))


@query("m16_topic_mapping", f"WITH {MATCHED} SELECT y, topic, round(total_cost, 6) AS total_cost FROM m")
def _(spark, folder):
    rows = evaluate.match_topics(evaluate.assignment_cost(features(spark, folder), K), K)
    return rows.withColumn("total_cost", F.round("total_cost", 6))


def mapped(spark, folder):
    f = features(spark, folder)
    mapping = evaluate.match_topics(evaluate.assignment_cost(f, K), K)
    return evaluate.mapped_prediction(ranking.best_topic(f), mapping)


PRED = f"{MATCHED}, b AS (SELECT doc_id, y, {BEST} AS topic FROM f), p AS (SELECT b.doc_id, b.y, m.y AS pred FROM b JOIN m USING (topic))"


@query("m17_mapped_prediction", f"WITH {PRED} SELECT doc_id, y, pred FROM p")
def _(spark, folder):
    return mapped(spark, folder).select("doc_id", "y", "pred")


@query("j9_label_alignment", f"""WITH {PRED}
SELECT y, count(*)::BIGINT AS docs, sum((y = pred)::INT)::BIGINT AS hits FROM p GROUP BY y""")
def _(spark, folder):
    return mapped(spark, folder).groupBy("y").agg(
        F.count("*").alias("docs"), F.count_if(F.col("y") == F.col("pred")).alias("hits")
    )


@query("a16_accuracy_by_class", f"""WITH {PRED}
SELECT y, round(avg((y = pred)::INT), 9) AS accuracy, count(*)::BIGINT AS docs FROM p GROUP BY y""")
def _(spark, folder):
    return evaluate.accuracy_by_class(mapped(spark, folder)).withColumn("accuracy", F.round("accuracy", 9))


@query("a17_accuracy", f"WITH {PRED} SELECT round(avg((y = pred)::INT), 9) AS accuracy, count(*)::BIGINT AS docs FROM p")
def _(spark, folder):
    return evaluate.accuracy(mapped(spark, folder)).withColumn("accuracy", F.round("accuracy", 9))


@query("a18_confusion", f"WITH {PRED} SELECT y, pred, count(*)::BIGINT AS docs FROM p GROUP BY y, pred")
def _(spark, folder):
    return evaluate.confusion(mapped(spark, folder))


@query("t15_rearranged_features", f"WITH {MATCHED} SELECT doc_id, " + ", ".join(
    f"round(CASE (SELECT topic FROM m WHERE y = {i}) " + " ".join(f"WHEN {t} THEN g{t}" for t in range(K)) + f" END, 9) AS g{i}"
    for i in range(K)) + " FROM f")
def _(spark, folder):
    f = features(spark, folder)
    mapping = evaluate.match_topics(evaluate.assignment_cost(f, K), K)
    moved = evaluate.rearranged(f, mapping, K)
    return moved.select("doc_id", *[F.round(F.col("g")[i], 9).alias(f"g{i}") for i in range(K)])


@query("t12_vector_functions", f"""WITH {GAMMA},
e AS (SELECT doc_id, g0, g1, exp(g0) AS e0, exp(g1) AS e1, exp(g2) AS e2, exp(g3) AS e3,
      sqrt(g0 * g0 + g1 * g1 + g2 * g2 + g3 * g3) AS norm FROM g)
SELECT doc_id, round(e0 / (e0 + e1 + e2 + e3), 9) AS soft0, round(e3 / (e0 + e1 + e2 + e3), 9) AS soft3,
       round(ln(g0), 9) AS log0, round(pow(g1, 3), 9) AS cube1, round(norm, 9) AS norm FROM e""")
def _(spark, folder):
    g = [F.col("g")[i] for i in range(K)]
    soft = vectors.softmax(g)
    return gamma_after_sweep(spark, folder).select(
        "doc_id", F.round(soft[0], 9).alias("soft0"), F.round(soft[3], 9).alias("soft3"),
        F.round(F.log(g[0]), 9).alias("log0"), F.round(F.pow(g[1], F.lit(3.0)), 9).alias("cube1"),
        F.round(vectors.norm2(g), 9).alias("norm"),
    )


@query("t13_one_hot_labels", f"WITH {LABELS} SELECT doc_id, " + ", ".join(f"(y = {i})::INT::DOUBLE AS y{i}" for i in range(K)) + " FROM lab")
def _(spark, folder):
    hot = vectors.one_hot(F.col("y"), K)
    return class_labels(spark, folder).select("doc_id", *[hot[i].alias(f"y{i}") for i in range(K)])


def _score(j: int) -> str:
    return "(" + " + ".join(f"g{i} * ({ETA[i][j]}::DOUBLE)" for i in range(K)) + ")"


SCORES = ", ".join(f"{_score(j)} AS s{j}" for j in range(K))
TOP_S = "greatest(" + ", ".join(f"s{j}" for j in range(K)) + ")"
PRED_S = "CASE " + " ".join(f"WHEN s{j} = {TOP_S} THEN {j}" for j in range(K)) + " END"


@query("t14_matrix_product", f"WITH {FEATURES}, s AS (SELECT doc_id, {SCORES} FROM f) SELECT doc_id, "
       + ", ".join(f"round(s{j}, 9) AS s{j}" for j in range(K)) + f", {PRED_S} AS pred FROM s")
def _(spark, folder):
    rows = evaluate.predicted(features(spark, folder), ETA).withColumn("s", vectors.times_matrix(F.col("g"), ETA))
    return rows.select("doc_id", *[F.round(F.col("s")[j], 9).alias(f"s{j}") for j in range(K)], "pred")


@query("m18_predict_by_head", f"""WITH {FEATURES}, s AS (SELECT doc_id, y, {SCORES} FROM f)
SELECT y, {PRED_S} AS pred, count(*)::BIGINT AS docs FROM s GROUP BY 1, 2""")
def _(spark, folder):
    return evaluate.confusion(evaluate.predicted(features(spark, folder), ETA))


STUDY_SWEEPS, STUDY_FROM = 30, 21
SETS = [study.CategorySet("lang", c) for c in (("en", "fr"), ("en", "fr", "de"), ("en", "fr", "de", "es"))] + [
    study.CategorySet("source", tuple(f"src{i}" for i in range(5)))]


def study_sql(one: study.CategorySet, seed: int = 7) -> str:
    """One category set: chain, mean of the retained samples, cheapest mapping, hits by class."""
    column, categories = one.column, one.categories
    k, kept = len(categories), f"{column} IN {in_list(categories)}"
    base = f"{CORPUS},\nsub AS (SELECT corpus.* FROM corpus JOIN documents USING (doc_id) WHERE {kept})"
    samples = range(STUDY_FROM, STUDY_SWEEPS + 1)
    gammas = ",\n".join(gamma_sql(f"b{i}", f"ga{i}", k) for i in samples)
    means = ", ".join(f"avg(g{i}) AS g{i}" for i in range(k))
    top = "greatest(" + ", ".join(f"g{i}" for i in range(k)) + ")"
    best = "CASE " + " ".join(f"WHEN g{i} = {top} THEN {i}" for i in range(k)) + " END"
    return f"""SELECT * FROM (WITH {chain_sql(k, STUDY_SWEEPS, seed, base, 'sub')},
{gammas},
g AS (SELECT doc_id, {means} FROM ({' UNION ALL '.join(f'SELECT * FROM ga{i}' for i in samples)}) GROUP BY doc_id),
lab AS (SELECT doc_id, {column} AS category, (dense_rank() OVER (ORDER BY {column}) - 1)::INT AS y FROM documents WHERE {kept}),
f AS (SELECT g.*, category, y FROM g JOIN lab USING (doc_id)),
lg AS ({long_sql(k, 'f', 'doc_id', lambda i: f'g{i}', 'value', ', category, y')}),
cost AS (SELECT y, topic, count(*) - sum(value) AS cost FROM lg GROUP BY y, topic),
{permutations_sql(k)},
p AS (SELECT b.y, b.category, m.y AS pred FROM (SELECT y, category, {best} AS topic FROM f) b JOIN m USING (topic))
SELECT {seed} AS seed, {k} AS topics, y, category, count(*)::BIGINT AS docs, count(*) FILTER (y = pred)::BIGINT AS hits,
  round(count(*) FILTER (y = pred)::DOUBLE / count(*), 9) AS accuracy FROM p GROUP BY y, category)"""


@query("m20_study", " UNION ALL ".join(map(study_sql, SETS)))
def _(spark, folder):
    return study.run_study(spark, folder, SETS, STUDY_SWEEPS, STUDY_FROM)


L2_SETS, RESTARTS, FOLDS, STEPS = SETS[1:], 100, 5, 200


def l2_study_sql(one: study.CategorySet) -> str:
    """One category set: chain, mean block probabilities, cheapest mapping, cross-validated restarts, the best one on the test rows."""
    column, categories, k = one.column, one.categories, len(one.categories)
    kept, cells = f"{column} IN {in_list(categories)}", [(i, j) for i in range(k) for j in range(k)]
    base = f"{CORPUS},\nsub AS (SELECT corpus.* FROM corpus JOIN documents USING (doc_id) WHERE {kept})"
    whole = " + ".join(f"p{i}" for i in range(k))
    last, gram = f"s{STUDY_SWEEPS + 1}", [(i, j) for i in range(k) for j in range(i, k)]
    scores = [" + ".join(f"g{i} * e{i * k + j}" for i in range(k)) for j in range(k)]
    top = f"greatest({', '.join(scores)})"
    pred = "CASE " + " ".join(f"WHEN {x} = {top} THEN {j}" for j, x in enumerate(scores)) + " END"
    pulled = {(i, j): " + ".join(f"a{min(i, m)}_{max(i, m)} * e{m * k + j}" for m in range(k)) for i, j in cells}
    es = ", ".join(f"e{c}" for c in range(k * k))
    return f"""SELECT * FROM (WITH RECURSIVE {chain_sql(k, STUDY_SWEEPS, 7, base, 'sub')},
{sweep_sql(k, f'b{STUDY_SWEEPS}', last, STUDY_SWEEPS + 1)},
g AS (SELECT doc_id, {', '.join(f'sum(n * p{i} / ({whole})) / sum(n) AS g{i}' for i in range(k))} FROM p_{last} GROUP BY doc_id),
lab AS (SELECT doc_id, {column} AS category, (dense_rank() OVER (ORDER BY {column}) - 1)::INT AS y FROM documents WHERE {kept}),
f0 AS (SELECT g.*, category, y FROM g JOIN lab USING (doc_id)),
lg AS ({long_sql(k, 'f0', 'doc_id', lambda i: f'g{i}', 'value', ', category, y')}),
cost AS (SELECT y, topic, count(*) - sum(value) AS cost FROM lg GROUP BY y, topic),
{permutations_sql(k)},
o AS (SELECT {', '.join(f"max(topic) FILTER (y = {i}) AS o{i}" for i in range(k))} FROM m),
f AS (SELECT doc_id, category, y, {', '.join(f"[{', '.join(f'g{t}' for t in range(k))}][o{i} + 1] AS g{i}" for i in range(k))} FROM f0, o),
sp AS (SELECT *, ({hash32('doc_id', quoted('fold'))} % {FOLDS})::INT AS fold, {uniform('doc_id', quoted('split'))} < 0.2::DOUBLE AS is_test FROM f),
st AS (SELECT k.fold, count(*)::DOUBLE AS n, {', '.join(f'sum(g{i} * g{j}) AS a{i}_{j}' for i, j in gram)},
  {', '.join(f'coalesce(sum(g{i}) FILTER (y = {j}), 0) AS s{i}_{j}' for i, j in cells)}
  FROM (SELECT unnest(range(0, {FOLDS})) AS fold) k, sp WHERE sp.fold <> k.fold AND NOT is_test GROUP BY k.fold),
starts AS (SELECT r.run, {', '.join(f"(({uniform('r.run', quoted(str(c)), quoted('80'))}) * 2 - 1) AS e{c}" for c in range(k * k))}
  FROM (SELECT unnest(range(0, {RESTARTS})) AS run) r),
tr AS (SELECT run, fold, 0 AS step, {es} FROM starts, st
  UNION ALL SELECT run, fold, step + 1, {', '.join(f'e{i * k + j} - (({pulled[i, j]}) - s{i}_{j}) / n' for i, j in cells)}
  FROM tr JOIN st USING (fold) WHERE step < {STEPS}),
fin AS (SELECT * FROM tr WHERE step = {STEPS}),
va AS (SELECT run, fold, avg(({pred} = y)::INT) AS acc FROM sp JOIN fin USING (fold) WHERE NOT is_test GROUP BY run, fold),
cv AS (SELECT run, round(avg(acc), 8) AS cv_score FROM va GROUP BY run),
av AS (SELECT run, {', '.join(f'avg(e{c}) AS e{c}' for c in range(k * k))} FROM fin GROUP BY run),
best AS (SELECT * FROM cv JOIN av USING (run) ORDER BY cv_score DESC, run LIMIT 1),
te AS (SELECT best.run, cv_score, y, category, ({pred} = y)::INT AS hit FROM sp, best WHERE is_test)
SELECT {k} AS topics, any_value(run)::INT AS run, any_value(cv_score) AS cv_score, round(any_value(acc), 8) AS test_accuracy, y, category,
  count(*)::BIGINT AS docs, sum(hit)::BIGINT AS hits FROM te, (SELECT avg(hit) AS acc FROM te) GROUP BY y, category)"""


@query("m15_l2_study", " UNION ALL ".join(map(l2_study_sql, L2_SETS)))
def _(spark, folder):
    return study.l2_study(spark, folder, L2_SETS, STUDY_SWEEPS, restarts=RESTARTS, folds=FOLDS, steps=STEPS)
