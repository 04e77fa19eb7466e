"""Checkable queries: heads on topic features. Two topics; the class is the document's quality label."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicweave.catalog.base import CORPUS, blocks_sql, hash32, query, quoted, sweep_sql, tokens_sql, uniform
from topicweave.catalog.modelling import started
from topicweave.operators import corpus, diagnostics, heads
from topicweave.plans import gibbs
from topicweave.session import materialize, scratch_path
from topicweave.sources import samples as store
from topicweave.sources.tables import table

K = 2
MODEL = gibbs.Model(k=K)
ETA = [[0.7, -0.3], [0.2, 0.5]]
RESTARTS, FOLDS, STEPS = 100, 5, 200


def blocks(spark, folder):
    """Block probabilities of the first sweep, written once."""
    return materialize(gibbs.block_probabilities(started(spark, folder, MODEL).weights(), K), "blocks")


def labels(spark, folder):
    return table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))


def features(spark, folder):
    """Mean block probabilities of the labelled documents; they are averaged where the blocks are weighed."""
    return materialize(started(spark, folder, MODEL).block_features().join(labels(spark, folder), "doc_id").drop("chain"), "features")


BLOCKS = f"""{CORPUS},
{tokens_sql(K, '7')},
{blocks_sql(K, 'z0', 'b0')},
{sweep_sql(K, 'b0', 's1', 1)},
pk AS (SELECT doc_id, word, n, doc_n, p0 / (p0 + p1) AS q0, p1 / (p0 + p1) AS q1 FROM p_s1),
phi AS (SELECT doc_id, sum(n * q0) / sum(n) AS g0, sum(n * q1) / sum(n) AS g1 FROM pk GROUP BY doc_id),
f AS (SELECT phi.*, quality AS y FROM phi JOIN labels USING (doc_id))"""
SPLIT = f"""{BLOCKS},
sp AS (SELECT *, ({hash32('doc_id', quoted('fold'))} % {FOLDS})::INT AS fold,
       {uniform('doc_id', quoted('split'))} < 0.2::DOUBLE AS is_test FROM f),
st AS (SELECT k.fold, count(*)::DOUBLE AS n, sum(g0 * g0) AS a, sum(g0 * g1) AS b, sum(g1 * g1) AS c,
  sum(g0) FILTER (y = 0) AS s00, sum(g0) FILTER (y = 1) AS s01, sum(g1) FILTER (y = 0) AS s10, sum(g1) FILTER (y = 1) AS s11
  FROM (SELECT unnest(range(0, {FOLDS})) AS fold) k, sp WHERE sp.fold <> k.fold AND NOT is_test GROUP BY k.fold)"""
TRACE = f"""{SPLIT},
starts AS (SELECT r.run, {', '.join(f"(({uniform('r.run', quoted(str(i)), quoted('80'))}) * 2 - 1) AS e{i}" for i in range(4))}
  FROM (SELECT unnest(range(0, {RESTARTS})) AS run) r),
tr AS (
  SELECT run, fold, 0 AS step, e0, e1, e2, e3 FROM starts, st
  UNION ALL
  SELECT run, fold, step + 1, e0 - ((a * e0 + b * e2) - s00) / n, e1 - ((a * e1 + b * e3) - s01) / n,
    e2 - ((b * e0 + c * e2) - s10) / n, e3 - ((b * e1 + c * e3) - s11) / n
  FROM tr JOIN st USING (fold) WHERE step < {STEPS}),
tl AS (SELECT run, fold, step, e0, e1, e2, e3,
  0.5::DOUBLE * (e0 * (a * e0 + b * e2) + e1 * (a * e1 + b * e3) + e2 * (b * e0 + c * e2) + e3 * (b * e1 + c * e3)
    - 2 * (e0 * s00 + e1 * s01 + e2 * s10 + e3 * s11) + n) AS loss
  FROM tr JOIN st USING (fold))"""


@query("a13_mean_probabilities", f"WITH {BLOCKS} SELECT doc_id, round(g0, 9) AS g0, round(g1, 9) AS g1 FROM phi")
def _(spark, folder):
    rows = heads.mean_probabilities(blocks(spark, folder), K)
    return rows.select("doc_id", *[F.round(F.col("g")[i], 9).alias(f"g{i}") for i in range(K)])


@query("a13_binary_weights", f"""WITH {BLOCKS}
SELECT doc_id, round(avg(q0), 9) AS g0, round(avg(q1), 9) AS g1 FROM pk GROUP BY doc_id""")
def _(spark, folder):
    rows = heads.mean_probabilities(blocks(spark, folder), K, weights="binary")
    return rows.select("doc_id", *[F.round(F.col("g")[i], 9).alias(f"g{i}") for i in range(K)])


@query("m13_test_split", f"WITH {SPLIT} SELECT doc_id, is_test FROM sp")
def _(spark, folder):
    return heads.split_rows(features(spark, folder)).select("doc_id", "is_test")


@query("m14_folds", f"WITH {SPLIT} SELECT fold, count(*)::BIGINT AS docs, sum(doc_id)::BIGINT AS doc_sum FROM sp GROUP BY fold")
def _(spark, folder):
    return heads.fold_rows(features(spark, folder)).groupBy("fold").agg(
        F.count("*").alias("docs"), F.sum("doc_id").alias("doc_sum")
    )


@query("a22_class_statistics", f"""WITH {SPLIT}
SELECT fold, y, count(*)::BIGINT AS n, round(sum(g0), 7) AS s0, round(sum(g1), 7) AS s1,
       round(sum(g0 * g0), 7) AS g00, round(sum(g0 * g1), 7) AS g01, round(sum(g1 * g1), 7) AS g11
FROM sp GROUP BY fold, y""")
def _(spark, folder):
    stats = heads.class_statistics(heads.fold_rows(features(spark, folder)), K, "fold", "y")
    cell = lambda name, i: F.round(F.col(name)[i], 7)
    return stats.select(
        "fold", "y", "n", cell("s", 0).alias("s0"), cell("s", 1).alias("s1"),
        cell("gram", 0).alias("g00"), cell("gram", 1).alias("g01"), cell("gram", 3).alias("g11"),
    )


S0 = f"(g0 * {ETA[0][0]}::DOUBLE + g1 * {ETA[1][0]}::DOUBLE)"
S1 = f"(g0 * ({ETA[0][1]})::DOUBLE + g1 * {ETA[1][1]}::DOUBLE)"


@query("a20_l2_loss", f"WITH {BLOCKS} SELECT round(sum(pow({S0} - (y = 0)::INT, 2) + pow({S1} - (y = 1)::INT, 2)) / 2, 6) AS loss FROM f")
def _(spark, folder):
    return heads.l2_loss(features(spark, folder), ETA, K).withColumn("loss", F.round("loss", 6))


def _pairs_sql(cell) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS topic, {j} AS class, round({cell(i, j)}, 6) AS gradient FROM f" for i in range(K) for j in range(K)
    )


def _rounded(gradient):
    return gradient.withColumn("gradient", F.round("gradient", 6))


@query("a21_l2_gradient", f"WITH {BLOCKS} " + _pairs_sql(lambda i, j: f"sum(g{i} * ({(S0, S1)[j]} - (y = {j})::INT))"))
def _(spark, folder):
    stats = heads.class_statistics(features(spark, folder), K, "y")
    return _rounded(heads.l2_gradient(stats, ETA, K))


@query("a21_l2_gradient_reference", f"WITH {BLOCKS} " + _pairs_sql(
    lambda i, j: f"sum(CASE WHEN y = {j} THEN ({(S0, S1)[j]} - 1) * g{j} ELSE g{j} * g{j} * ({ETA[i][j]})::DOUBLE END)"))
def _(spark, folder):
    stats = heads.class_statistics(features(spark, folder), K, "y")
    return _rounded(heads.l2_gradient(stats, ETA, K, mode="reference"))


PENALTY = 0.5 * sum(e * e for row in ETA for e in row) / 2


@query("a23_softmax_loss", f"""WITH {BLOCKS}
SELECT round(avg(ln(exp({S0}) + exp({S1})) - CASE y WHEN 0 THEN {S0} ELSE {S1} END) + {PENALTY!r}::DOUBLE, 8) AS loss FROM f""")
def _(spark, folder):
    return heads.softmax_loss(features(spark, folder), ETA, K).withColumn("loss", F.round("loss", 8))


@query("a24_softmax_gradient", f"""WITH {BLOCKS.replace('f AS (', 'fa AS (')},
f AS (SELECT * FROM fa ORDER BY {hash32('doc_id', quoted('1111'))}, doc_id LIMIT 10) """ + _pairs_sql(
    lambda i, j: f"avg(g{i} * (exp({(S0, S1)[j]}) / (exp({S0}) + exp({S1})) - (y = {j})::INT)) + 0.5::DOUBLE * ({ETA[i][j]})::DOUBLE"))
def _(spark, folder):
    batch = heads.minibatch(features(spark, folder), 10, 1111)
    return _rounded(heads.softmax_gradient(batch, ETA, K))


INNER = [f"(q0 * exp(({ETA[0][c]})::DOUBLE / doc_n) + q1 * exp(({ETA[1][c]})::DOUBLE / doc_n))" for c in range(K)]
LIKELIHOOD = f"""{BLOCKS},
dl AS (SELECT doc_id, {', '.join(f'sum(n * ln({INNER[c]})) AS l{c}' for c in range(K))},
  {', '.join(f'sum(n * q{i} * exp(({ETA[i][c]})::DOUBLE / doc_n) / doc_n / {INNER[c]}) AS d{i}_{c}' for i in range(K) for c in range(K))}
  FROM pk GROUP BY doc_id),
j AS (SELECT dl.*, f.g0, f.g1, f.y FROM dl JOIN f USING (doc_id))"""


@query("a25_label_likelihood", f"""WITH {LIKELIHOOD}
SELECT round(sum(CASE y WHEN 0 THEN {S0} ELSE {S1} END - ln(exp(l0) + exp(l1))), 5) AS loglik, count(*)::BIGINT AS docs FROM j""")
def _(spark, folder):
    rows = heads.slda_loglik(started(spark, folder, MODEL), labels(spark, folder), ETA, K)
    return rows.withColumn("loglik", F.round("loglik", 5))


@query("a26_label_likelihood_gradient", f"WITH {LIKELIHOOD} " + " UNION ALL ".join(
    f"SELECT {i} AS topic, {c} AS class, round(sum(CASE WHEN y = {c} THEN g{i} ELSE 0 END "
    f"- exp(l{c}) / (exp(l0) + exp(l1)) * d{i}_{c}), 5) AS gradient FROM j" for i in range(K) for c in range(K)))
def _(spark, folder):
    rows = heads.slda_gradient(started(spark, folder, MODEL), labels(spark, folder), ETA, K)
    return rows.withColumn("gradient", F.round("gradient", 5))


def ascent_sql(steps: int) -> str:
    """CTEs of full gradient steps from zero: coefficients ``a<s>``, likelihood ``r<s>``."""
    cells = [(i, c) for i in range(K) for c in range(K)]
    out = BLOCKS + ",\na0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS e{i}{c}" for i, c in cells) + ")"
    inner = [f"(q0 * exp(e0{c} / doc_n) + q1 * exp(e1{c} / doc_n))" for c in range(K)]
    own = "CASE y " + " ".join(f"WHEN {c} THEN g0 * e0{c} + g1 * e1{c}" for c in range(K)) + " END"
    for s in range(steps + 1):
        out += f""",
t{s} AS (SELECT doc_id, {', '.join(f'sum(n * ln({inner[c]})) AS l{c}' for c in range(K))},
  {', '.join(f'sum(n * q{i} * exp(e{i}{c} / doc_n) / doc_n / {inner[c]}) AS d{i}{c}' for i, c in cells)}
  FROM pk, a{s} WHERE doc_id IN (SELECT doc_id FROM f) GROUP BY doc_id),
j{s} AS (SELECT t{s}.*, g0, g1, y FROM t{s} JOIN f USING (doc_id)),
r{s} AS (SELECT sum({own} - ln(exp(l0) + exp(l1))) AS loglik FROM j{s}, a{s}),
a{s + 1} AS (SELECT {', '.join(
    f"any_value(e{i}{c}) + sum(CASE WHEN y = {c} THEN g{i} ELSE 0 END - exp(l{c}) / (exp(l0) + exp(l1)) * d{i}{c}) / count(*) AS e{i}{c}"
    for i, c in cells)} FROM j{s}, a{s})"""
    return out


ASCENT = 20


@query("m10_likelihood_head", f"WITH {ascent_sql(ASCENT)} " + " UNION ALL ".join(
    f"SELECT {s} AS step, round(loglik, 5) AS loglik, "
    + ", ".join(f"(SELECT round(e{i}{c}, 6) FROM a{ASCENT}) AS e{i}{c}" for i in range(K) for c in range(K)) + f" FROM r{s}" for s in range(ASCENT + 1)))
def _(spark, folder):
    eta, history = heads.fit_slda(started(spark, folder, MODEL), labels(spark, folder), K, steps=ASCENT)
    last = [F.round(F.lit(eta[i][c]), 6).alias(f"e{i}{c}") for i in range(K) for c in range(K)]
    return spark.createDataFrame(list(enumerate(history)), "step int, loglik double").select("step", F.round("loglik", 5).alias("loglik"), *last)


@query("m11_l2_solution", f"""WITH {SPLIT}
SELECT fold, round((c * s00 - b * s10) / (a * c - b * b), 4) AS e0, round((c * s01 - b * s11) / (a * c - b * b), 4) AS e1,
  round((a * s10 - b * s00) / (a * c - b * b), 4) AS e2, round((a * s11 - b * s01) / (a * c - b * b), 4) AS e3
FROM (SELECT fold::INT AS fold, n, a, b, c, s00, s01, s10, s11 FROM st)""")
def _(spark, folder):
    rows = heads.fold_rows(heads.split_rows(features(spark, folder))).where(~F.col("is_test"))
    stats = heads.training_statistics(heads.class_statistics(rows, K, "fold", "y"), FOLDS)
    solved = heads.solve_l2(stats, K, "fold")
    return solved.select("fold", *[F.round(F.col("eta")[i], 4).alias(f"e{i}") for i in range(4)])


def restart_trace(spark, folder):
    rows = heads.fold_rows(heads.split_rows(features(spark, folder))).where(~F.col("is_test"))
    stats = heads.training_statistics(heads.class_statistics(rows, K, "fold", "y"), FOLDS)
    return heads.descend_l2(heads.restart_grid(spark, RESTARTS, FOLDS, K), stats, K, STEPS)


SHOWN = ", ".join(f"round(e{i}, 6) AS e{i}" for i in range(4)) + ", round(loss, 5) AS loss"


def _shown(trace):
    return [F.round(F.col("eta")[i], 6).alias(f"e{i}") for i in range(4)] + [F.round("loss", 5).alias("loss")]


@query("m12_restart_trace", f"WITH RECURSIVE {TRACE} SELECT run::INT AS run, fold::INT AS fold, step::INT AS step, {SHOWN} FROM tl")
def _(spark, folder):
    trace = restart_trace(spark, folder)
    return trace.select("run", "fold", "step", *_shown(trace))


@query("j10_restart_grid", f"""WITH {SPLIT}
SELECT r.run::INT AS run, fold::INT AS fold, n::BIGINT AS docs FROM st, (SELECT unnest(range(0, {RESTARTS})) AS run) r""")
def _(spark, folder):
    rows = heads.fold_rows(heads.split_rows(features(spark, folder))).where(~F.col("is_test"))
    stats = heads.training_statistics(heads.class_statistics(rows, K, "fold", "y"), FOLDS)
    sizes = stats.groupBy("fold").agg(F.sum("n").alias("docs"))
    return heads.restart_grid(spark, RESTARTS, FOLDS, K).join(sizes, "fold").select("run", "fold", "docs")


def _numbered(trace):
    return trace.select((F.col("run") * FOLDS + F.col("fold")).alias("run"), "step", "eta", "loss")


@query("s9_trace_text", f"WITH RECURSIVE {TRACE} SELECT (run * {FOLDS} + fold)::INT AS run, step::INT AS step, {SHOWN} FROM tl")
def _(spark, folder):
    path = scratch_path(spark, "trace")
    store.write_trace(_numbered(restart_trace(spark, folder)), path, K)
    trace = store.read_trace(spark, path)
    return trace.select("run", "step", *_shown(trace))


@query("w8_loss_changes", f"""WITH RECURSIVE {TRACE},
ch AS (SELECT run * {FOLDS} + fold AS run, step, loss,
       loss - lag(loss) OVER (PARTITION BY run, fold ORDER BY step) AS change FROM tl)
SELECT run::INT AS run, count(*) FILTER (change > 0)::BIGINT AS rises, count(*) FILTER (change < 0)::BIGINT AS drops,
       round(min(loss), 5) AS min_loss, round(arg_max(loss, step), 5) AS last_loss FROM ch GROUP BY run""")
def _(spark, folder):
    rows = diagnostics.loss_changes(_numbered(restart_trace(spark, folder)))
    return rows.withColumns({c: F.round(c, 5) for c in ("min_loss", "last_loss")})


CV = f"""{TRACE},
fin AS (SELECT run, fold, e0, e1, e2, e3 FROM tr WHERE step = {STEPS}),
va AS (SELECT run, fold, avg(((g0 * e1 + g1 * e3 > g0 * e0 + g1 * e2)::INT = y)::INT) AS acc
       FROM sp JOIN fin USING (fold) WHERE NOT is_test GROUP BY run, fold),
cv AS (SELECT run, avg(acc) AS cv_score FROM va GROUP BY run),
av AS (SELECT run, avg(e0) AS e0, avg(e1) AS e1, avg(e2) AS e2, avg(e3) AS e3 FROM fin GROUP BY run),
te AS (SELECT run, avg(((g0 * e1 + g1 * e3 > g0 * e0 + g1 * e2)::INT = y)::INT) AS test_accuracy
       FROM sp, av WHERE is_test GROUP BY run),
res AS (SELECT * FROM cv JOIN te USING (run) JOIN av USING (run))"""
SCORE = "run::INT AS run, round(cv_score, 8) AS cv_score, round(test_accuracy, 8) AS test_accuracy"


def validated(spark, folder):
    return heads.cross_validate(features(spark, folder), K, RESTARTS, FOLDS, STEPS)


@query("m15_cross_validation", f"WITH RECURSIVE {CV} SELECT {SCORE} FROM res")
def _(spark, folder):
    return validated(spark, folder).select(
        "run", F.round("cv_score", 8).alias("cv_score"), F.round("test_accuracy", 8).alias("test_accuracy")
    )


@query("a27_fold_means", f"WITH RECURSIVE {CV} SELECT run::INT AS run, round(cv_score, 8) AS cv_score, "
       + ", ".join(f"round(e{i}, 6) AS e{i}" for i in range(4)) + " FROM res")
def _(spark, folder):
    rows = validated(spark, folder)
    return rows.select(
        "run", F.round("cv_score", 8).alias("cv_score"), *[F.round(F.col("eta")[i], 6).alias(f"e{i}") for i in range(4)]
    )


@query("o4_best_restart", f"WITH RECURSIVE {CV} SELECT {SCORE} FROM res ORDER BY round(res.cv_score, 8) DESC, run LIMIT 1")
def _(spark, folder):
    rows = validated(spark, folder).withColumn("cv_score", F.round("cv_score", 8))
    return heads.best_run(rows).select("run", "cv_score", F.round("test_accuracy", 8).alias("test_accuracy"))


def softmax_sql(steps: int, rate, batch=None, start: float = 0.0, ridge: float = 0.5) -> str:
    """CTEs of descent steps of the softmax head: coefficients ``a0`` to ``a<steps>``."""
    cells = [(i, c) for i in range(K) for c in range(K)]
    out = BLOCKS + ",\na0 AS (SELECT " + ", ".join(f"{start}::DOUBLE AS e{i}{c}" for i, c in cells) + ")"
    for s in range(steps):
        rows = "f" if batch is None else f"(SELECT * FROM f ORDER BY {hash32('doc_id', quoted(f'1111.{s}'))}, doc_id LIMIT {batch})"
        out += f""",
x{s} AS (SELECT *, exp(g0 * e00 + g1 * e10) AS x0, exp(g0 * e01 + g1 * e11) AS x1 FROM {rows}, a{s}),
a{s + 1} AS (SELECT {', '.join(
    f"any_value(e{i}{c}) - {rate(s)!r}::DOUBLE * (avg(g{i} * (x{c} / (x0 + x1) - (y = {c})::INT)) + {ridge}::DOUBLE * any_value(e{i}{c})) AS e{i}{c}"
    for i, c in cells)} FROM x{s})"""
    return out


@query("m9_softmax_head", f"""WITH {softmax_sql(45, lambda s: 1.0)},
x AS (SELECT doc_id, y, exp(g0 * e00 + g1 * e10) AS x0, exp(g0 * e01 + g1 * e11) AS x1 FROM f, a45)
SELECT doc_id, y, round(x1 / (x0 + x1), 4) AS p1, (x1 > x0)::INT AS pred FROM x""")
def _(spark, folder):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = features(spark, folder)
    model = heads.fit_softmax(rows)
    scored = model.transform(rows.select("doc_id", "y", array_to_vector("g").alias("features")))
    chance = vector_to_array("probability")
    return scored.select(
        "doc_id", "y", F.round(chance[1], 4).alias("p1"), F.col("prediction").cast("int").alias("pred")
    )


@query("m9_softmax_sgd", f"""WITH {softmax_sql(20, lambda s: 1.0 / (1 + s), batch=10, start=0.5)}
SELECT round(avg(ln(exp(g0 * e00 + g1 * e10) + exp(g0 * e01 + g1 * e11)) - CASE y WHEN 0 THEN g0 * e00 + g1 * e10 ELSE g0 * e01 + g1 * e11 END)
  + 0.25 * any_value(e00 * e00 + e01 * e01 + e10 * e10 + e11 * e11), 6) AS loss FROM f, a20""")
def _(spark, folder):
    rows = features(spark, folder)
    eta = heads.fit_softmax_sgd(rows, K)
    return heads.softmax_loss(rows, eta, K).withColumn("loss", F.round("loss", 6))


# -- many topics and classes: the class is the document's source -------------------------------------------------------------

WIDE = 20
WIDE_MODEL = gibbs.Model(k=WIDE)
WIDE_ETA = [[((7 * i + 3 * c) % 11 - 5) / 10 for c in range(WIDE)] for i in range(WIDE)]


def wide_inputs(spark, folder):
    """A chain with 20 topics before its first sweep, and the documents' sources as classes. Its block probabilities, 20 numbers for each
    pair of document and word, are nowhere stored."""
    classes = corpus.with_class_ids(table(spark, folder, "documents").select("doc_id", F.col("source").alias("category")))
    return started(spark, folder, WIDE_MODEL), classes.select("doc_id", "y")


WIDE_GRADIENT = f"""{CORPUS},
{tokens_sql(WIDE, '7')},
{blocks_sql(WIDE, 'z0', 'b0')},
{sweep_sql(WIDE, 'b0', 's1', 1)},
lab AS (SELECT doc_id, (dense_rank() OVER (ORDER BY source) - 1)::INT AS y FROM documents),
e AS (SELECT i::INT AS i, c::INT AS c, ((7 * i + 3 * c) % 11 - 5)::DOUBLE / 10 AS eta
  FROM (SELECT unnest(range(0, {WIDE})) AS i), (SELECT unnest(range(0, {WIDE})) AS c)),
pl AS (SELECT doc_id, word, n, doc_n, unnest(range(0, {WIDE}))::INT AS i,
  unnest([{', '.join(f'p{i}' for i in range(WIDE))}]) / ({' + '.join(f'p{i}' for i in range(WIDE))}) AS q FROM p_s1),
ins AS (SELECT doc_id, word, c, any_value(n) AS n, sum(q * exp(eta / doc_n)) AS inside FROM pl JOIN e USING (i) GROUP BY doc_id, word, c),
logs AS (SELECT doc_id, c, sum(n * ln(inside)) AS l FROM ins GROUP BY doc_id, c),
chance AS (SELECT doc_id, c, exp(l - max(l) OVER d) / sum(exp(l)) OVER d * exp(max(l) OVER d) AS chance FROM logs WINDOW d AS (PARTITION BY doc_id)),
slopes AS (SELECT doc_id, i, c, sum(pl.n * q * exp(eta / doc_n) / doc_n / inside) AS d
  FROM pl JOIN e USING (i) JOIN ins USING (doc_id, word, c) GROUP BY doc_id, i, c),
means AS (SELECT doc_id, i, sum(n * q) / sum(n) AS g FROM pl GROUP BY doc_id, i)"""


@query("a26_wide", f"""WITH {WIDE_GRADIENT}
SELECT i AS topic, c AS class, round(sum((y = c)::INT * g - chance * d), 5) AS gradient
FROM slopes JOIN means USING (doc_id, i) JOIN chance USING (doc_id, c) JOIN lab USING (doc_id) GROUP BY i, c""")
def _(spark, folder):
    chain, own = wide_inputs(spark, folder)
    return heads.slda_gradient(chain, own, WIDE_ETA, WIDE).withColumn("gradient", F.round("gradient", 5))


@query("a22_wide", f"""WITH {WIDE_GRADIENT}
SELECT y, a.i AS topic, b.i AS other, round(sum(a.g * b.g), 7) AS gram
FROM means a JOIN means b USING (doc_id) JOIN lab USING (doc_id) GROUP BY y, a.i, b.i""")
def _(spark, folder):
    chain, own = wide_inputs(spark, folder)
    stats = heads.class_statistics(chain.block_features().join(own, "doc_id"), WIDE, "y")
    cells = stats.select("y", F.posexplode("gram").alias("at", "gram"))
    return cells.select(
        "y", F.floor(F.col("at") / WIDE).cast("int").alias("topic"), (F.col("at") % WIDE).cast("int").alias("other"), F.round("gram", 7).alias("gram"))


@query("m10_wide")
def _(spark, folder):
    """All 20 steps; SQL would join each block with each topic and class in every step, so a test holds it against a plain version."""
    chain, own = wide_inputs(spark, folder)
    eta, history = heads.fit_slda(chain, own, WIDE)
    return spark.createDataFrame(list(enumerate(history)), "step int, loglik double").withColumn("norm", F.lit(float(sum(e * e for r in eta for e in r))))
