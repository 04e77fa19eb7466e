"""Checkable queries: topic assignments, sweeps, samples, diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicweave.catalog.base import (
    CORPUS, ORACLES, blocks_sql, hash32, long_sql, query, quoted, sweep_sql, token_sweep_sql, tokens_sql, uniform,
)
from topicweave.catalog.cleaning import corpus_of, documents
from topicweave.functions import draws, vectors
from topicweave.operators import corpus, diagnostics, moments, ranking, topic_counts
from topicweave.plans import gibbs, variational
from topicweave.session import materialize, scratch_path
from topicweave.sources import samples as store
from topicweave.sources.tables import table

K = 4
MODEL = gibbs.Model(k=K)
TOKEN_MODEL = gibbs.Model(k=K, grain="token")
#: Sweeps before ``KEPT_FROM`` are burn-in.
SWEEPS, KEPT_FROM = 30, 21
PASSES = 20
LAGS = SWEEPS - KEPT_FROM


def written_corpus(spark, folder):
    return materialize(corpus_of(spark, folder), "counts")


def start_state(spark, folder, model=MODEL):
    return materialize(gibbs.initial_state(written_corpus(spark, folder), model), "state")


def class_labels(spark, folder):
    return corpus.with_class_ids(documents(spark, folder).select("doc_id", F.col("lang").alias("category")))


def block_columns(state, k=K):
    return state.select("doc_id", "word", "n", *[F.col("c")[i].cast("bigint").alias(f"c{i}") for i in range(k)])


def started(spark, folder, model=MODEL, labels=None):
    return gibbs.Chain(spark, model).start(corpus_of(spark, folder), labels)


def swept_chain(spark, folder, model=MODEL):
    return gibbs.Chain(spark, model).start(corpus_of(spark, folder)).run(1)


def swept(spark, folder, model=MODEL):
    """State after one sweep."""
    return swept_chain(spark, folder, model).state()


def gamma_after_sweep(spark, folder):
    return swept_chain(spark, folder).gamma()


def beta_after_sweep(spark, folder):
    return swept_chain(spark, folder).beta()


# -- shared SQL --------------------------------------------------------------------------------------------------------

START = f"{CORPUS},\n{tokens_sql(K, '7')},\n{blocks_sql(K, 'z0', 'b0')}"
ONE = f"{START},\n{sweep_sql(K, 'b0', 's1', 1)},\n{blocks_sql(K, 'z_s1', 'b1')}"
C = ", ".join(f"c{i}" for i in range(K))
D_SUMS = ", ".join(f"sum(c{i})::BIGINT AS c{i}" for i in range(K))
LEN = "(" + " + ".join(f"c{i}" for i in range(K)) + ")"


def gamma_sql(source: str, name: str = "g", k: int = K) -> str:
    length = " + ".join(f"c{i}" for i in range(k))
    sums = ", ".join(f"sum(c{i})::BIGINT AS c{i}" for i in range(k))
    cells = ", ".join(f"(c{i} + 0.1::DOUBLE) / ({length} + {k * 0.1}::DOUBLE) AS g{i}" for i in range(k))
    return f"{name} AS (SELECT doc_id, {cells} FROM (SELECT doc_id, {sums} FROM {source} GROUP BY doc_id))"


def beta_sql(source: str, name: str = "beta") -> str:
    cells = ", ".join(f"(c{i} + 0.1::DOUBLE) / (t{i} + 0.1::DOUBLE * terms) AS p{i}" for i in range(K))
    t = ", ".join(f"sum(c{i})::BIGINT AS t{i}" for i in range(K))
    return f"""w_{name} AS (SELECT word, {D_SUMS} FROM {source} GROUP BY word),
t_{name} AS (SELECT {t}, count(*) AS terms FROM w_{name}),
{name} AS (SELECT word, {cells} FROM w_{name}, t_{name})"""


GAMMA = f"{ONE},\n{gamma_sql('b1')}"
BETA = f"{ONE},\n{beta_sql('b1')}"
LABELS = "lab AS (SELECT doc_id, lang AS category, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS y FROM documents)"

# -- assignments and counts --------------------------------------------------------------------------------------------


@query("m1_random_topics", f"WITH {CORPUS}, {tokens_sql(K, '7')} SELECT doc_id, word, rep::INT AS rep, z FROM z0")
def _(spark, folder):
    return topic_counts.random_tokens(corpus_of(spark, folder), K, 7)


@query("m1_random_blocks", f"WITH {START} SELECT * FROM b0")
def _(spark, folder):
    return block_columns(topic_counts.random_blocks(corpus_of(spark, folder), K, 7))


@query("m19_label_seeded_topics", f"""WITH {CORPUS}, {LABELS},
c AS (SELECT doc_id, word, unnest(range(1, n + 1)) AS rep, y FROM corpus JOIN lab USING (doc_id)),
s AS (SELECT *, {uniform('doc_id', 'word', 'rep', quoted('19'))} AS u,
  {', '.join(f"CASE WHEN y = {i} THEN 0.8::DOUBLE ELSE {(1.0 - 0.8) / 3!r}::DOUBLE END AS p{i}" for i in range(K))} FROM c)
SELECT doc_id, word, rep::INT AS rep,
  ((u * (((p0 + p1) + p2) + p3) >= p0)::INT + (u * (((p0 + p1) + p2) + p3) >= (p0 + p1))::INT
   + (u * (((p0 + p1) + p2) + p3) >= ((p0 + p1) + p2))::INT) AS z FROM s""")
def _(spark, folder):
    return topic_counts.label_seeded_tokens(
        written_corpus(spark, folder), class_labels(spark, folder), K, 19
    ).select("doc_id", "word", "rep", "z")


@query("m19_partial_labels", f"""WITH {CORPUS}, lab AS (SELECT doc_id, quality AS y FROM labels),
c AS (SELECT doc_id, word, unnest(range(1, n + 1)) AS rep, y FROM corpus LEFT JOIN lab USING (doc_id)),
s AS (SELECT *, {uniform('doc_id', 'word', 'rep', quoted('19'))} AS u,
  {', '.join(f"CASE WHEN y IS NULL THEN 0.25::DOUBLE WHEN y = {i} THEN 0.8::DOUBLE ELSE {(1.0 - 0.8) / 3!r}::DOUBLE END AS p{i}" for i in range(K))} FROM c)
SELECT doc_id, word, rep::INT AS rep,
  ((u * (((p0 + p1) + p2) + p3) >= p0)::INT + (u * (((p0 + p1) + p2) + p3) >= (p0 + p1))::INT
   + (u * (((p0 + p1) + p2) + p3) >= ((p0 + p1) + p2))::INT) AS z FROM s""")
def _(spark, folder):
    return topic_counts.label_seeded_tokens(
        written_corpus(spark, folder), quality_labels(spark, folder), K, 19
    ).select("doc_id", "word", "rep", "z")


@query("a8_document_topics", f"WITH {START}, d AS (SELECT doc_id, {D_SUMS} FROM b0 GROUP BY doc_id) "
       + long_sql(K, "d", "doc_id", lambda i: f"c{i}", "cnt"))
def _(spark, folder):
    blocks = topic_counts.random_blocks(corpus_of(spark, folder), K, 7)
    return topic_counts.tidy(topic_counts.counts_by(blocks, "doc_id", K), "doc_id", "cnt", "cnt")


@query("a8_word_topics", f"WITH {START}, d AS (SELECT word, {D_SUMS} FROM b0 GROUP BY word) "
       + long_sql(K, "d", "word", lambda i: f"c{i}", "cnt"))
def _(spark, folder):
    blocks = topic_counts.random_blocks(corpus_of(spark, folder), K, 7)
    return topic_counts.tidy(topic_counts.counts_by(blocks, "word", K), "word", "cnt", "cnt")


@query("a8_topic_totals", f"WITH {START} SELECT z AS topic, count(*)::BIGINT AS cnt FROM z0 GROUP BY z")
def _(spark, folder):
    blocks = topic_counts.random_blocks(corpus_of(spark, folder), K, 7)
    totals = topic_counts.topic_totals(topic_counts.counts_by(blocks, "word", K), K)
    return totals.select(F.posexplode_outer("nk").alias("topic", "cnt"))


@query("a33_mass_by_document", f"WITH {ONE}, x AS (SELECT doc_id, sum({LEN})::BIGINT AS assigned FROM b1 GROUP BY doc_id), y AS (SELECT doc_id, sum(n)::BIGINT AS counted FROM corpus GROUP BY doc_id) SELECT doc_id, counted, coalesce(assigned, 0) AS assigned, counted = coalesce(assigned, 0) AS conserved FROM y LEFT JOIN x USING (doc_id)")
def _(spark, folder):
    return topic_counts.mass_by_document(swept(spark, folder), corpus_of(spark, folder), K)


@query("a33_mass_by_table", f"""WITH {CORPUS}, t AS (SELECT sum(n)::BIGINT AS tokens FROM corpus)
SELECT 'documents' AS source, tokens FROM t UNION ALL SELECT 'words', tokens FROM t UNION ALL SELECT 'topics', tokens FROM t""")
def _(spark, folder):
    return topic_counts.mass_by_table(materialize(swept(spark, folder), "state"), K)


@query("a10_gamma", f"WITH {GAMMA} " + long_sql(K, "g", "doc_id", lambda i: f"round(g{i}, 9)", "gamma"))
def _(spark, folder):
    long = topic_counts.tidy(gamma_after_sweep(spark, folder), "doc_id", "g", "gamma")
    return long.withColumn("gamma", F.round("gamma", 9))


@query("a11_beta", f"WITH {BETA} " + long_sql(K, "beta", "word", lambda i: f"round(p{i}, 9)", "beta"))
def _(spark, folder):
    long = topic_counts.tidy(beta_after_sweep(spark, folder), "word", "b", "beta")
    return long.withColumn("beta", F.round("beta", 9))


@query("r3_tidy_gamma", f"WITH {START}, {gamma_sql('b0')} " + long_sql(K, "g", "doc_id", lambda i: f"round(g{i}, 9)", "gamma"))
def _(spark, folder):
    by_doc = topic_counts.counts_by(topic_counts.random_blocks(corpus_of(spark, folder), K, 7), "doc_id", K)
    long = topic_counts.tidy(topic_counts.gamma(by_doc, K, 0.1), "doc_id", "g", "gamma")
    return long.withColumn("gamma", F.round("gamma", 9))


@query("r4_spread_topics", f"WITH {GAMMA} SELECT doc_id, " + ", ".join(f"round(g{i}, 9) AS topic_{i}" for i in range(K)) + " FROM g")
def _(spark, folder):
    long = topic_counts.tidy(gamma_after_sweep(spark, folder), "doc_id", "g", "gamma")
    return topic_counts.spread_topics(long.withColumn("gamma", F.round("gamma", 9)), "doc_id", "gamma", K)


@query("r5_gather_topics", f"WITH {GAMMA} " + long_sql(K, "g", "doc_id", lambda i: f"round(g{i}, 9)", "gamma"))
def _(spark, folder):
    g = gamma_after_sweep(spark, folder)
    wide = g.select("doc_id", *[F.round(F.col("g")[i], 9).alias(f"topic_{i}") for i in range(K)])
    return topic_counts.gather_topics(wide, "doc_id", "gamma", K)


# -- sweeps ------------------------------------------------------------------------------------------------------------

@query("j8_sweep_weights", f"WITH {START}, {sweep_sql(K, 'b0', 's1', 1)} SELECT doc_id, word, doc_n::BIGINT AS doc_n, "
       + ", ".join(f"round(p{i}, 9) AS p{i}" for i in range(K)) + " FROM p_s1")
def _(spark, folder):
    weighted = started(spark, folder).weights()
    return weighted.select("doc_id", "word", "doc_n", *[F.round(F.col("p")[i], 9).alias(f"p{i}") for i in range(K)])


@query("m2_token_sweep", f"WITH {CORPUS}, {tokens_sql(K, '7')}, {token_sweep_sql(K, 'z0', 's1', 1)} "
       "SELECT doc_id, word, rep::INT AS rep, z FROM z_s1")
def _(spark, folder):
    return swept(spark, folder, TOKEN_MODEL).select("doc_id", "word", "rep", "z")


@query("m2_two_token_sweeps", f"WITH {CORPUS}, {tokens_sql(K, '7')}, {token_sweep_sql(K, 'z0', 's1', 1)}, "
       f"{token_sweep_sql(K, 'z_s1', 's2', 2)} SELECT z AS topic, count(*)::BIGINT AS tokens, sum(doc_id)::BIGINT AS doc_sum, "
       "count(DISTINCT word)::BIGINT AS words FROM z_s2 GROUP BY z")
def _(spark, folder):
    chain = gibbs.Chain(spark, TOKEN_MODEL).start(corpus_of(spark, folder)).run(2)
    return chain.state().groupBy(F.col("z").alias("topic")).agg(
        F.count("*").alias("tokens"), F.sum("doc_id").alias("doc_sum"), F.countDistinct("word").alias("words")
    )


@query("m3_block_sweep", f"WITH {ONE} SELECT * FROM b1")
def _(spark, folder):
    return block_columns(swept(spark, folder))


TWO = f"{ONE},\n{sweep_sql(K, 'b1', 's2', 2)},\n{blocks_sql(K, 'z_s2', 'b2')}"


@query("m3_two_block_sweeps", f"WITH {TWO} SELECT * FROM b2")
def _(spark, folder):
    return block_columns(gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder)).run(2).state())


@query("m6_sample_store", f"WITH {TWO}, {gamma_sql('b1', 'ga')}, {gamma_sql('b2', 'gb')} "
       + long_sql(K, "ga", "1 AS iter, doc_id", lambda i: f"round(g{i}, 9)", "value") + " UNION ALL "
       + long_sql(K, "gb", "2 AS iter, doc_id", lambda i: f"round(g{i}, 9)", "value"))
def _(spark, folder):
    chain = gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder)).run(2, keep_from=1)
    return chain.samples("gamma").select(
        "iter", "doc_id", F.posexplode_outer("g").alias("topic", "value")
    ).withColumn("value", F.round("value", 9))


@query("m6_beta_store", f"WITH {TWO}, {beta_sql('b1', 'ba')}, {beta_sql('b2', 'bb')} "
       + long_sql(K, "ba", "1 AS iter, word", lambda i: f"round(p{i}, 9)", "value") + " UNION ALL "
       + long_sql(K, "bb", "2 AS iter, word", lambda i: f"round(p{i}, 9)", "value"))
def _(spark, folder):
    chain = gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder)).run(2, keep_from=1)
    return chain.samples("beta").select(
        "iter", "word", F.posexplode_outer("b").alias("topic", "value")
    ).withColumn("value", F.round("value", 9))


@query("m7_block_probabilities", f"WITH {START}, {sweep_sql(K, 'b0', 's1', 1)} SELECT doc_id, word, n, doc_n::BIGINT AS doc_n, "
       + ", ".join(f"round(p{i} / (((p0 + p1) + p2) + p3), 9) AS q{i}" for i in range(K)) + " FROM p_s1")
def _(spark, folder):
    blocks = gibbs.block_probabilities(started(spark, folder).weights(), K)
    return blocks.select(
        "doc_id", "word", "n", "doc_n", *[F.round(F.col("p")[i], 9).alias(f"q{i}") for i in range(K)]
    )


ETA = [[0.6, -0.2, 0.1, 0.0], [-0.3, 0.5, 0.0, 0.2], [0.1, 0.0, 0.7, -0.4], [0.0, 0.3, -0.1, 0.4]]


def headed(kind):
    return gibbs.Model(k=K, head=gibbs.Head(kind, tuple(map(tuple, ETA))))


def _rest(c: int) -> str:
    return " + ".join(f"{ETA[c][i]}::DOUBLE * (d{i} - c{i}) / doc_n" for i in range(K))


def _moved(c: int, i: int) -> str:
    return f"(({_rest(c)}) + {ETA[c][i]}::DOUBLE * n / doc_n)"


M8_LABEL = (
    f"WITH {START}, {LABELS}, {sweep_sql(K, 'b0', 's1', 1)}, "
    "x AS (SELECT p_s1.*, " + C + ", " + ", ".join(f"d{i}" for i in range(K)) + ", y FROM p_s1 JOIN b0 USING (doc_id, word) "
    "JOIN nd_s1 USING (doc_id) JOIN lab USING (doc_id)) SELECT doc_id, word, "
    + ", ".join(
        f"round(p{i} * exp(CASE y " + " ".join(f"WHEN {c} THEN {_moved(c, i)}" for c in range(K))
        + " END) / (" + " + ".join(f"exp({_moved(c, i)})" for c in range(K)) + f"), 8) AS p{i}"
        for i in range(K)
    ) + " FROM x"
)


@query("m8_label_weights", M8_LABEL)
def _(spark, folder):
    weighted = started(spark, folder, headed("label"), class_labels(spark, folder)).weights()
    return weighted.select("doc_id", "word", *[F.round(F.col("p")[i], 8).alias(f"p{i}") for i in range(K)])


PARTIAL = M8_LABEL.replace(LABELS, "lab AS (SELECT doc_id, quality AS y FROM labels)").replace(
    "JOIN lab USING (doc_id))", "LEFT JOIN lab USING (doc_id))")
for _i in range(K):
    _start = PARTIAL.index(f"round(p{_i} * exp(CASE y")
    _end = PARTIAL.index(f", 8) AS p{_i}", _start)
    _factor = PARTIAL[_start + len(f"round(p{_i} * "):_end]
    PARTIAL = PARTIAL[:_start] + f"round(p{_i} * CASE WHEN y IS NULL THEN 1.0::DOUBLE ELSE {_factor} END" + PARTIAL[_end:]


def quality_labels(spark, folder):
    """Labels that only some documents have."""
    return table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))


@query("m8_partial_labels", PARTIAL)
def _(spark, folder):
    weighted = started(spark, folder, headed("label"), quality_labels(spark, folder)).weights()
    return weighted.select("doc_id", "word", *[F.round(F.col("p")[i], 8).alias(f"p{i}") for i in range(K)])


def _score(c: int, full: bool) -> str:
    if full:
        return "(" + " + ".join(f"{ETA[c][i]}::DOUBLE * d{i} / doc_n" for i in range(K)) + ")"
    cells = " + ".join(f"{ETA[c][i]}::DOUBLE * (d{i} - c{i}) / (doc_n - n)" for i in range(K))
    return f"(CASE WHEN doc_n > n THEN {cells} ELSE 0.0::DOUBLE END)"


@query("m8_ratio_weights", (
    f"WITH {START}, {sweep_sql(K, 'b0', 's1', 1)}, x AS (SELECT p_s1.*, " + C + ", "
    + ", ".join(f"d{i}" for i in range(K)) + " FROM p_s1 JOIN b0 USING (doc_id, word) JOIN nd_s1 USING (doc_id)) "
    "SELECT doc_id, word, " + ", ".join(
        f"round(p{i} * (exp({_score(i, True)}) / (" + " + ".join(f"exp({_score(c, True)})" for c in range(K))
        + f")) / (exp({_score(i, False)}) / (" + " + ".join(f"exp({_score(c, False)})" for c in range(K))
        + f")), 8) AS p{i}" for i in range(K)
    ) + " FROM x"))
def _(spark, folder):
    weighted = started(spark, folder, headed("ratio")).weights()
    return weighted.select("doc_id", "word", *[F.round(F.col("p")[i], 8).alias(f"p{i}") for i in range(K)])


@query("m8_zero_head_sweep", f"WITH {ONE} SELECT z AS topic, count(*)::BIGINT AS tokens FROM z_s1 GROUP BY z")
def _(spark, folder):
    model = gibbs.Model(k=K, head=gibbs.Head("ratio", ((0.0,) * K,) * K))
    state = swept(spark, folder, model)
    totals = topic_counts.topic_totals(topic_counts.counts_by(state, "word", K), K)
    return totals.select(F.posexplode_outer("nk").alias("topic", "tokens"))


CLASSES, LEARNING = 2, 3


def learning_sql(sweeps: int = LEARNING, ridge: float = 0.5, rate: float = 1.0) -> str:
    """Sweeps whose draws are weighed by the label's chance, with one step of the head after each but the last: blocks ``b<s>``,
    coefficients ``e<s>`` (class, topic)."""
    cells = [(c, i) for c in range(CLASSES) for i in range(K)]
    out = f"{START},\nlab AS (SELECT doc_id, quality AS y FROM labels),\ne1 AS (SELECT " + ", ".join(f"{1 / K!r}::DOUBLE AS e{c}{i}" for c, i in cells) + ")"
    rest = [" + ".join(f"e{c}{i} * (d{i} - c{i}) / doc_n" for i in range(K)) for c in range(CLASSES)]
    for s in range(1, sweeps + 1):
        moved = [[f"exp({rest[c]} + e{c}{i} * p.n / doc_n)" for i in range(K)] for c in range(CLASSES)]
        factor = [f"CASE WHEN y IS NULL THEN 1.0::DOUBLE ELSE (CASE y " + " ".join(f"WHEN {c} THEN {moved[c][i]}" for c in range(CLASSES))
                  + " END) / (" + " + ".join(moved[c][i] for c in range(CLASSES)) + ") END" for i in range(K)]
        plain = sweep_sql(K, f"b{s - 1}", f"s{s}", s)
        weights = ", ".join(f"p{i} * {factor[i]} AS p{i}" for i in range(K))
        weighed = f"""q_s{s} AS (SELECT p.doc_id, word, p.n, {weights} FROM p_s{s} p JOIN b{s - 1} USING (doc_id, word)
  JOIN nd_s{s} USING (doc_id) LEFT JOIN lab USING (doc_id), e{s}),
"""
        at = plain.index(f"b_s{s} AS (")
        plain = plain[:at] + weighed + plain[at:].replace(f"FROM p_s{s})", f"FROM q_s{s})", 1)
        out += f",\n{plain},\n{blocks_sql(K, f'z_s{s}', f'b{s}')}"
        score = [" + ".join(f"e{c}{i} * g{i}" for i in range(K)) for c in range(CLASSES)]
        total = " + ".join(f"exp({x})" for x in score)
        slopes = ", ".join(
            f"any_value(e{c}{i}) - {rate}::DOUBLE * (avg(g{i} * (exp({score[c]}) / ({total}) - (y = {c})::INT)) + {ridge}::DOUBLE * any_value(e{c}{i})) AS e{c}{i}"
            for c, i in cells)
        shares = ", ".join(f"c{i}::DOUBLE / {LEN} AS g{i}" for i in range(K))
        out += f""",
g_s{s} AS (SELECT doc_id, {shares}, y FROM (SELECT doc_id, {D_SUMS} FROM b{s} GROUP BY doc_id) JOIN lab USING (doc_id)),
e{s + 1} AS (SELECT {slopes} FROM g_s{s}, e{s})"""
    return out


def learned(spark, folder):
    chain = gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder), quality_labels(spark, folder))
    return chain.learn_head(CLASSES, LEARNING)


@query("m8_learned_head", f"WITH {learning_sql()} SELECT doc_id, {D_SUMS} FROM b{LEARNING} GROUP BY doc_id")
def _(spark, folder):
    return learned(spark, folder).documents().select("doc_id", *[F.col("counts")[i].alias(f"c{i}") for i in range(K)])


@query("m8_learned_coefficients", f"WITH {learning_sql()} " + " UNION ALL ".join(
    f"SELECT {c} AS class, {i} AS topic, round(e{c}{i}, 9) AS eta FROM e{LEARNING}" for c in range(CLASSES) for i in range(K)))
def _(spark, folder):
    head = learned(spark, folder).model.head
    rows = [(c, i, value) for c, row in enumerate(head.eta) for i, value in enumerate(row)]
    return spark.createDataFrame(rows, "class int, topic int, eta double").withColumn("eta", F.round("eta", 9))


def chain_sql(k: int, sweeps: int, seed: int = 7, base: str = CORPUS, counts: str = "corpus") -> str:
    """CTEs of a chain over the table ``counts`` of ``base``: blocks ``b0`` to ``b<sweeps>``."""
    out = f"{base},\n{tokens_sql(k, str(seed), counts)},\n{blocks_sql(k, 'z0', 'b0')}"
    for s in range(1, sweeps + 1):
        out += f",\n{sweep_sql(k, f'b{s - 1}', f's{s}', s, seed)},\n{blocks_sql(k, f'z_s{s}', f'b{s}')}"
    return out


@query("m4_gibbs_chain", f"WITH {chain_sql(5, SWEEPS, 1234)} SELECT * FROM b{SWEEPS}")
def _(spark, folder):
    chain = gibbs.Chain(spark, gibbs.Model(k=5, seed=1234)).start(corpus_of(spark, folder)).run(SWEEPS)
    return block_columns(chain.state(), 5)


def digamma_sql(x: str) -> str:
    """Recurrence and asymptotic series in plain SQL."""
    y = f"({x} + 6.0::DOUBLE)"
    steps = " + ".join(f"1.0::DOUBLE / ({x} + {i}.0::DOUBLE)" for i in range(6))
    v = f"(1.0::DOUBLE / ({y} * {y}))"
    series = f"{v} * ({1 / 12!r}::DOUBLE - {v} * ({1 / 120!r}::DOUBLE - {v} * {1 / 252!r}::DOUBLE))"
    return f"(ln({y}) - 0.5::DOUBLE / {y} - {series} - ({steps}))"


def variational_sql(k: int, passes: int, prior: float = 0.5) -> str:
    raw = ", ".join(f"{uniform('doc_id', 'word', quoted(str(i)), quoted('7'))} AS r{i}" for i in range(k))
    whole = " + ".join(f"r{i}" for i in range(k))
    out = f"""{CORPUS},
vr AS (SELECT doc_id, word, n, {raw} FROM corpus),
v0 AS (SELECT doc_id, word, n, {', '.join(f"r{i} / ({whole}) * n AS c{i}" for i in range(k))} FROM vr)"""
    for s in range(1, passes + 1):
        was = f"v{s - 1}"
        logs = ", ".join(
            f"{digamma_sql(f'(d{i} + {prior}::DOUBLE)')} + {digamma_sql(f'(w{i} + {prior}::DOUBLE)')}"
            f" - {digamma_sql(f'(t{i} + {prior}::DOUBLE * terms)')} AS l{i}" for i in range(k))
        top, sums = "greatest(" + ", ".join(f"l{i}" for i in range(k)) + ")", " + ".join(f"exp(l{i} - top)" for i in range(k))
        out += f""",
vd{s} AS (SELECT doc_id, {', '.join(f"sum(c{i}) AS d{i}" for i in range(k))} FROM {was} GROUP BY doc_id),
vw{s} AS (SELECT word, {', '.join(f"sum(c{i}) AS w{i}" for i in range(k))} FROM {was} GROUP BY word),
vt{s} AS (SELECT {', '.join(f"sum(w{i}) AS t{i}" for i in range(k))}, count(*) AS terms FROM vw{s}),
vl{s} AS (SELECT doc_id, word, n, {logs} FROM {was} JOIN vd{s} USING (doc_id) JOIN vw{s} USING (word), vt{s}),
vm{s} AS (SELECT *, {top} AS top FROM vl{s}),
v{s} AS (SELECT doc_id, word, n, {', '.join(f"exp(l{i} - top) / ({sums}) * n AS c{i}" for i in range(k))} FROM vm{s})"""
    return out


@query("m5_variational_model", f"WITH {variational_sql(2, PASSES)} SELECT doc_id, word, round(c0, 6) AS c0, round(c1, 6) AS c1 FROM v{PASSES}")
def _(spark, folder):
    state = variational.fit(written_corpus(spark, folder), variational.Settings(k=2), PASSES)
    return state.select("doc_id", "word", *[F.round(F.col("c")[i], 6).alias(f"c{i}") for i in range(2)])


ONLINE, UPDATES = variational.Online(), 3


def online_sql(k: int, updates: int, prior: float = 0.5) -> str:
    """CTEs of the first mini-batch updates: topic tables ``t0`` to ``t<updates>`` of ``(word, l0, ...)``."""
    cells, how = range(k), ONLINE
    out = f"""{CORPUS},
bt AS (SELECT *, {hash32('doc_id', quoted('batch'))} % {how.batches} AS batch FROM corpus),
docs AS (SELECT count(DISTINCT doc_id)::DOUBLE AS total FROM bt),
used AS (SELECT batch, row_number() OVER (ORDER BY batch) - 1 AS place, count(*) OVER () AS batches, docs
  FROM (SELECT batch, count(DISTINCT doc_id)::DOUBLE AS docs FROM bt GROUP BY batch)),
t0 AS (SELECT word, {', '.join(f"{uniform('word', quoted(str(i)), quoted('7'))} + 0.5::DOUBLE AS l{i}" for i in cells)} FROM (SELECT DISTINCT word FROM corpus))"""
    for s in range(updates):
        share = (how.delay + s) ** -how.decay
        out += f""",
sum{s} AS (SELECT {', '.join(f'sum(l{i}) AS a{i}' for i in cells)} FROM t{s}),
w{s} AS (SELECT word, {', '.join(f"exp({digamma_sql(f'l{i}')} - {digamma_sql(f'a{i}')}) AS w{i}" for i in cells)} FROM t{s}, sum{s}),
r{s}_0 AS (SELECT doc_id, {', '.join(f'{prior}::DOUBLE + sum(n) / {k}::DOUBLE AS s{i}' for i in cells)} FROM bt JOIN used USING (batch)
  WHERE place = {s} % batches GROUP BY doc_id)"""
        for r in range(how.rounds):
            whole = " + ".join(f"s{i}" for i in cells)
            raw = ", ".join(f"exp({digamma_sql(f's{i}')} - {digamma_sql(f'({whole})')}) * w{i} AS p{i}" for i in cells)
            total = " + ".join(f"p{i}" for i in cells)
            out += f""",
q{s}_{r} AS (SELECT doc_id, word, {', '.join(f'p{i} * (n / ({total})) AS p{i}' for i in cells)}
  FROM (SELECT doc_id, word, n, {raw} FROM bt JOIN r{s}_{r} USING (doc_id) JOIN w{s} USING (word))),
r{s}_{r + 1} AS (SELECT doc_id, {', '.join(f'{prior}::DOUBLE + sum(p{i}) AS s{i}' for i in cells)} FROM q{s}_{r} GROUP BY doc_id)"""
        out += f""",
f{s} AS (SELECT word, {', '.join(f'sum(p{i}) AS p{i}' for i in cells)} FROM q{s}_{how.rounds - 1} GROUP BY word),
t{s + 1} AS (SELECT word, {', '.join(f"{1.0 - share!r}::DOUBLE * l{i} + {share!r}::DOUBLE * ({prior}::DOUBLE + total / docs * coalesce(p{i}, 0)) AS l{i}" for i in cells)}
  FROM t{s} LEFT JOIN f{s} USING (word), docs, used WHERE place = {s} % batches)"""
    return out


@query("m5_online_updates", f"WITH {online_sql(2, UPDATES)} SELECT word, round(l0, 6) AS l0, round(l1, 6) AS l1 FROM t{UPDATES}")
def _(spark, folder):
    topics = variational.fit_online(written_corpus(spark, folder), variational.Settings(k=2), ONLINE, updates=UPDATES)
    return topics.select("word", *[F.round(F.col("l")[i], 6).alias(f"l{i}") for i in range(2)])


@query("m5_online")
def _(spark, folder):
    """All passes; its first updates are those of ``m5_online_updates``."""
    topics = variational.fit_online(written_corpus(spark, folder), variational.Settings(k=2), ONLINE, PASSES)
    return topics.select("word", *[F.round(F.col("l")[i], 6).alias(f"l{i}") for i in range(2)])


@query("w5_categorical_draw", f"""WITH {GAMMA}, l AS ({long_sql(K, 'g', 'doc_id', lambda i: f'g{i}', 'p')}),
c AS (SELECT doc_id, topic, sum(p) OVER (PARTITION BY doc_id ORDER BY topic) AS cum,
             sum(p) OVER (PARTITION BY doc_id) AS total, {uniform('doc_id', quoted('draw'))} AS u FROM l)
SELECT doc_id, least(count(*) FILTER (u * total >= cum), {K - 1})::INT AS topic FROM c GROUP BY doc_id""")
def _(spark, folder):
    bounds = draws.running_totals([F.col("g")[i] for i in range(K)])
    return gamma_after_sweep(spark, folder).select(
        "doc_id", draws.pick(draws.uniform(F.col("doc_id"), "draw"), bounds).alias("topic")
    )


# -- samples -----------------------------------------------------------------------------------------------------------

def stacked(sql, table: str, name: str, key: str) -> str:
    """Samples ``gs`` or ``bs``: one union member for each retained sweep and topic."""
    out = chain_sql(K, SWEEPS)
    for i in range(KEPT_FROM, SWEEPS + 1):
        out += f",\n{sql(f'b{i}', f'{table}{i}')}"
    rows = " UNION ALL ".join(
        long_sql(K, f"{table}{i}", f"{i} AS iter, {key}", lambda t: f"{'g' if key == 'doc_id' else 'p'}{t}", "value") for i in range(KEPT_FROM, SWEEPS + 1))
    return f"{out},\n{name} AS ({rows})"


GAMMA_SAMPLES = stacked(gamma_sql, "ga", "gs", "doc_id")
BETA_SAMPLES = stacked(beta_sql, "be", "bs", "word") + """,
top4 AS (SELECT word FROM corpus GROUP BY word ORDER BY sum(n) DESC, word LIMIT 4)"""


def sample_tables(spark, folder, keep_from=KEPT_FROM):
    """``(gamma, beta)`` samples of a chain's sweeps, long rows."""
    chain = gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder)).run(SWEEPS, keep_from=keep_from)
    return (
        chain.samples("gamma").select("iter", "doc_id", F.posexplode_outer("g").alias("topic", "value")),
        chain.samples("beta").select("iter", "word", F.posexplode_outer("b").alias("topic", "value")),
    )


def frequent_words(spark, folder, n=4):
    totals = corpus_of(spark, folder).groupBy("word").agg(F.sum("n").alias("n"))
    return totals.orderBy(F.desc("n"), "word").limit(n).select("word")


def frequent_series(spark, folder):
    """Beta samples of the four most frequent terms (four rows, broadcast)."""
    _, beta = sample_tables(spark, folder)
    return beta.join(F.broadcast(frequent_words(spark, folder)), "word", "left_semi")


@query("s5_samples_saved", f"""WITH {GAMMA_SAMPLES}
SELECT iter::INT AS iter, doc_id, topic, round(value, 9) AS value FROM gs WHERE iter >= {KEPT_FROM}""")
def _(spark, folder):
    path = scratch_path(spark, "samples")
    gamma, _ = sample_tables(spark, folder, keep_from=1)
    store.append_window(gamma, path)
    return store.read_samples(spark, path, first=KEPT_FROM).withColumn("value", F.round("value", 9))


@query("s6_state_saved", f"WITH {START} SELECT * FROM b0")
def _(spark, folder):
    state = start_state(spark, folder)
    return block_columns(store.save(state, scratch_path(spark, "state")))


@query("s8_window_flush", f"""WITH {GAMMA_SAMPLES}
SELECT iter::INT AS iter, count(*)::BIGINT AS rows, round(sum(value), 4) AS total FROM gs GROUP BY iter""")
def _(spark, folder):
    path = scratch_path(spark, "samples")
    gamma = materialize(sample_tables(spark, folder)[0], "samples")
    for first in range(KEPT_FROM, SWEEPS + 1, 2):
        store.append_window(gamma.where(F.col("iter").between(first, first + 1)), path)
    return store.read_samples(spark, path).groupBy("iter").agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total")
    )


@query("p14_burn_in", f"""WITH {BETA_SAMPLES}
SELECT iter::INT AS iter, topic, count(*)::BIGINT AS terms, round(sum(value), 6) AS total FROM bs WHERE iter BETWEEN {KEPT_FROM} AND {SWEEPS} GROUP BY ALL""")
def _(spark, folder):
    kept = diagnostics.retained(sample_tables(spark, folder, keep_from=1)[1], KEPT_FROM, SWEEPS)
    return kept.groupBy("iter", "topic").agg(
        F.count("*").alias("terms"), F.round(F.sum("value"), 6).alias("total")
    )


@query("a12_posterior_mean", f"""WITH {BETA_SAMPLES}
SELECT word, topic, round(avg(value), 9) AS mean, count(*)::BIGINT AS sweeps FROM bs WHERE iter >= {KEPT_FROM} GROUP BY word, topic""")
def _(spark, folder):
    means = diagnostics.posterior_mean(diagnostics.retained(sample_tables(spark, folder)[1], KEPT_FROM), "word", "topic")
    return means.withColumn("mean", F.round("mean", 9))


@query("w3_trace", f"""WITH {BETA_SAMPLES}
SELECT word, topic, iter::INT AS iter, round(value, 9) AS value,
  round(avg(value) OVER (PARTITION BY word, topic ORDER BY iter ROWS UNBOUNDED PRECEDING), 9) AS running_mean
FROM bs WHERE word IN (SELECT word FROM top4)""")
def _(spark, folder):
    rows = diagnostics.trace(frequent_series(spark, folder), "word", "topic")
    return rows.select(
        "word", "topic", "iter", F.round("value", 9).alias("value"), F.round("running_mean", 9).alias("running_mean")
    )


@query("w4_autocorrelation", f"""WITH {BETA_SAMPLES},
x AS (SELECT word, topic, iter, value - avg(value) OVER (PARTITION BY word, topic) AS x FROM bs),
v AS (SELECT word, topic, sum(x * x) AS c0 FROM x GROUP BY word, topic HAVING sum(x * x) > 0),
l AS (SELECT unnest(range(0, {LAGS + 1})) AS lag),
q AS (SELECT a.word, a.topic, l.lag, sum(a.x * b.x) AS c FROM x a, l, x b
      WHERE b.word = a.word AND b.topic = a.topic AND b.iter = a.iter - l.lag GROUP BY ALL)
SELECT word, topic, lag::INT AS lag, round(c / c0, 6) AS acf FROM q JOIN v USING (word, topic)""")
def _(spark, folder):
    rows = diagnostics.autocorrelation(sample_tables(spark, folder)[1], LAGS, "word", "topic")
    return rows.withColumn("acf", F.round("acf", 6))


WINDOW = 5


def running_moments(spark, folder):
    """Moments of all retained samples, merged by windows; only the samples of a window are there at a time."""
    chain = gibbs.Chain(spark, MODEL).start(corpus_of(spark, folder)).run(KEPT_FROM - 1)
    held = moments.Moments(spark, "word", "b", LAGS)
    while chain.sweep < SWEEPS:
        chain.run(WINDOW, keep_from=chain.sweep + 1)
        held.add(chain.samples("beta").where(F.col("iter") > chain.sweep - WINDOW))
    return held


@query("a12_running", f"""WITH {BETA_SAMPLES}
SELECT word, topic, round(avg(value), 9) AS mean, count(*)::BIGINT AS sweeps FROM bs WHERE iter >= {KEPT_FROM} GROUP BY word, topic""")
def _(spark, folder):
    return running_moments(spark, folder).mean().withColumn("mean", F.round("mean", 9))


@query("w4_running", ORACLES["w4_autocorrelation"])
def _(spark, folder):
    return running_moments(spark, folder).autocorrelation().withColumn("acf", F.round("acf", 6))


@query("a28_exact_quantiles", f"""WITH {GAMMA_SAMPLES},
p AS (SELECT unnest([0.03, 0.5, 0.97]::DOUBLE[]) AS prob)
SELECT topic, 0.03::DOUBLE AS prob, round(quantile_cont(value, 0.03), 9) AS quantile FROM gs GROUP BY topic
UNION ALL SELECT topic, 0.5::DOUBLE, round(quantile_cont(value, 0.5), 9) FROM gs GROUP BY topic
UNION ALL SELECT topic, 0.97::DOUBLE, round(quantile_cont(value, 0.97), 9) FROM gs GROUP BY topic""")
def _(spark, folder):
    gamma, _ = sample_tables(spark, folder)
    rows = diagnostics.quantiles(gamma, "value", [0.03, 0.5, 0.97], ["topic"])
    return rows.withColumn("quantile", F.round("quantile", 9))


# -- terms of a topic --------------------------------------------------------------------------------------------------

def long_beta(spark, folder):
    return topic_counts.tidy(beta_after_sweep(spark, folder), "word", "b", "beta")


LONG_BETA = BETA + ", lb AS (" + long_sql(K, "beta", "word", lambda i: f"p{i}", "beta") + ")"


@query("w1_top_terms_with_ties", f"""WITH {LONG_BETA},
r AS (SELECT *, rank() OVER (PARTITION BY topic ORDER BY beta DESC) AS rk FROM lb)
SELECT topic, word, round(beta, 9) AS beta FROM r WHERE rk <= 15""")
def _(spark, folder):
    rows = ranking.top_with_ties(long_beta(spark, folder), 15, "topic", "beta")
    return rows.select("topic", "word", F.round("beta", 9).alias("beta"))


@query("o1_sorted_terms", f"WITH {LONG_BETA} SELECT topic, word, round(beta, 9) AS beta FROM lb ORDER BY topic, beta DESC, word")
def _(spark, folder):
    return ranking.sorted_terms(long_beta(spark, folder)).select("topic", "word", F.round("beta", 9).alias("beta"))


@query("o2_top_terms_strict", f"""WITH {LONG_BETA},
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY beta DESC, word) AS place FROM lb)
SELECT topic, place::INT AS place, word, round(beta, 9) AS beta FROM r WHERE place <= 20""")
def _(spark, folder):
    rows = ranking.top_strict(long_beta(spark, folder), 20, "topic", "beta")
    return rows.select("topic", "place", "word", F.round("beta", 9).alias("beta"))


@query("s11_saved_top_terms", f"""WITH {LONG_BETA},
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY beta DESC, word) AS place FROM lb)
SELECT topic, word AS term, round(beta, 9) AS beta FROM r WHERE place <= 10""")
def _(spark, folder):
    rows = ranking.top_strict(long_beta(spark, folder), 10, "topic", "beta")
    return store.save(
        rows.select("topic", F.col("word").alias("term"), F.round("beta", 9).alias("beta")), scratch_path(spark, "top")
    )


@query("u2_append_topic_tables", f"""WITH {LONG_BETA},
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY beta DESC, word) AS place FROM lb)
SELECT topic, word, round(beta, 9) AS beta FROM r WHERE place <= 5""")
def _(spark, folder):
    rows = materialize(long_beta(spark, folder), "beta")
    out = None
    for i in range(K):
        one = rows.where(F.col("topic") == i).orderBy(F.desc("beta"), "word").limit(5)
        out = one if out is None else out.unionByName(one)
    return out.select("topic", "word", F.round("beta", 9).alias("beta"))
