"""Registry of checkable queries and the SQL fragments their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from topicweave.functions import lexicon

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query ``f(spark, folder)``; ``oracle`` is the same result in portable SQL."""
    def keep(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


WORDS = f"regexp_extract_all(lower(text), {quoted(lexicon.WORD_PATTERN)})"
STOP = in_list(lexicon.stop_word_list())

# headline, description and category of each document
ARTICLES = """articles AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS headline,
         CASE WHEN strpos(text, chr(10)) = 0 THEN '' ELSE substr(text, strpos(text, chr(10)) + 1) END AS description,
         lang AS category
  FROM documents)"""

# term counts without stop words
TERM_COUNTS = f"""toks AS (
  SELECT doc_id, unnest({WORDS}) AS word FROM documents),
tc AS (
  SELECT doc_id, word, count(*)::BIGINT AS n FROM toks WHERE word NOT IN {STOP} GROUP BY doc_id, word)"""

# documents with more than 10 terms, then terms in more than one document
CORPUS = TERM_COUNTS + """,
long_docs AS (SELECT doc_id FROM tc GROUP BY doc_id HAVING count(*) > 10),
tc1 AS (SELECT tc.* FROM tc JOIN long_docs USING (doc_id)),
kept_words AS (SELECT word FROM tc1 GROUP BY word HAVING count(*) > 1),
corpus AS (SELECT tc1.* FROM tc1 JOIN kept_words USING (word))"""


def hash32(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def uniform(*parts: str) -> str:
    return f"(({hash32(*parts)})::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE"


def plural_case(word: str) -> str:
    """Overrides and suffix rules as one CASE."""
    arms = [f"WHEN {word} = {quoted(a)} THEN {quoted(b)}" for a, b in lexicon.WORD_OVERRIDES.items()]
    for pattern, replacement in lexicon.PLURAL_RULES:
        fixed = word if replacement is None else (
            f"regexp_replace({word}, {quoted(pattern)}, {quoted(replacement.replace('$', chr(92)))})"
        )
        arms.append(f"WHEN regexp_matches({word}, {quoted(pattern)}) THEN {fixed}")
    return "CASE " + " ".join(arms) + f" ELSE {word} END"


def tokens_sql(k: int, seed: str, counts: str = "corpus") -> str:
    """CTE ``z0(doc_id, word, rep, z)``: hashed starting topics."""
    return f"""copies AS (SELECT doc_id, word, n, unnest(range(1, n + 1)) AS rep FROM {counts}),
z0 AS (SELECT doc_id, word, n, rep, (({hash32('doc_id', 'word', 'rep', quoted(seed))}) % {k})::INT AS z FROM copies)"""


def blocks_sql(k: int, source: str, name: str) -> str:
    """CTE of block counts ``(doc_id, word, n, c0..)`` from tokens."""
    cells = ", ".join(f"count(*) FILTER (z = {i})::BIGINT AS c{i}" for i in range(k))
    return f"{name} AS (SELECT doc_id, word, count(*)::BIGINT AS n, {cells} FROM {source} GROUP BY doc_id, word)"


def sweep_sql(k: int, source: str, tag: str, sweep: int, seed: int = 7, a: float = 0.1, b: float = 0.1) -> str:
    """CTEs of one block sweep over ``source(doc_id, word, n, c0..)``: weights ``p_tag`` and tokens ``z_tag``."""
    own = [f"c{i}" for i in range(k)]
    return _sweep(k, source, tag, sweep, seed, a, b, own, "n",
                  f"SELECT *, unnest(range(1, n + 1)) AS rep FROM b_{tag}")


def token_sweep_sql(k: int, source: str, tag: str, sweep: int, seed: int = 7, a: float = 0.1, b: float = 0.1) -> str:
    """The same over tokens ``(doc_id, word, rep, z)``."""
    own = [f"(z = {i})::BIGINT" for i in range(k)]
    return _sweep(k, source, tag, sweep, seed, a, b, own, "rep", f"SELECT * FROM b_{tag}")


def _sweep(k, source, tag, sweep, seed, a, b, own, extra, rows) -> str:
    d = ", ".join(f"sum({o})::BIGINT AS d{i}" for i, o in enumerate(own))
    w = ", ".join(f"sum({o})::BIGINT AS w{i}" for i, o in enumerate(own))
    t = ", ".join(f"sum(w{i})::BIGINT AS t{i}" for i in range(k))
    weights = ", ".join(
        f"(d{i} - {o} + {a}::DOUBLE) * (w{i} - {o} + {b}::DOUBLE) / (t{i} - {o} + {b}::DOUBLE * terms) AS p{i}"
        for i, o in enumerate(own)
    )
    doc_n = " + ".join(f"d{i}" for i in range(k))
    bounds, sofar = [], ""
    for i in range(k):
        sofar = f"p{i}" if i == 0 else f"({sofar} + p{i})"
        bounds.append(f"{sofar} AS b{i}")
    u = uniform("doc_id", "word", "rep", quoted(f"{seed}.{sweep}"))
    hits = " + ".join(f"(u * b{k - 1} >= b{i})::INT" for i in range(k - 1))
    return f"""nd_{tag} AS (SELECT doc_id, {d} FROM {source} GROUP BY doc_id),
nw_{tag} AS (SELECT word, {w} FROM {source} GROUP BY word),
nk_{tag} AS (SELECT {t}, count(*)::BIGINT AS terms FROM nw_{tag}),
p_{tag} AS (SELECT doc_id, word, {extra}, {doc_n} AS doc_n, {weights}
  FROM {source} JOIN nd_{tag} USING (doc_id) JOIN nw_{tag} USING (word), nk_{tag}),
b_{tag} AS (SELECT *, {', '.join(bounds)} FROM p_{tag}),
u_{tag} AS (SELECT *, {u} AS u FROM ({rows})),
z_{tag} AS (SELECT doc_id, word, rep, {hits} AS z FROM u_{tag})"""


def long_sql(k: int, source: str, key: str, cell, value: str, keep: str = "") -> str:
    """Union of one select per topic: wide columns to rows."""
    return " UNION ALL ".join(
        f"SELECT {key}, {i} AS topic, {cell(i)} AS {value}{keep} FROM {source}" for i in range(k)
    )
