import re
from collections import Counter

import corpus_pipeline
import pytest
from llm_fixtures import SF, clashing, empty, labels, odd, workers_find_the_package  # noqa: F401
from test_dedup import brute_components
from test_text_rules import counts

import __spark_entry__ as entry
from topicweave.llm import queries


def test_everything_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES[name])
    columns, rows = sorted(want.columns), want.fetchall()
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    wanted = sorted(tuple(str(r[want.columns.index(c)]) for c in columns) for r in rows)
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == wanted


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen[name] = docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
    quality = {r["doc_id"] for r in seen["quality_rules"]}
    base = {i for i, r in left.items() if counts(r["text"])[0] >= 50 and 2 * counts(r["text"])[4] <= counts(r["text"])[0]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert quality <= base and {i for i in base if labels.get(i) == 1} <= quality
    last = {}
    for i in sorted(quality):
        last[left[i]["text"]] = i
    assert {r["doc_id"] for r in seen["exact_dedup"]} == set(last.values())
    near = brute_components([(i, left[i]["text"]) for i in last.values()])
    assert {r["doc_id"] for r in seen["ngram_jaccard_join"]} == {i for i, (_, c) in near.items() if i == c}
    times = Counter(r["doc_id"] for r in seen["mixing"])
    assert set(times) <= {r["doc_id"] for r in seen["ngram_jaccard_join"]} and max(times.values()) <= 2
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", left[i]["text"])) for i in times}
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in seen["ngram_jaccard_join"])
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * total) < 0.02 * total
    assert Counter(r["doc_id"] for r in seen["byte_bpe"]) == times


def stages(spark, docs, folder):
    """Rows ``(doc_id, text)`` that each stage but the last leaves, and the numbers of ids of the last."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        out[name] = [tuple(r)[:2] for r in docs.collect()] if name != "byte_bpe" else docs.count()
    return out


def brute_stages(rows, kept):
    """What quality rules, exact dedup and the near-duplicate join leave of ``(doc_id, text)``; ``kept`` says what the learned rules keep."""
    quality = [(i, t) for i, t in rows if kept(t) and counts(t)[0] >= 50 and 2 * counts(t)[4] <= counts(t)[0]]
    last = {}
    for i, t in quality:
        if t not in last or last[t] is None or (i is not None and i > last[t]):
            last[t] = i
    several = {i for i, n in Counter(last.values()).items() if i is None or n > 1}
    own, number = {}, 1 << 40
    for t, i in last.items():
        number += 1
        own[number if i in several else i] = t
    near = brute_components(sorted(own.items()))
    families = {}
    for i, (_, c) in near.items():
        families.setdefault(c, []).append((i, own[i]))
    return quality, last, families


def test_stages_on_odd_tables(spark, odd, clashing, empty, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    quality, last, families = brute_stages(rows, lambda t: True)
    for docs in (odd, clashing):
        got = stages(spark, docs, str(tmp_path))
        assert sorted(got["quality_rules"], key=str) == sorted(quality, key=str)
        assert sorted(got["exact_dedup"], key=str) == sorted(((i, t) for t, i in last.items()), key=str)
        kept = {t for _, t in got["ngram_jaccard_join"]}
        assert len(kept) == len(families) and all(len(kept & {t for _, t in f}) == 1 for f in families.values())
        assert {c for c in families if c < 1 << 40} <= {i for i, _ in got["ngram_jaccard_join"]}
        assert {t for _, t in got["mixing"]} <= kept and got["byte_bpe"] == len(got["mixing"])
    columns = clashing.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, str(tmp_path)).columns == columns
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_clean_rows_without_or_with_shared_ids_stay(spark, labels, tmp_path):
    """A rejected row never takes along others that have its id, or no id either; nor does a near copy."""
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    text = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def table(*pairs):
        return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], schema)

    judged = corpus_pipeline.keep_quality(spark, table((None, "short"), (None, text[0]), (7, "short"), (7, text[1]), (8, text[2])), str(tmp_path))
    assert sorted([(r[0], r[1]) for r in judged.collect()], key=str) == sorted([(None, text[0]), (7, text[1]), (8, text[2])], key=str)
    near = table((3, text[0]), (5, text[0] + " more"), (5, text[1]), (None, text[2]), (None, text[2] + " more"), (None, text[3]), (9, text[4]))
    left = [(r[0], r[1]) for r in corpus_pipeline.drop_near_copies(spark, near, str(tmp_path)).collect()]
    assert {t for _, t in left} - {text[2] + " more"} >= {text[0], text[1], text[3], text[4]} and len(left) == 5
    assert (3, text[0]) in left and (5, text[1]) in left and sum(i is None for i, _ in left) == 2
