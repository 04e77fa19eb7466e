import os
import time

from pyspark.sql import functions as F

from conftest import SF
from topicweave.operators import corpus, skew
from topicweave.plans import clean
from topicweave.session import CLEANED, materialize, remove_table, scratch_path, write_table
from topicweave.sources import articles, samples, triplets
from topicweave.sources.lines import numbered_lines
from topicweave.sources.tables import table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_row_level_length_rule_equals_table_rule(spark):
    docs = table(spark, SF, "documents")
    slow = corpus.keep_long_documents(clean.term_counts(docs)).select("doc_id", "word", "n")
    assert rows(clean.term_counts(docs, min_terms=10)) == rows(slow)


def test_lookup_with_hot_key(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400).alias("key"), F.col("id").alias("spread")
    )
    dim = facts.select("key").distinct().where("key <> 5").withColumn("value", F.col("key") * 10)
    hot = skew.hot_keys(skew.key_sizes(facts, "key"), "key", share=0.01)
    pieces = {r["key"]: r["pieces"] for r in hot.collect()}
    assert pieces[7] > 30 and sum(pieces.values()) <= 200
    got = skew.lookup(facts, dim, "key", "spread", share=0.01).select("key", "spread", "value")
    assert rows(got) == rows(facts.join(dim, "key").select("key", "spread", "value"))
    for how in ("left_semi", "left_anti"):
        got = skew.lookup(facts, dim.select("key"), "key", "spread", how=how, share=0.01).select("key", "spread")
        assert rows(got) == rows(facts.join(dim, "key", how).select("key", "spread"))


def test_no_rare_terms_keeps_everything(spark, toy):
    assert rows(corpus.drop_rare_terms(toy, at_most=0).select("doc_id", "word", "n")) == rows(toy)


def test_term_map_and_merge(spark):
    counts = spark.createDataFrame([(1, "cats", 2), (1, "cat", 3), (2, "dogs", 1)], "doc_id bigint, word string, n bigint")
    mapped = corpus.apply_term_map(counts, corpus.term_map(counts))
    assert rows(corpus.merge_counts(mapped)) == [(1, "cat", 5), (2, "dog", 1)]
    assert rows(corpus.normalized_counts(counts)) == [(1, "cat", 5), (2, "dog", 1)]
    check = corpus.merge_integrity(mapped, corpus.merge_counts(mapped)).first()
    assert (check["before_rows"], check["after_rows"], check["before_tokens"], check["after_tokens"]) == (3, 2, 6, 6)


def test_dense_ids_are_dense_and_stable(spark, toy):
    ids = corpus.dense_ids(toy, "word", "i")
    assert sorted(r["i"] for r in ids.collect()) == [0, 1, 2, 3, 4]
    assert rows(ids) == rows(corpus.dense_ids(toy.repartition(3), "word", "i"))


def test_triplet_text_round_trip(spark, toy):
    docs, terms = corpus.dense_ids(toy, "doc_id", "doc_idx"), corpus.dense_ids(toy, "word", "term_idx")
    dtm = corpus.document_term_matrix(toy, docs, terms)
    path = scratch_path(spark, "t")
    triplets.write_text(dtm.repartition(4), docs, terms, path)
    assert rows(triplets.read_text(spark, path)) == rows(toy)
    triplets.write_tables(dtm, docs, terms, path + "p")
    assert rows(triplets.read_tables(spark, path + "p")) == rows(toy)


def test_numbered_lines_over_splits(spark):
    path = scratch_path(spark, "lines")
    spark.range(5000).select(F.format_string("line %05d", "id").alias("v")).repartitionByRange(3, "v").sortWithinPartitions("v").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = numbered_lines(spark, path)
        assert got.rdd.getNumPartitions() >= 1
        bad = got.where(F.col("value") != F.format_string("line %05d", "at")).count()
        assert got.count() == 5000 and bad == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_articles_round_trip(spark):
    df = spark.createDataFrame([(0, "h", "d", "c"), (1, 'q"x', "", "c2")], "doc_id bigint, headline string, description string, category string")
    path = scratch_path(spark, "a")
    articles.write_articles(df, path)
    assert rows(articles.read_articles(spark, path)) == rows(df)


def test_trace_round_trip(spark):
    df = spark.createDataFrame(
        [(r, s, [0.1 * s, 0.2, -0.3, 1e-7], 10.0 - s + r) for r in (3, 12) for s in range(4)],
        "run int, step int, eta array<double>, loss double",
    )
    path = scratch_path(spark, "trace")
    samples.write_trace(df, path, 2)
    got = samples.read_trace(spark, path)
    assert sorted((r["run"], r["step"], tuple(r["eta"]), r["loss"]) for r in got.collect()) == sorted(
        (r["run"], r["step"], tuple(r["eta"]), r["loss"]) for r in df.collect()
    )


def test_class_ids_of_values_with_one_beginning(spark):
    from topicweave.operators import corpus

    values = [f"src{i}" for i in range(300)] + ["", "é", "src", "z"]
    rows = spark.createDataFrame([(v,) for v in values * 2], "category string").repartition(5)
    got = {r["category"]: r["y"] for r in corpus.class_ids(rows).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values, key=lambda v: v.encode()))}


def test_article_flow_keeps_recoded_categories(spark):
    from topicweave.plans import clean

    words = [f"term{i}" for i in range(12)]
    rows = [(1, "Term0's cats " + " ".join(words), "", "A"), (2, "", " ".join(words) + " cats cat", "ARTS & CULTURE"), (3, "short", "text", "A"),
            (4, " ".join(words), "gone", "A")]
    articles = spark.createDataFrame(rows, "doc_id bigint, headline string, description string, category string")
    got = {(r["doc_id"], r["word"]): (r["category"], r["n"]) for r in clean.article_counts(articles, bad_ids=[4]).collect()}
    assert {d for d, _ in got} == {1, 2} and got[1, "term0"] == ("A", 2) and got[2, "cat"] == ("ARTS", 1) and got[1, "cat"] == ("A", 1)
    assert len(got) == 26


def test_rare_terms_go_without_sorting_the_counts(spark):
    counts = spark.createDataFrame([(d, w, 1) for d in range(40) for w in (f"own{d}", f"pair{d // 2}", "all")], "doc_id bigint, word string, n bigint")
    kept = corpus.drop_rare_terms(counts)
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted({r["word"] for r in kept.collect()}) == sorted({"all", *(f"pair{i}" for i in range(20))}) and kept.count() == 80


def test_filtered_counts_move_once(spark):
    """Rare terms leave where the counts are; rows without id are one document, and rows that share an id another."""
    words = " ".join(f"w{i}" for i in range(12))
    texts = [(1, f"{words} mine mine"), (1, f"{words} twice"), (1, f"{words} twice"), (2, f"{words} both"), (None, f"{words} both nobody"),
             (None, f"{words} nobody"), (0, f"{words} zero"), (None, f"{words} zero"), (3, None), (4, "short text")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    kept = clean.filtered_counts(docs)
    want = corpus.drop_rare_terms(clean.term_counts(docs, 10)).select("doc_id", "word", "n")
    assert sorted(map(str, kept.select("doc_id", "word", "n").collect())) == sorted(map(str, want.collect()))
    assert {r["word"] for r in kept.collect()} == {*words.split(), "both", "zero"}
    named = docs.where("doc_id is not null").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert clean.filtered_counts(named).where("doc_id = 'd1' and word = 'w1'").first()["n"] == 3
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")
    # the counting, which terms and counts share, the terms, and the rare rows: no other shuffle of counts
    assert "ReusedExchange" in plan[0] and plan[2].count("Exchange hashpartitioning") == 4 and "SortMergeJoin" not in plan[2]


def test_written_tables_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    rows = spark.range(5000).withColumn("k", F.col("id") % 700).groupBy("k").agg(F.count("*").alias("n")).repartition(3, "n")
    before, path = shuffled(), scratch_path(spark, "left")
    found = materialize(rows, "left")
    write_table(rows, path, by=("n",))
    until = time.time() + 20  # they go in the background
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(CLEANED, None) is None
    assert found.count() == 700 and sorted(r["n"] for r in spark.read.parquet(path).select("n").distinct().collect()) == [7, 8]
    remove_table(spark, path)
    assert not os.path.exists(path)
