from pyspark.sql import functions as F

from topicweave.functions import draws, text, vectors
from topicweave.operators import cleaning


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("x")).first()["x"]


def test_words_keep_inner_apostrophes(spark):
    assert one(spark, "Don't stop -- l’eau, 'quoted' x_y!", text.words) == ["don't", "stop", "l’eau", "quoted", "x", "y"]


def test_word_char_runs_keep_underscore(spark):
    assert one(spark, "Don't x_y", text.word_char_runs) == ["don", "t", "x_y"]


def test_possessives_in_order(spark):
    assert one(spark, "the dog's bone, cats's", text.strip_possessives) == "the dog bone, cats"


def test_sentences_and_sections(spark):
    assert one(spark, "One two. Three! Four", text.sentences) == ["one two", "three", "four"]
    assert one(spark, "Chapter 1 a Chapter 2 b", text.split_on(r"chapter \d")) == [" a ", " b"]


def test_ngrams_and_shingles(spark):
    assert one(spark, "a b c", text.ngrams(2)) == ["a b", "b c"]
    assert one(spark, "a b c d", text.ngrams(3)) == ["a b c", "b c d"]
    assert one(spark, "a", text.ngrams(2)) == []
    assert one(spark, "Ab, cde", text.char_shingles(4)) == ["abcd", "bcde"]
    assert one(spark, "ab", text.char_shingles(4)) == []


def test_html(spark):
    assert one(spark, "<h1>Text <b>is</b>", lambda c: text.words(text.html_text(c))) == ["text", "is"]
    page = "<script>var x='</p>';</script><a href='e.com'>here</a> &amp; <!-- no --> now"
    assert one(spark, page, lambda c: text.words(text.html_text(c))) == ["here", "now"]


def test_plural_rules(spark):
    cases = {
        "cats": "cat", "cities": "city", "churches": "church", "religious": "religious", "class": "class", "bus": "bus",
        "women": "woman", "polouse": "police", "gas": "gas", "analysis": "analysis", "boxes": "box",
    }
    rows = spark.createDataFrame([(w,) for w in cases], "w string").select("w", text.normalize_word(F.col("w")).alias("n"))
    assert {r["w"]: r["n"] for r in rows.collect()} == cases


def test_integers_and_quotes(spark):
    assert one(spark, "42", text.is_integer) is True
    assert one(spark, "042", text.is_integer) is False
    assert one(spark, "4x", text.is_integer) is False
    assert one(spark, '"CRIME"\n', text.unquote) == "CRIME"


def test_first_line(spark):
    assert one(spark, "head\nbody\nmore", text.first_line) == "head"
    assert one(spark, "head\nbody\nmore", text.after_first_line) == "body\nmore"
    assert one(spark, "head", text.after_first_line) == ""


def test_custom_tokenizer(spark):
    df = spark.createDataFrame([(1, "a-b-c")], "doc_id bigint, text string")
    rows = cleaning.token_rows(df, lambda c: F.split(c, "-"), position=True).collect()
    assert [(r["pos"], r["word"]) for r in rows] == [(0, "a"), (1, "b"), (2, "c")]


def test_field_rows_and_recode(spark):
    df = spark.createDataFrame([(1, "h's x", "d", "THE WORLDPOST")], "doc_id bigint, headline string, description string, category string")
    recoded = cleaning.recode_category(df, {"THE WORLDPOST": "WORLDPOST"})
    rows = cleaning.field_rows(cleaning.clean_fields(recoded)).collect()
    assert {(r["doc_indicator"], r["text"], r["category"]) for r in rows} == {
        ("1_desp", "d", "WORLDPOST"), ("1_hdl", "h x", "WORLDPOST")
    }


def test_pick_and_uniform(spark):
    df = spark.range(2000).select(draws.uniform(F.col("id"), "s").alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < low and high < 1 and abs(mean - 0.5) < 0.03
    bounds = [F.lit(0.2), F.lit(0.5), F.lit(1.0)]
    got = [spark.range(1).select(draws.pick(F.lit(u), bounds)).first()[0] for u in (0.1, 0.2, 0.49, 0.5, 0.99)]
    assert got == [0, 1, 1, 2, 2]


def test_digamma(spark):
    known = {0.1: -10.423754940411076, 1.0: -0.5772156649015329, 5.5: 1.6110931485817512}
    for x, want in known.items():
        assert abs(spark.range(1).select(vectors.digamma(F.lit(x))).first()[0] - want) < 1e-7


def test_markup_of_real_pages(spark):
    page = (
        """<!DOCTYPE html><!-- a > b <p>no</p> --><a title="x > y" href='z>"'>one</a><SCRIPT type="a">if (1 < 2) { "</p>" }</SCRIPT>"""
        """<style>p > b {}</style> it&#8217;s &#x1F600;&#X41;&#66; &amp;#65; &#0;&#99999999;&#xD800; 1 < 2 &copy; &amp;lt; <br/ >end<""")
    got = one(spark, page, text.html_text)
    assert " ".join(got.split()) == "one it’s \U0001f600AB &#65; &#0;&#99999999;&#xD800; 1 < 2 © &lt; end<"
    assert one(spark, "<a " + "b='c' " * 50_000 + ">x", text.html_text).strip() == "x"
    assert one(spark, "", text.html_text) == ""
