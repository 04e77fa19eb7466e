"""Checkable queries: reading, filtering, tokenising, counting."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicweave.catalog.base import ARTICLES, CORPUS, STOP, TERM_COUNTS, WORDS, plural_case, query, quoted
from topicweave.functions import lexicon, text
from topicweave.operators import cleaning, corpus, skew
from topicweave.plans import clean
from topicweave.session import materialize, scratch_path
from topicweave.sources import articles as article_source
from topicweave.sources import samples as sample_source
from topicweave.sources import triplets
from topicweave.sources.tables import articles, table

BAD_IDS = (3, 17, 42, 199, 500, 731) + lexicon.BAD_ARTICLE_POSITIONS
SOURCE_RECODES = {"src0": "src1", "src19": "src18"}


def documents(spark, folder):
    return table(spark, folder, "documents")


def counts_of(spark, folder):
    return clean.term_counts(documents(spark, folder))


def corpus_of(spark, folder):
    return clean.filtered_counts(documents(spark, folder))


FLOW_RECODES = {"fr": "romance", "es": "romance"}


def _stripped(column: str) -> str:
    return f"replace(replace({column}, {quoted("'s" + ' ')}, ' '), {quoted("'s")}, '')"


@query("e1_article_flow", f"""WITH {ARTICLES},
usable AS (SELECT doc_id, CASE category WHEN 'fr' THEN 'romance' WHEN 'es' THEN 'romance' ELSE category END AS category,
  {_stripped('headline')} || chr(10) || {_stripped('description')} AS text
  FROM articles WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)),
{CORPUS.replace('FROM documents', 'FROM usable')}
SELECT doc_id, category, word, sum(n)::BIGINT AS n FROM (SELECT doc_id, category, {plural_case('word')} AS word, n FROM corpus JOIN usable USING (doc_id))
GROUP BY doc_id, category, word""")
def _(spark, folder):
    unusable = table(spark, folder, "labels").where("quality = 0").select("doc_id")
    return clean.article_counts(articles(spark, folder), FLOW_RECODES, unusable)


# -- sources and sinks -------------------------------------------------------------------------------------------------

@query("s1_ndjson_scan", f"WITH {ARTICLES} SELECT doc_id, headline, description, category FROM articles")
def _(spark, folder):
    path = scratch_path(spark, "ndjson")
    article_source.write_articles(articles(spark, folder), path)
    return article_source.read_articles(spark, path)


@query("s1_ndjson_by_position", f"""WITH {ARTICLES}
SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_id, headline, description, category FROM articles""")
def _(spark, folder):
    path = scratch_path(spark, "ndjson")
    article_source.write_articles(articles(spark, folder).orderBy("doc_id").drop("doc_id"), path)
    return article_source.read_articles_by_position(spark, path)


def _matrix(spark, folder):
    """Matrix and dimension tables over counts; all but the matrix are written once."""
    counts = materialize(corpus_of(spark, folder), "counts")
    docs = materialize(corpus.dense_ids(counts, "doc_id", "doc_idx"), "docs")
    terms = materialize(corpus.dense_ids(counts, "word", "term_idx"), "terms")
    return corpus.document_term_matrix(counts, docs, terms), docs, terms


DENSE = CORPUS + """,
docs AS (SELECT doc_id, (row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1)::BIGINT AS doc_idx
         FROM (SELECT DISTINCT doc_id FROM corpus)),
terms AS (SELECT word, (row_number() OVER (ORDER BY md5(word), word) - 1)::BIGINT AS term_idx
          FROM (SELECT DISTINCT word FROM corpus))"""


@query("s2_triplet_text_import", f"WITH {CORPUS} SELECT doc_id, word, n FROM corpus")
def _(spark, folder):
    path = scratch_path(spark, "triplets")
    triplets.write_text(*[materialize(df, "dtm") for df in _matrix(spark, folder)], path)
    return triplets.read_text(spark, path)


@query("s3_triplet_export", f"""WITH {DENSE}
SELECT doc_idx, term_idx, n FROM corpus JOIN docs USING (doc_id) JOIN terms USING (word)""")
def _(spark, folder):
    path = scratch_path(spark, "dtm")
    triplets.write_tables(*_matrix(spark, folder), path)
    return spark.read.parquet(f"{path}/dtm")


@query("s3_triplet_tables", f"WITH {CORPUS} SELECT doc_id, word, n FROM corpus")
def _(spark, folder):
    path = scratch_path(spark, "dtm")
    triplets.write_tables(*_matrix(spark, folder), path)
    return triplets.read_tables(spark, path)


@query("s4_label_import", "SELECT doc_id, lang AS category FROM documents")
def _(spark, folder):
    path = scratch_path(spark, "labels")
    ordered = documents(spark, folder).orderBy("doc_id")
    ordered.select(F.concat(F.lit('"'), F.col("lang"), F.lit('"')).alias("value")).write.text(f"{path}/category")
    ordered.select(F.col("doc_id").cast("string").alias("value")).write.text(f"{path}/docs")
    return article_source.read_labels(spark, f"{path}/category", f"{path}/docs")


@query("s7_counts_saved", f"""WITH {CORPUS},
normed AS (SELECT doc_id, {plural_case('word')} AS word, n FROM corpus)
SELECT doc_id, word, sum(n)::BIGINT AS n FROM normed GROUP BY doc_id, word""")
def _(spark, folder):
    return sample_source.save(corpus.normalized_counts(corpus_of(spark, folder)), scratch_path(spark, "counts"))


@query("s10_inline_terms", f"""WITH {TERM_COUNTS},
inline(word, grp) AS (VALUES ('ing', 'suffix'), ('tion', 'suffix'), ('re', 'prefix'), ('mentre', 'other'), ('onde', 'other'))
SELECT grp, word, count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM tc JOIN inline USING (word) GROUP BY grp, word""")
def _(spark, folder):
    rows = [("ing", "suffix"), ("tion", "suffix"), ("re", "prefix"), ("mentre", "other"), ("onde", "other")]
    listed = article_source.inline(spark, rows, "word string, grp string")
    return (
        counts_of(spark, folder).join(F.broadcast(listed), "word").groupBy("grp", "word")
        .agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"))
    )


# -- projections and filters -------------------------------------------------------------------------------------------

@query("p1_drop_bad_rows", f"""SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id NOT IN ({', '.join(map(str, BAD_IDS))})""")
def _(spark, folder):
    return cleaning.drop_rows(documents(spark, folder).select("doc_id", "lang", "source", "n_chars"), BAD_IDS)


@query("p2_project_fields", f"WITH {ARTICLES} SELECT headline, description, category FROM articles")
def _(spark, folder):
    return articles(spark, folder).select("headline", "description", "category")


@query("p3_recode_category", """SELECT doc_id,
CASE source WHEN 'src0' THEN 'src1' WHEN 'src19' THEN 'src18' ELSE source END AS category FROM documents""")
def _(spark, folder):
    rows = documents(spark, folder).select("doc_id", F.col("source").alias("category"))
    return cleaning.recode_category(rows, SOURCE_RECODES)


@query("p4_strip_possessives", """SELECT doc_id,
regexp_replace(regexp_replace(text, '''s ', ' ', 'g'), '''s', '', 'g') AS text FROM documents""")
def _(spark, folder):
    return documents(spark, folder).select("doc_id", text.strip_possessives(F.col("text")).alias("text"))


@query("p5_write_back_fields", f"""WITH {ARTICLES} SELECT doc_id,
regexp_replace(regexp_replace(headline, '''s ', ' ', 'g'), '''s', '', 'g') AS headline,
regexp_replace(regexp_replace(description, '''s ', ' ', 'g'), '''s', '', 'g') AS description, category FROM articles""")
def _(spark, folder):
    return cleaning.clean_fields(articles(spark, folder))


@query("p6_keep_long_documents", f"""WITH {TERM_COUNTS},
long_docs AS (SELECT doc_id FROM tc GROUP BY doc_id HAVING count(*) > 10)
SELECT doc_id, word, n FROM tc JOIN long_docs USING (doc_id)""")
def _(spark, folder):
    return corpus.keep_long_documents(counts_of(spark, folder)).select("doc_id", "word", "n")


@query("p7_drop_rare_terms", f"""WITH {TERM_COUNTS},
kept AS (SELECT word FROM tc GROUP BY word HAVING count(*) > 1)
SELECT doc_id, word, n FROM tc JOIN kept USING (word)""")
def _(spark, folder):
    return corpus.drop_rare_terms(counts_of(spark, folder)).select("doc_id", "word", "n")


@query("p8_keep_categories", f"""WITH {CORPUS}
SELECT doc_id, word, n FROM corpus JOIN documents USING (doc_id) WHERE lang IN ('en', 'fr')""")
def _(spark, folder):
    labels = documents(spark, folder).select("doc_id", F.col("lang").alias("category"))
    return corpus.subset_by_category(corpus_of(spark, folder), labels, ["en", "fr"]).select("doc_id", "word", "n")


@query("p9_regex_vocabulary", f"WITH {TERM_COUNTS} SELECT DISTINCT word FROM tc WHERE regexp_matches(word, 'ing$')")
def _(spark, folder):
    return corpus.vocabulary_matches(counts_of(spark, folder), "ing$")


@query("p9_regex_share", f"""WITH {TERM_COUNTS}, v AS (SELECT DISTINCT word FROM tc)
SELECT round(avg(regexp_matches(word, 'tion')::INT), 9) AS share,
       sum(regexp_matches(word, 'tion')::INT)::BIGINT AS hits FROM v""")
def _(spark, folder):
    shares = corpus.vocabulary_share(counts_of(spark, folder), F.col("word").rlike("tion"))
    return shares.select(F.round("share", 9).alias("share"), "hits")


@query("p10_integer_tokens", f"""WITH {TERM_COUNTS}, v AS (SELECT DISTINCT word FROM tc)
SELECT word FROM v WHERE coalesce(TRY_CAST(word AS BIGINT)::VARCHAR = word, false)""")
def _(spark, folder):
    return counts_of(spark, folder).select("word").distinct().where(text.is_integer(F.col("word")))


@query("p11_tokenless_documents", f"""WITH {ARTICLES}, {CORPUS}
SELECT doc_id, category FROM articles WHERE doc_id NOT IN (SELECT doc_id FROM corpus)""")
def _(spark, folder):
    rows = cleaning.tokenless(articles(spark, folder), corpus_of(spark, folder))
    return rows.select("doc_id", "category")


@query("p11_blank_fields", f"""WITH {ARTICLES}
SELECT doc_id, trim(headline) = '' AS no_headline, trim(description) = '' AS no_description FROM articles
WHERE trim(headline) = '' OR trim(description) = ''""")
def _(spark, folder):
    return cleaning.blank_fields(articles(spark, folder))


@query("p12_document_terms", f"WITH {CORPUS} SELECT doc_id, word, n FROM corpus WHERE doc_id = 7")
def _(spark, folder):
    return corpus_of(spark, folder).where(F.col("doc_id") == 7).select("doc_id", "word", "n")


@query("p15_term_repair", f"""WITH {TERM_COUNTS}
SELECT doc_id, CASE word WHEN 'polouse' THEN 'police' WHEN 'tion' THEN 'nation' ELSE word END AS word, sum(n)::BIGINT AS n
FROM tc GROUP BY 1, 2""")
def _(spark, folder):
    repairs = {"polouse": "police", "tion": "nation"}
    return corpus.normalized_counts(
        counts_of(spark, folder), lambda w: text.recode_or(w, repairs, w)
    )


# -- joins -------------------------------------------------------------------------------------------------------------

@query("j1_stop_word_removal", f"""WITH t AS (SELECT doc_id, unnest({WORDS}) AS word FROM documents)
SELECT doc_id, word FROM t WHERE word NOT IN {STOP}""")
def _(spark, folder):
    tokens = cleaning.token_rows(documents(spark, folder))
    return cleaning.without_stop_words(tokens).select("doc_id", "word")


@query("j2_semi_join", f"""WITH {TERM_COUNTS}
SELECT doc_id, word, n FROM tc WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def _(spark, folder):
    kept = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return skew.lookup(counts_of(spark, folder), kept, "doc_id", spread="word", how="left_semi").select(
        "doc_id", "word", "n"
    )


@query("j3_anti_join", f"""WITH {TERM_COUNTS}, few AS (SELECT word FROM tc GROUP BY word HAVING count(*) <= 2)
SELECT doc_id, word, n FROM tc WHERE word NOT IN (SELECT word FROM few)""")
def _(spark, folder):
    counts = counts_of(spark, folder)
    sizes = corpus.document_frequency(counts)
    few = sizes.where(F.col("docs") <= 2).select("word")
    return skew.lookup(
        counts, few, "word", spread="doc_id", how="left_anti", sizes=sizes.withColumnRenamed("docs", "rows")
    ).select("doc_id", "word", "n")


@query("j5_index_lookup", f"""WITH {DENSE}
SELECT doc_id, word, doc_idx, term_idx FROM corpus JOIN docs USING (doc_id) JOIN terms USING (word)""")
def _(spark, folder):
    counts = materialize(corpus_of(spark, folder), "counts")
    docs, terms = corpus.dense_ids(counts, "doc_id", "doc_idx"), corpus.dense_ids(counts, "word", "term_idx")
    by_doc = skew.lookup(counts, docs, "doc_id", spread="word")
    return skew.lookup(by_doc, terms, "word", spread="doc_id").select("doc_id", "word", "doc_idx", "term_idx")


@query("j6_label_by_document", f"""WITH {TERM_COUNTS}
SELECT doc_id, quality, toxic, sum(n)::BIGINT AS tokens FROM tc JOIN labels USING (doc_id) GROUP BY ALL""")
def _(spark, folder):
    tokens = counts_of(spark, folder).groupBy("doc_id").agg(F.sum("n").alias("tokens"))
    return tokens.join(table(spark, folder, "labels"), "doc_id").select("doc_id", "quality", "toxic", "tokens")


@query("j7_apply_term_map", f"""WITH {CORPUS}
SELECT doc_id, {plural_case('word')} AS word, n FROM corpus""")
def _(spark, folder):
    counts = corpus_of(spark, folder)
    return corpus.apply_term_map(counts, corpus.term_map(counts))


# -- counts ------------------------------------------------------------------------------------------------------------

@query("a1_term_counts", f"WITH {TERM_COUNTS} SELECT doc_id, word, n FROM tc ORDER BY n DESC, doc_id, word")
def _(spark, folder):
    return counts_of(spark, folder).orderBy(F.desc("n"), "doc_id", "word")


@query("a2_terms_per_document", f"WITH {TERM_COUNTS} SELECT doc_id, count(*)::BIGINT AS terms FROM tc GROUP BY doc_id")
def _(spark, folder):
    return corpus.terms_per_document(counts_of(spark, folder))


@query("a3_document_frequency", f"WITH {TERM_COUNTS} SELECT word, count(*)::BIGINT AS docs FROM tc GROUP BY word")
def _(spark, folder):
    return corpus.document_frequency(counts_of(spark, folder))


@query("a4_long_document_share", f"""WITH {TERM_COUNTS}, t AS (SELECT doc_id, count(*) AS terms FROM tc GROUP BY doc_id)
SELECT round(avg((terms > 10)::INT), 9) AS share, count(*)::BIGINT AS docs FROM t""")
def _(spark, folder):
    share = corpus.long_document_share(counts_of(spark, folder))
    return share.select(F.round("share", 9).alias("share"), "docs")


@query("a5_merged_counts", f"""WITH {CORPUS}, normed AS (SELECT doc_id, {plural_case('word')} AS word, n FROM corpus)
SELECT doc_id, word, sum(n)::BIGINT AS n FROM normed GROUP BY doc_id, word""")
def _(spark, folder):
    return corpus.normalized_counts(corpus_of(spark, folder))


@query("a6_category_frequency", "SELECT lang AS category, count(*)::BIGINT AS docs FROM documents GROUP BY lang")
def _(spark, folder):
    return articles(spark, folder).groupBy("category").agg(F.count("*").alias("docs"))


@query("a9_corpus_size", f"""WITH {CORPUS}
SELECT count(DISTINCT doc_id)::BIGINT AS docs, count(DISTINCT word)::BIGINT AS terms, count(*)::BIGINT AS pairs,
       sum(n)::BIGINT AS tokens, min(doc_id) AS min_doc_id, max(doc_id) AS max_doc_id FROM corpus""")
def _(spark, folder):
    return corpus.corpus_size(corpus_of(spark, folder))


@query("a29_length_histogram", f"""WITH {TERM_COUNTS}, t AS (SELECT doc_id, count(*) AS terms FROM tc GROUP BY doc_id)
SELECT (terms // 10 * 10)::BIGINT AS at_least, count(*)::BIGINT AS docs FROM t GROUP BY 1""")
def _(spark, folder):
    return corpus.length_histogram(counts_of(spark, folder))


@query("a32_merge_integrity", f"""WITH {CORPUS},
normed AS (SELECT doc_id, {plural_case('word')} AS word, n FROM corpus),
merged AS (SELECT doc_id, word, sum(n) AS n FROM normed GROUP BY doc_id, word)
SELECT count(DISTINCT (doc_id, word))::BIGINT AS before_keys, count(*)::BIGINT AS before_rows,
       sum(n)::BIGINT AS before_tokens,
       (SELECT count(*) FROM merged)::BIGINT AS after_keys, (SELECT count(*) FROM merged)::BIGINT AS after_rows,
       (SELECT sum(n) FROM merged)::BIGINT AS after_tokens
FROM normed""")
def _(spark, folder):
    normed = corpus_of(spark, folder).withColumn("word", text.normalize_word(F.col("word")))
    return corpus.merge_integrity(normed, corpus.merge_counts(normed))


@query("a32_duplicate_keys", f"""WITH {CORPUS}, normed AS (SELECT doc_id, {plural_case('word')} AS word, n FROM corpus)
SELECT doc_id, word, count(*)::BIGINT AS copies FROM normed GROUP BY doc_id, word HAVING count(*) > 1""")
def _(spark, folder):
    return corpus.duplicate_keys(
        corpus_of(spark, folder).withColumn("word", text.normalize_word(F.col("word")))
    )


# -- ids, duplicates, set operations -----------------------------------------------------------------------------------

@query("w6_dense_term_ids", f"WITH {DENSE} SELECT word, term_idx FROM terms")
def _(spark, folder):
    return corpus.dense_ids(corpus_of(spark, folder), "word", "term_idx")


@query("w6_class_ids", """SELECT lang AS category, (row_number() OVER (ORDER BY lang) - 1)::INT AS y
FROM (SELECT DISTINCT lang FROM documents)""")
def _(spark, folder):
    return corpus.class_ids(articles(spark, folder))


@query("w7_later_duplicates", f"""WITH t AS (
  SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) - 1 AS pos FROM documents)
SELECT doc_id, pos::INT AS pos, word,
       row_number() OVER (PARTITION BY doc_id, word ORDER BY pos) > 1 AS is_later FROM t""")
def _(spark, folder):
    return corpus.later_duplicates(cleaning.token_rows(documents(spark, folder), position=True))


@query("o6_changed_terms", f"""WITH {CORPUS}, v AS (SELECT DISTINCT word, {plural_case('word')} AS norm FROM corpus)
SELECT word, norm FROM v WHERE word <> norm ORDER BY word LIMIT 10""")
def _(spark, folder):
    return corpus.term_map(corpus_of(spark, folder)).orderBy("word").limit(10)


FIELD_ROWS = ARTICLES + """,
fields AS (
  SELECT doc_id, category, 'desp' AS indicator, description AS text FROM articles
  UNION ALL SELECT doc_id, category, 'hdl', headline FROM articles)"""


@query("u1_field_rows", f"WITH {FIELD_ROWS} SELECT doc_id, category, indicator, text, concat_ws('_', doc_id, indicator) AS doc_indicator FROM fields")
def _(spark, folder):
    return cleaning.field_rows(articles(spark, folder))


@query("u3_set_difference", """SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def _(spark, folder):
    return documents(spark, folder).select("doc_id").join(
        table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti"
    )


@query("u4_distinct_terms", f"WITH {TERM_COUNTS} SELECT DISTINCT word FROM tc")
def _(spark, folder):
    return counts_of(spark, folder).select("word").distinct()


# -- tokenizers --------------------------------------------------------------------------------------------------------

def _positions(listing: str, name: str, source: str = "documents", key: str = "doc_id") -> str:
    return (
        f"WITH l AS (SELECT {key}, {listing} AS parts FROM {source}) "
        f"SELECT {key}, unnest(parts) AS {name}, (generate_subscripts(parts, 1) - 1)::INT AS pos FROM l"
    )


@query("t1_word_tokens", _positions(WORDS, "word"))
def _(spark, folder):
    return cleaning.token_rows(documents(spark, folder), position=True)


@query("t1_field_word_tokens", f"""WITH {FIELD_ROWS}, t AS (
  SELECT doc_id, indicator, unnest({WORDS}) AS word FROM fields)
SELECT doc_id, indicator, word, count(*)::BIGINT AS n FROM t WHERE word NOT IN {STOP} GROUP BY ALL""")
def _(spark, folder):
    rows = cleaning.field_rows(articles(spark, folder))
    tokens = cleaning.without_stop_words(cleaning.token_rows(rows, keys=("doc_id", "indicator")))
    return tokens.groupBy("doc_id", "indicator", "word").agg(F.count("*").alias("n"))


@query("t2_word_char_tokens", _positions(f"regexp_extract_all(lower(text), {quoted(lexicon.WORD_CHAR_PATTERN)})", "word"))
def _(spark, folder):
    return cleaning.token_rows(documents(spark, folder), text.word_char_runs, position=True)


@query("t3_sentences", _positions(
    f"list_filter(string_split_regex(lower(text), {quoted(lexicon.SENTENCE_BREAK)}), lambda s: s <> '')", "sentence",
    "conversations", "conv_id, turn"))
def _(spark, folder):
    rows = table(spark, folder, "conversations")
    return cleaning.token_rows(rows, text.sentences, name="sentence", keys=("conv_id", "turn"), position=True)


@query("t4_bigrams", f"""WITH t AS (
  SELECT doc_id, unnest({WORDS}) AS word, generate_subscripts({WORDS}, 1) AS pos FROM documents),
b AS (SELECT doc_id, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS ngram FROM t)
SELECT doc_id, ngram, count(*)::BIGINT AS n FROM b WHERE ngram IS NOT NULL GROUP BY doc_id, ngram""")
def _(spark, folder):
    pairs = cleaning.token_rows(documents(spark, folder), text.ngrams(2), name="ngram")
    return pairs.groupBy("doc_id", "ngram").agg(F.count("*").alias("n"))


@query("t5_regex_sections", _positions(
    "list_filter(string_split_regex(lower(text), '[0-9]+'), lambda s: s <> '')", "section"))
def _(spark, folder):
    return cleaning.token_rows(documents(spark, folder), text.split_on("[0-9]+"), name="section", position=True)


@query("t6_char_shingles", r"""WITH l AS (
  SELECT regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS s FROM documents),
p AS (SELECT s, unnest(range(1, length(s) - 2)) AS i FROM l)
SELECT substr(s, i, 4) AS shingle, count(*)::BIGINT AS n FROM p GROUP BY 1""")
def _(spark, folder):
    rows = cleaning.token_rows(documents(spark, folder), text.char_shingles(4), name="shingle")
    return rows.groupBy("shingle").agg(F.count("*").alias("n"))


@query("t7_custom_split", _positions("list_filter(string_split(lower(text), ' '), lambda s: s <> '')", "word"))
def _(spark, folder):
    return cleaning.token_rows(documents(spark, folder), text.split_on(" "), position=True)


@query("f1_custom_tokenizer", """WITH t AS (
  SELECT conv_id, unnest(string_split(lower(text), chr(10))) AS line FROM conversations)
SELECT conv_id, line, count(*)::BIGINT AS n FROM t GROUP BY conv_id, line""")
def _(spark, folder):
    rows = table(spark, folder, "conversations")
    lines = cleaning.token_rows(rows, lambda c: F.split(F.lower(c), "\n"), name="line", keys=("conv_id",))
    return lines.groupBy("conv_id", "line").agg(F.count("*").alias("n"))


def _html_sql() -> str:
    out = "html"
    for pattern in lexicon.HTML_HIDDEN:
        out = f"regexp_replace({out}, {quoted(pattern)}, ' ', 'g')"
    for entity, char in lexicon.HTML_ENTITIES:
        out = f"replace({out}, {quoted(entity)}, {quoted(char)})"
    return out


@query("t8_html_tokens", f"""WITH x AS (SELECT page_id, {_html_sql()} AS text FROM pages),
t AS (SELECT page_id, unnest({WORDS}) AS word FROM x)
SELECT page_id, word, count(*)::BIGINT AS n FROM t GROUP BY page_id, word""")
def _(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))
    return cleaning.token_rows(rows, keys=("page_id",)).groupBy("page_id", "word").agg(F.count("*").alias("n"))


@query("t8_page_text", f"SELECT page_id, md5({_html_sql()}) AS text_md5, length({_html_sql()})::BIGINT AS chars FROM pages")
def _(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", text.html_text(F.col("html")).alias("text"))
    return rows.select("page_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("chars"))


@query("t9_concat_split_keys", f"""WITH {CORPUS}
SELECT doc_id || ' ' || word AS pair, doc_id::VARCHAR AS left_part, word AS right_part FROM corpus""")
def _(spark, folder):
    pairs = corpus_of(spark, folder).select(F.concat_ws(" ", "doc_id", "word").alias("pair"))
    return cleaning.split_key(pairs, "pair", ("left_part", "right_part"), " ")


@query("t10_unquote", """SELECT doc_id, rtrim(regexp_replace('"' || lang || '"' || chr(10), '["\r\n]', '', 'g')) AS lang,
rtrim(regexp_replace(text, '["\r\n]', '', 'g'), ' ') AS text FROM documents""")
def _(spark, folder):
    wrapped = F.concat(F.lit('"'), F.col("lang"), F.lit('"\n'))
    return documents(spark, folder).select(
        "doc_id", text.unquote(wrapped).alias("lang"), text.unquote(F.col("text")).alias("text")
    )


@query("t11_normalized_vocabulary", f"""WITH {TERM_COUNTS}, v AS (SELECT DISTINCT word FROM tc)
SELECT word, {plural_case('word')} AS norm FROM v""")
def _(spark, folder):
    words = counts_of(spark, folder).select("word").distinct()
    return words.select("word", text.normalize_word(F.col("word")).alias("norm"))


# -- reshaping ---------------------------------------------------------------------------------------------------------

@query("r1_document_term_matrix", f"""WITH {DENSE}
SELECT doc_idx, term_idx, n FROM corpus JOIN docs USING (doc_id) JOIN terms USING (word)""")
def _(spark, folder):
    return _matrix(spark, folder)[0]


@query("r2_bag_of_words", f"""WITH {DENSE}
SELECT doc_id, count(*)::INT AS terms, sum(n)::BIGINT AS tokens, min(term_idx) AS first_term,
       string_agg(term_idx || ':' || n, ' ' ORDER BY term_idx) AS bag
FROM corpus JOIN terms USING (word) GROUP BY doc_id""")
def _(spark, folder):
    counts = materialize(corpus_of(spark, folder), "counts")
    bags = corpus.bag_of_words(counts, corpus.dense_ids(counts, "word", "term_idx"))
    shown = F.transform("bag", lambda b: F.concat_ws(":", b["term_idx"].cast("string"), b["n"].cast("string")))
    total = F.aggregate("bag", F.lit(0).cast("bigint"), lambda acc, b: acc + b["n"])
    return bags.select(
        "doc_id", F.size("bag").alias("terms"), total.alias("tokens"),
        F.col("bag")[0]["term_idx"].alias("first_term"), F.array_join(shown, " ").alias("bag"),
    )


@query("r6_subset_remap", f"""WITH {CORPUS},
sub AS (SELECT corpus.*, lang AS category FROM corpus JOIN documents USING (doc_id) WHERE lang IN ('de', 'es')),
ids AS (SELECT doc_id, (row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1)::BIGINT AS doc_idx
        FROM (SELECT DISTINCT doc_id FROM sub))
SELECT doc_idx, category, count(*)::BIGINT AS terms, sum(n)::BIGINT AS tokens FROM sub JOIN ids USING (doc_id) GROUP BY ALL""")
def _(spark, folder):
    labels = documents(spark, folder).select("doc_id", F.col("lang").alias("category"))
    sub = corpus.subset_by_category(corpus_of(spark, folder), labels, ["de", "es"])
    sizes = materialize(sub.groupBy("doc_id").agg(F.count("*").alias("terms"), F.sum("n").alias("tokens")), "sizes")
    ids = corpus.dense_ids(sizes, "doc_id", "doc_idx")
    return sizes.join(ids, "doc_id").join(labels, "doc_id").select("doc_idx", "category", "terms", "tokens")
