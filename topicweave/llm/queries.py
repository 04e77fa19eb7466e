"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.llm import (
    bpe, exact_dedup, fill_middle, mixing, ngram_join, quality_rules, quality_trees, repeated_windows, sharding, spelling, token_counts,
    token_files, url_filter,
)
from topicweave.sources.tables import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(table(spark, folder, "documents"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    written = token_files.write(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 50_257)
    return token_files.read(written)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), 24)


def op7_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    return quality_trees.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.section_counts(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_table(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    decided = exact_dedup.new_index(spark).add(table(spark, folder, "documents"))
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    restored = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeated_windows.without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_ngram_join, op3_token_files, op4_mixing, op5_url_filter, op6_sharding, op7_quality_trees, op8_token_counts,
    op9_bpe, op10_exact_dedup, op11_fill_middle, op12_spelling, op13_repeated_windows,
)}

ORACLES = {
    "op10_exact_dedup": """WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op11_fill_middle": """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS us, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(us[1:a], '') AS prefix, array_to_string(us[a + 1:b], '') AS middle, array_to_string(us[b + 1:], '') AS suffix,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p""",
    # The checksum byte by byte with its table of 256 numbers; near words share what is left without one letter, or with it masked.
    "op12_spelling": r"""WITH RECURSIVE bits AS (SELECT range AS i, range::UBIGINT AS c, 0 AS step FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
sums AS (SELECT list(c ORDER BY i) AS sums FROM bits WHERE step = 8),
found AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents),
small AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM found),
often AS (SELECT doc_id, run, count(*) AS times, hex(encode(doc_id || ':' || run)) AS h FROM small GROUP BY doc_id, run),
summed AS (SELECT run, times, xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, sums[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS h FROM often, sums),
worn AS (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
  ELSE run END AS word FROM summed),
v AS (SELECT word, sum(times)::BIGINT AS n FROM worn WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM places),
near AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, x.n, v.word, v.n FROM cuts x JOIN v ON v.word = x.a || x.b
  UNION SELECT v.word, v.n, x.word, x.n FROM cuts x JOIN v ON v.word = x.a || x.b),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
  CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n FROM v LEFT JOIN ranked ON ranked.word = v.word AND place = 1),
walk AS (SELECT word, word AS root, form AS further FROM forms
  UNION ALL SELECT walk.word, further, forms.form FROM walk JOIN forms ON forms.word = further)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN walk ON walk.word = forms.word AND further IS NULL""",
    "op13_repeated_windows": r"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM t WHERE len(words) >= 20),
w AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(words[pos:pos + 19], ' ') ORDER BY doc_id, pos) AS place FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM w WHERE place > 1),
p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM t),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)""",
}
