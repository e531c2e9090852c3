"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (bpe_automaton, conversation_repair, exact_dedup, html_extract, langid, license_scan, line_dedup, ngram_join,
                          packing, quality_lines, spelling, toxicity, wordpiece_count)
from tidecast.llm.common import id_bucket, read_table


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; LLM_VOCABULARIES names another folder."""
    folder = os.environ.get("LLM_VOCABULARIES")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def _held_out(parts: int, rest: int):
    return F.coalesce(id_bucket(F.col("doc_id"), parts) == rest, F.lit(False))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~_held_out(4, 2)))
    found = langid.tag_languages(docs, model)
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score", "n_switches")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(read_table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_count.piece_counts(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(id_bucket(F.col("doc_id"), 5) != 0)
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.quality_verdicts(read_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(read_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.bpe_codes(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.without_common_lines(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(read_table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(read_table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_language, op2_packing, op3_licenses, op4_html, op5_exact, op6_pieces, op7_toxicity,
                                   op8_quality, op9_ngram_join, op10_bpe, op11_line_dedup, op12_spelling, op13_conversations,
                                   pipeline)}

SQL = {
    "op5_exact": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm),
n AS (SELECT d.*, row_number() OVER (PARTITION BY d.norm ORDER BY d.doc_id NULLS LAST) AS place FROM d)
SELECT n.doc_id, g.keep_id, g.group_size, n.place = 1 AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)
""",
    "op8_quality": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l0 AS (SELECT rid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
l AS (SELECT rid, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l0),
w0 AS (
  SELECT *, regexp_matches(line, '[.!?…:;"'')\]»”।॥。！？؟۔．；：」』】）》’][\x20\x09-\x0D]*$') AS ended,
    regexp_matches(line, '[.!?][\x20\x09-\x0D]|[।॥。！？؟۔]') AS inner_mark,
    lead(n) OVER x AS next_n, lead(line) OVER x AS next_line
  FROM l WINDOW x AS (PARTITION BY rid ORDER BY pos)),
w1 AS (SELECT *, n >= 5 AND NOT ended AND coalesce(next_n, 0) > 0 AND regexp_matches(coalesce(next_line, ''), '^[\x20\x09-\x0D]*[a-zß-öø-ÿ]') AS goes_on FROM w0),
w2 AS (SELECT *, coalesce(lag(goes_on) OVER (PARTITION BY rid ORDER BY pos), false) AS follows FROM w1),
w3 AS (SELECT *, sum(CASE WHEN follows THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY pos) AS unit FROM w2),
w4 AS (SELECT *, bool_or(n > 0 AND (ended OR inner_mark)) OVER (PARTITION BY rid, unit) AS marked FROM w3),
judged AS (
  SELECT rid, n, row_number() OVER (PARTITION BY rid, line ORDER BY pos) > 1 AS again,
    NOT marked
    OR 100 * len(regexp_extract_all(line, '(?:^|[\x20\x09-\x0D])[|>»•·]')) > 10 * n
    OR 100 * len(regexp_extract_all(line, '[#*$%&|<>][^\x20\x09-\x0D]*')) > 30 * n
    OR 100 * len(regexp_extract_all(line, '[A-ZÀ-ÖØ-Þ]{2}[^\x20\x09-\x0D]*')) > 50 * n AS fails,
    least(n, coalesce(list_sum(list_transform(
      list_filter(regexp_extract_all(line, '[^.!?।॥。！？؟۔]+[.!?।॥。！？؟۔]*|[.!?।॥。！？؟۔]+'), lambda p: regexp_matches(p, '(?i)lorem ipsum|javascript|cookie policy|privacy policy|terms of use|terms of service|all rights reserved|click here|read more|sign up|log in|[{}]')),
      lambda p: len(regexp_extract_all(p, '[^\x20\x09-\x0D]+')))), 0)) AS n_phrase
  FROM w4 WHERE n > 0),
lines AS (SELECT rid, sum(n) AS n_words, count(*) FILTER (again) AS n_dup_lines, sum(CASE WHEN fails THEN n ELSE n_phrase END)::BIGINT AS n_lost_words FROM judged GROUP BY rid),
w AS (SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS pos FROM d),
g AS (
  SELECT rid, pos, concat_ws(' ', word, lead(word, 1) OVER x, lead(word, 2) OVER x, lead(word, 3) OVER x, lead(word, 4) OVER x, lead(word, 5) OVER x, lead(word, 6) OVER x, lead(word, 7) OVER x) AS gram,
    lead(word, 7) OVER x IS NOT NULL AS whole
  FROM w WINDOW x AS (PARTITION BY rid ORDER BY pos)),
t AS (SELECT rid, pos, CASE WHEN whole AND count(*) OVER (PARTITION BY rid, gram, whole) > 1 THEN 1 ELSE 0 END AS twice FROM g),
c AS (SELECT rid, max(twice) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM t),
r AS (SELECT rid, sum(covered) AS n_repeat_words FROM c GROUP BY rid),
f AS (
  SELECT d.doc_id, coalesce(lines.n_words, 0)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lines.n_lost_words, 0)::BIGINT AS n_lost_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * n_lost_words <= 50 * n_words AS kept FROM b
""",
    "op11_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
""",
}
