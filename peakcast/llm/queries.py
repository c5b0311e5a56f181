"""The registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, collocations, decontaminate, language, licenses, lm_score, mixing, near_dup, pieces, quality,
               token_counts, whitening)
from .common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@register("op4_nearest_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


_TEMPLATE_ROWS = ", ".join(
    [f"({-i - 1}, '{p}', '{label}', {len(p.split())})" for i, (p, label) in enumerate(licenses.BASE.items())]
    + [f"({i}, '{t}', '{label}', {licenses.K})" for i, (label, t) in enumerate(licenses.TEMPLATES)])
LICENSE_SQL = f"""
WITH t AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS v(template, words, label, k)),
tg AS (
  SELECT template, label, k, len(string_split(words, ' ')) AS n, unnest(range(0, len(string_split(words, ' ')) - k + 1)) AS tpos,
         string_split(words, ' ') AS w FROM t),
tk AS (SELECT template, label, k, n, tpos, array_to_string(w[tpos + 1:tpos + k], ' ') AS gram FROM tg),
d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
dw AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
dg AS (
  SELECT id, pos, word || ' ' || lead(word, 1) OVER o AS g2, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g3
  FROM dw WINDOW o AS (PARTITION BY id ORDER BY pos)),
hits AS (
  SELECT id, pos, template, label, n, tpos, k FROM dg JOIN tk ON tk.k = 3 AND g3 = gram
  UNION ALL SELECT id, pos, template, label, n, tpos, k FROM dg JOIN tk ON tk.k = 2 AND g2 = gram),
base AS (
  SELECT id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM hits WHERE template < 0 GROUP BY id),
cells AS (SELECT id, template, label, n, pos - tpos AS diagonal, unnest(range(tpos, tpos + k)) AS cell FROM hits WHERE template >= 0),
diag AS (
  SELECT id, template, diagonal,
         CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY id, template ORDER BY diagonal) <= {licenses.SLIP}
              THEN 0 ELSE 1 END AS new
  FROM (SELECT DISTINCT id, template, diagonal FROM cells)),
grp AS (SELECT *, sum(new) OVER (PARTITION BY id, template ORDER BY diagonal) AS span FROM diag),
spans AS (
  SELECT id, label, count(DISTINCT cell) / any_value(n)::DOUBLE AS cover
  FROM cells JOIN grp USING (id, template, diagonal) GROUP BY id, template, label, span),
found AS (
  SELECT id, max(cover) AS cover, list(DISTINCT label) FILTER (WHERE cover >= {licenses.COVER}) AS labels FROM spans GROUP BY id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.cover, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base b USING (id) LEFT JOIN found f USING (id)"""


@register("op1_benchmark_decontamination", decontaminate.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_lm_scores", lm_score.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lm_score.lm_scores(table(spark, sf_dir, "documents"))
    return s.withColumn("score", F.round("score", 4)).withColumn("mean_score", F.round("mean_score", 4))


@register("op3_source_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_rates(docs, mixing.languages(docs))


@register("op5_license_scan", LICENSE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


@register("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_near_duplicates", near_dup.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_CONTROL_RE = "|".join("".join("\\" + ch if ch in "|[]<>/" else ch for ch in c) for c in chat.CONTROL)


@register("op10_chat_formatting", f"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text))
         AS loss_sha256,
       CAST(sum(length(role) + length(text) + {len(chat.TURN) + len(chat.END) + 2}
           + len(regexp_extract_all(role, '\\\\|\\n|{_CONTROL_RE}')) + len(regexp_extract_all(text, '\\\\|{_CONTROL_RE}')))
         AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_digests(table(spark, sf_dir, "conversations"))


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op12_phrase_collocations", collocations.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_sentence_pieces")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
