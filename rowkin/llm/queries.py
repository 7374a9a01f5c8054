"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules

    made = quality_rules.judged(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL["op1_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM w) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM r) GROUP BY 1),
b AS (SELECT d.*, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM d LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    n_symbols > 0.3 * n_words OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR n_dup_lines > 0.3 * len(ls)
    OR len(list_filter(ws, lambda w: regexp_matches(w, '\p{L}'))) < 0.6 * n_words
    OR len(list_filter(ws, lambda w: regexp_matches(w, '\p{Lu}\P{Ll}*\p{Lu}') AND NOT regexp_matches(w, '\p{Ll}'))) > 0.5 * n_words
    OR (n_words >= 50 AND len(list_distinct(ws)) < 0.1 * n_words)
    OR len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) > 0.3 * len(ls)
    OR len(list_filter(ls, lambda x: regexp_matches(x, '\A[\x20\x09-\x0D]*[•*-][\x20\x09-\x0D]'))) > 0.9 * len(ls)) AS kept
FROM f
"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import exact_dedup

    return exact_dedup.groups(table(spark, sf_dir, "documents"))


ORACLE_SQL["op4_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS k FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       CAST(count(*) OVER (PARTITION BY k) AS BIGINT) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(k) AS text_sha256
FROM d WINDOW w AS (PARTITION BY k ORDER BY length(t) DESC, doc_id)
"""


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    made = mixing.mix(table(spark, sf_dir, "documents"))
    return made.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken", "copies")


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    made = warc.archived(table(spark, sf_dir, "pages"))
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import chat

    path = public_tokenizers.path("byte_bpe_50k.json")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.formatted(turns, path), path)


ORACLE_SQL["op3_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(role) + length(text)
        + 2 * length('turn>') + length('</role>') + 3
        + length(regexp_replace(role || text, '[^\\]', '', 'g'))
        + len(regexp_extract_all(role, '<(turn>|/role>|/turn>)'))
        + len(regexp_extract_all(text, '<(turn>|/role>|/turn>)')) AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language_id

    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out())
    profiles = language_id.learn(docs.where("NOT held_out"))
    return language_id.identified(docs, profiles, keep=("doc_id", "held_out"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from . import packing

    made = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_classifier

    return quality_classifier.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lm_scoring

    return lm_scoring.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dedup

    return near_dedup.grouped(table(spark, sf_dir, "documents"))
