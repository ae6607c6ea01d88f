"""The queries of the corpus operators over the driver's tables, and their SQL where it can be told."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import audit, exact, fertility, fim, html, jaccard, lm, media, mixing, packing, records, substrings, toxicity
from millrace.llm.common import table


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return lm.lm_scores(table(spark, sf_dir, "documents"), tokenizer, end_id=50256)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digests(table(spark, sf_dir, "documents"))


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY size DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight,
           3.0::DOUBLE * source_size AS cap
    FROM s
), r AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
    FROM (SELECT *, cap / weight AS ratio FROM w)
    WINDOW below AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
    SELECT level FROM r WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1
), t AS (
    SELECT source, source_size,
           CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(cap, coalesce((SELECT level FROM l), 0.0::DOUBLE) * weight) END AS target
    FROM r
), e AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), p AS (
    SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS part,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2 AS middle
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
), q AS (
    SELECT doc_id, size, source_size, target, CAST(least(whole + CAST(middle < part AS BIGINT), 3) AS BIGINT) AS repeats FROM p
)
SELECT doc_id, size, source_size, target, repeats, CAST(repeats * size AS BIGINT) AS taken FROM q
"""


def op11_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return fertility.quality(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit
), d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), f AS (
    SELECT part,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask,
           coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
    FROM d LEFT JOIN (
        SELECT doc_id AS labelled, max(CAST(quality = 1 AS INT)) AS quality, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
    ) ON doc_id = labelled
), m AS (
    SELECT part, mask, count(*) AS n, sum(quality) AS good, sum(toxic) AS bad FROM f GROUP BY part, mask
), o AS (
    SELECT a.x || b.x || c.x || e.x || g.x AS filter_order, [a.bit, b.bit, c.bit, e.bit, g.bit] AS bits
    FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters e ON e.x NOT IN (a.x, b.x, c.x) JOIN letters g ON g.x NOT IN (a.x, b.x, c.x, e.x)
), s AS (
    SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
    FROM m, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digests(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
    FROM documents
), k AS (
    SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n,
           CAST('0x' || h[1:8] AS BIGINT) % (len(tokens) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(tokens) + 1) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (
    SELECT doc_id, text, n, form, array_to_string(tokens[1:least(a, b)], '') AS prefix,
           array_to_string(tokens[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(tokens[greatest(a, b) + 1:], '') AS suffix
    FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_records": op1_token_records,
    "op2_lm_scores": op2_lm_scores,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_pack_sequences": op6_pack_sequences,
    "op7_html_text": op7_html_text,
    "op8_media_columns": op8_media_columns,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_fertility_rules": op11_fertility_rules,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL = {"op9_exact_dedup": OP9_SQL, "op10_mix_sources": OP10_SQL, "op12_filter_audit": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
