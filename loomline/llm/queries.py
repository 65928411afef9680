"""The thin queries over the test tables: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import class_lm, exact_dedup, html_extract, langid, licenses, mixing, packing, quality_rules, resampling, simhash
from loomline.llm.common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, crc_mod("doc_id", 3) != 1)
    return langid.identify(docs, model, keep=["doc_id"]).select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"), F.to_json("spans").alias("spans"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).drop("straight")


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    scored = class_lm.fit_and_score(docs, ~held_out).docs
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.cascade(_table(spark, sf_dir, "documents"), keep=["doc_id"], report=quality_rules.BASE)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("spans")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.training_order(mixing.curriculum(_table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_exact_dedup, op3_class_lm, op4_quality_rules, op5_html_extraction, op6_license_scan, op7_mixing, op8_simhash, op9_packing, op10_quality_classifier)}


def oracle_sql() -> dict[str, str]:
    """op1, op3, op5 and op10 rest on trained models, op8 on XXH64, op9 on a tokenizer, which SQL lacks; tests hold them against brute force."""
    return {
        "op6_license_scan": licenses.oracle(),
        "op7_mixing": r"""WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x{20}\x{09}-\x{0D}]+'))::BIGINT AS size FROM documents),
            r AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source),
            l AS (SELECT *, [3::DOUBLE, 1, 2][rank % 3 + 1] AS weight, [0.5::DOUBLE, 0, -0.5][rank % 3 + 1] AS slope, source_size * 2::DOUBLE AS most FROM r),
            v AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
                FROM l WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            t AS (SELECT source, source_size, slope, CASE WHEN level >= most / weight THEN most ELSE least(most, weight * max(level) FILTER (NOT level >= most / weight) OVER ()) END AS target FROM v),
            k AS (SELECT *, ('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || ',' || size), 15))::BIGINT AS key FROM s),
            q AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM k),
            g AS (SELECT q.*, source_size, slope, target, round(target)::BIGINT AS goal, CASE WHEN source_size > 0 THEN floor(goal / source_size)::BIGINT ELSE 0 END AS whole FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source),
            x AS (SELECT *, greatest(0, least(size, goal - whole * source_size - ahead)) AS extra, whole * size + greatest(0, least(size, goal - whole * source_size - ahead)) AS taken FROM g),
            y AS (SELECT *, CASE WHEN taken > 0 THEN whole + (extra > 0)::INT ELSE 0 END AS copies, ahead + source_size * CASE WHEN extra > 0 THEN whole ELSE greatest(0, whole - 1) END AS last FROM x),
            z AS (SELECT *, CASE WHEN target > 0 THEN least(1::DOUBLE, ahead / target) ELSE 0 END AS a, CASE WHEN target > 0 THEN least(1::DOUBLE, last / target) ELSE 0 END AS b, 1 - slope AS flat FROM y)
            SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, copies::INT AS copies,
                CASE WHEN taken > 0 THEN CASE WHEN slope = 0 OR a = 0 THEN a ELSE (sqrt(flat * flat + 4 * slope * a) - flat) / (2 * slope) END END AS position,
                CASE WHEN taken > 0 THEN CASE WHEN slope = 0 OR b = 0 THEN b ELSE (sqrt(flat * flat + 4 * slope * b) - flat) / (2 * slope) END END AS last_position FROM z""",
        "op2_exact_dedup": """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op4_quality_rules": r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents),
            g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
            r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g),
            h AS (SELECT doc_id, count(DISTINCT p) AS held FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n > 1) GROUP BY doc_id),
            l AS (SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x{20}\x{09}-\x{0D}]')) AS lines FROM w),
            f AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) AS line_chars, coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) - coalesce(list_sum(list_transform(list_distinct(lines), lambda x: length(x))), 0) AS dup_line_chars,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(h.held, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS u, len(regexp_extract_all(t, '[a-z]')) AS s FROM l LEFT JOIN h USING (doc_id)),
            b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * dup_line_chars > 3 * line_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR (u > 2 * s AND u > 50)) AS kept FROM b""",
    }
