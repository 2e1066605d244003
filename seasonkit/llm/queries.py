"""Registered queries of this subpackage and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, owns_tables
from . import bucket_pointer, decontamination, embedding_dedup, filter_audit, kneser_ney, line_dedup, minhash, packing, pii, secret_scan, sharding, token_pairs, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = owns_tables(query)
        if sql is not None:
            ORACLE[name] = sql
        return QUERIES[name]

    return deco


@register("op1_minhash_dedup")
def op1(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_best_fit_packing")
def op3(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@register("op4_secret_scan")
def op4(spark, sf_dir):
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
b AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, s, n FROM doc_windows JOIN item_windows USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@register("op8_benchmark_decontamination", DECONTAMINATION_SQL)
def op8(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@register("op8_proximity_matches")
def op8_near(spark, sf_dir):
    return decontamination.near_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_toxicity")
def op9(spark, sf_dir):
    return toxicity.classify_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_rendezvous_sharding")
def op10(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding AS e,
    sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) / (a.norm * b.norm) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = e.vec_id) AS BIGINT) AS n_links,
  min(reach.b) AS component_id, e.vec_id = min(reach.b) AS kept
FROM embeddings e JOIN reach ON reach.a = e.vec_id GROUP BY e.vec_id
"""


@register("op2_itq_embedding_dedup", EMBEDDING_SQL)
def op2(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op7_pii_sanitisation")
def op7(spark, sf_dir):
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


@register("op6_kneser_ney_quality")
def op6(spark, sf_dir):
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_bucket_pointer_dedup")
def op5(spark, sf_dir):
    found = bucket_pointer.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeats AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT keyed.*, first IS NOT NULL AND doc_id <> first AS gone FROM keyed LEFT JOIN repeats USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@register("op12_line_dedup", LINES_SQL)
def op12(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[ 	-
]+'), lambda x: x <> '') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first
  FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, CAST(len(words) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, FALSE) AS INT) AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(l.toxic, 0)) AS toxic
  FROM w LEFT JOIN l USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bit, (SELECT sum(x.bit) FROM letters x WHERE position(x.f IN filter_order) < step) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step), letters WHERE substr(filter_order, step, 1) = f),
counted AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, bit,
    coalesce(sum(n) FILTER (mask & (coalesce(before, 0) | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


@register("op13_filter_audit", AUDIT_SQL)
def op13(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_token_alignment")
def op11(spark, sf_dir):
    return token_pairs.alignment_report(table(spark, sf_dir, "documents"))
