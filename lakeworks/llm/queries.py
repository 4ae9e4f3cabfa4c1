"""The queries over the numbered operators, with the SQL they are checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, divergence, embeddings, html, pii, ppm, quality, simhash, substring, url_filter, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.add_tokens(docs, "text", public_tokenizers.path("byte_bpe_50k.json"), digest=True).drop("text")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), "doc_id", "text", "n_chars", "quality")
    scored = quality.add_score(docs, model, "text", "n_chars")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        decontaminate.is_contaminated().alias("contaminated"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts are those of the rules' spans, like ``base_sha256``; ``spans`` has the added ones too."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.add_spans(docs, "text", pii.train(docs, "text")).drop("text")
    counts = [pii.count_of("rule_spans", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed("rule_spans"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


# The rules the query judges by.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


ORACLE["op1_url_filter"] = r"""
WITH RECURSIVE rules(verdict, host, path, rule) AS (VALUES
    ('allow', 'org', '/', 'org/'), ('block', 'example.org', '/es/', 'example.org/es/'),
    ('block', 'example.org', '/en/1', 'example.org/en/1'), ('allow', 'com', '/fr/', 'com/fr/'), ('block', 'com', '/de/', 'com/de/')),
raw AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest,
         regexp_extract(regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>', 0, 'i'), '\bhref\s*=\s*["'']?([^"''\s>]+)', 1, 'i') AS canonical,
         regexp_extract(regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>', 0, 'i'), '\burl\s*=\s*["'']?([^"''\s>;]+)', 1, 'i') AS redirect
  FROM pages),
seen AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1), '') AS query,
         split_part(url, '://', 1) AS scheme, canonical, redirect
  FROM raw),
links AS (
  SELECT *, unnest([canonical, redirect]) AS written FROM seen),
full_links AS (
  SELECT host, path, query, CASE
      WHEN replace(written, '&amp;', '&') = '' THEN NULL
      WHEN regexp_matches(replace(written, '&amp;', '&'), '^[A-Za-z][A-Za-z0-9+.-]*://') THEN replace(written, '&amp;', '&')
      WHEN starts_with(written, '//') THEN scheme || ':' || replace(written, '&amp;', '&')
      WHEN starts_with(written, '/') THEN scheme || '://' || host || replace(written, '&amp;', '&')
      ELSE scheme || '://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || replace(written, '&amp;', '&') END AS target
  FROM links),
targets AS (
  SELECT host || coalesce(nullif(path, ''), '/') || query AS a, substr(target, strpos(target, '://') + 3) AS rest FROM full_links
  WHERE host <> '' AND target IS NOT NULL),
edges AS (
  SELECT a, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         || coalesce(nullif(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), ''), '/') || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS b FROM targets),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached AS (SELECT a, a AS b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
named AS (
  SELECT DISTINCT b, split_part(b, '/', 1) AS host, regexp_extract(b, '^[^/]*([^?]*)', 1) AS path FROM reached),
judged AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT p.host, p.path, r.rule, r.verdict FROM (SELECT host, path FROM seen UNION SELECT host, path FROM named) p
        JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
  GROUP BY host, path),
resources AS (
  SELECT r.a, min(j.verdict) AS verdict FROM reached r JOIN named n USING (b) JOIN judged j USING (host, path) GROUP BY r.a)
SELECT s.page_id, s.host, s.path, j.rule, coalesce(j.verdict, x.verdict, 'allow') AS verdict,
       CASE WHEN j.verdict IS NOT NULL THEN 'rule' WHEN x.verdict IS NOT NULL THEN 'alias' ELSE 'none' END AS reason
FROM seen s LEFT JOIN judged j USING (host, path)
LEFT JOIN resources x ON x.a = s.host || coalesce(nullif(s.path, ''), '/') || s.query
"""


@query
def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"))


@query
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages"), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op12_warc"] = r"""
WITH held AS (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages),
hashed AS (SELECT *, sha1(payload) AS hex FROM held)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * i, 5))::INTEGER >> b) & 31), 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM hashed
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


ORACLE["op13_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(
         CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]') THEN [NULL] ELSE regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') END) AS term
  FROM documents),
vocabulary AS (SELECT lang, term, count(*) AS total FROM docs WHERE term IS NOT NULL GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS words FROM vocabulary GROUP BY lang),
known AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM docs JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
words AS (SELECT lang, source, sum(n) AS words FROM counted GROUP BY lang, source),
cells AS (
  SELECT k.lang, k.source, o.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(w.words, 0) + s.v))::HUGEINT AS p,
         (1 + (1000000000::HUGEINT * (o.total + 1)) // (s.words + s.v))::HUGEINT AS q
  FROM known k JOIN vocabulary o USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN words w USING (lang, source) LEFT JOIN counted c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM known a JOIN known b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM cells WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM all_pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value,
               (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM terms) WHERE rank <= 200
"""
