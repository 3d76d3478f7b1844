"""Web documents: pages with the text and label of the document of the same number."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.operators.projections import to_published
from textquarry.operators.web import process_web
from textquarry.plans import sqlbits as S
from textquarry.plans.filter_plans import _HOST, _PATH, _PREFIX_ROWS, ALL_PREFIXES, crawl_rules
from textquarry.plans.join_plans import _NGRAM_SQL
from textquarry.plans.registry import query
from textquarry.plans.text_plans import sql_mask_phone, sql_mask_pii


def web_rows(t):
    return (
        t.pages.join(t.documents, F.col("page_id") == F.col("doc_id"))
        .join(t.labels.select("doc_id", F.col("quality").cast("double").alias("score")), "doc_id", "left")
        .select("doc_id", "url", "text", "lang", "score")
    )


def processed(t):
    return process_web(web_rows(t), crawl_rules(t), t.benchmark, ALL_PREFIXES)


def _grams(table: str, key: str) -> str:
    cut = "list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))"
    return f"SELECT {key} AS k, unnest({cut}) AS g FROM (SELECT {key}, {_NGRAM_SQL.format('text')} AS w FROM {table})"


_WEB_SQL = f"""
    d AS (SELECT doc_id, url, text, lang, quality::DOUBLE AS score FROM pages JOIN documents ON page_id = doc_id LEFT JOIN labels USING (doc_id)),
    c AS (SELECT *, count(*) OVER (PARTITION BY md5({S.squeeze('text')}))::BIGINT AS n FROM d),
    p(ord, prefix) AS (VALUES {_PREFIX_ROWS}),
    known AS (SELECT doc_id, 'duplicate_url:' || arg_min(p.prefix, p.ord) AS why FROM d JOIN p ON starts_with(regexp_replace(url, '^[a-z]+://', ''), p.prefix) GROUP BY doc_id),
    raw AS (SELECT DISTINCT {_HOST} AS host, '/' || split_part(url, '/', 4) || '/' AS path FROM pages),
    rules AS (SELECT host, path, {S.uniform('host', 'path', seed='allow')} < 0.6 AS allow, {S.uniform('host', seed='malformed')} < 0.1 AS malformed
              FROM raw WHERE {S.uniform('host', seed='seen')} < 0.8),
    sites AS (SELECT host, bool_or(malformed) AS malformed FROM rules GROUP BY host),
    best AS (SELECT doc_id, arg_max(allow, length(path)) AS allow FROM d JOIN rules r ON {_HOST} = r.host AND starts_with({_PATH}, r.path) GROUP BY doc_id),
    early AS (SELECT c.*, coalesce(known.why, CASE WHEN s.host IS NULL THEN 'robots:unknown_host' WHEN s.malformed THEN NULL WHEN NOT coalesce(b.allow, TRUE) THEN 'robots:disallowed' END,
                                   CASE WHEN score < 1 THEN 'low_score' END) AS why
              FROM c LEFT JOIN known USING (doc_id) LEFT JOIN sites s ON {_HOST} = s.host LEFT JOIN best b USING (doc_id)),
    mailed AS (SELECT * REPLACE ({sql_mask_pii('text')} AS text) FROM early),
    masked AS (SELECT * REPLACE ({sql_mask_phone('text', 'lang')} AS text) FROM mailed),
    bad AS (SELECT DISTINCT k FROM ({_grams('masked', 'doc_id')}) WHERE g IN (SELECT g FROM ({_grams('benchmark', 'item_id')}))),
    w AS (SELECT doc_id, url, text, lang, n, coalesce(why, CASE WHEN doc_id IN (SELECT k FROM bad) THEN 'contaminated' END) AS drop_reason,
                 CASE WHEN n BETWEEN 1 AND 4 THEN 'cluster_size-' || n WHEN n < 100 THEN 'cluster_size-5-100' WHEN n < 1000 THEN 'cluster_size-100-1000' ELSE 'cluster_size-1000+' END AS cluster_size_group
          FROM masked)"""


@query(
    "web_pipeline", "F1 F2 F11 T1 T2 J6 K4",
    f"WITH {_WEB_SQL} SELECT coalesce(drop_reason, 'kept') AS outcome, cluster_size_group, count(*)::BIGINT AS docs, sum(length(text))::BIGINT AS chars FROM w GROUP BY ALL",
)
def web_pipeline(t):
    return (
        processed(t)
        .groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("outcome"), "cluster_size_group")
        .agg(F.count("*").alias("docs"), F.sum(F.length("text").cast("bigint")).alias("chars"))
    )


@query(
    "web_published", "P1 F1 F2 F11 T1 T2 J6 K3",
    f"""WITH {_WEB_SQL} SELECT 'web' AS source, doc_id::VARCHAR AS id, lang AS language, md5(text) AS digest, cluster_size_group FROM w WHERE drop_reason IS NULL""",
)
def web_published(t):
    kept = processed(t).where("drop_reason IS NULL").select("doc_id", "lang", "text", "url", "cluster_size_group")
    out = to_published(kept, source="web", language_key="lang", id_key="doc_id")
    group = F.get_json_object("metadata", "$.cluster_size_group").alias("cluster_size_group")
    return out.select("source", "id", "language", F.md5("text").alias("digest"), group)
