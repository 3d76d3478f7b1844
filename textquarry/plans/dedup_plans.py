"""Exact duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.labels import cluster_bucket
from textquarry.operators import dedup as X
from textquarry.operators.mixing import REHYDRATION
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import squeeze


@query(
    "dedup_normalized", "D1 W9",
    f"SELECT doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY md5({squeeze('text')}) ORDER BY doc_id) = 1",
)
def dedup_normalized(t):
    return X.dedup_normalized(t.documents, ["doc_id"]).select("doc_id", "n_chars")


@query(
    "dedup_per_source", "D1",
    f"SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source, md5({squeeze('text')}) ORDER BY doc_id) = 1",
)
def dedup_per_source(t):
    return X.dedup_normalized(t.documents, ["doc_id"], group=["source"]).select("doc_id", "source")


@query(
    "dedup_report", "D1",
    f"SELECT lang, count(*)::BIGINT AS rows, count(DISTINCT md5({squeeze('text')}))::BIGINT AS unique_texts, count(DISTINCT source)::BIGINT AS sources FROM documents GROUP BY lang",
)
def dedup_report(t):
    return X.dedup_report(t.documents, group=["lang"])


@query(
    "cluster_size", "D2",
    f"SELECT doc_id, count(*) OVER (PARTITION BY md5({squeeze('text')}))::BIGINT AS cluster_size FROM documents",
)
def cluster_size(t):
    return X.with_cluster_size(t.documents).select("doc_id", "cluster_size")


@query(
    "rehydrate", "D3",
    f"""WITH c AS (SELECT doc_id, count(*) OVER (PARTITION BY md5({squeeze('text')})) AS n FROM documents),
        w AS (SELECT doc_id, CASE WHEN n = 1 THEN 1 WHEN n = 2 THEN 2 WHEN n <= 4 THEN 3 WHEN n < 100 THEN 5 WHEN n < 1000 THEN 8 ELSE 1 END AS w FROM c)
        SELECT doc_id, unnest(range(1, w + 1))::INT AS copy FROM w""",
)
def rehydrate(t):
    sized = X.with_cluster_size(t.documents)
    bucket = F.regexp_replace(cluster_bucket(F.col("cluster_size")), "^cluster_size-", "")
    return X.rehydrate(sized, X.rehydration_weight(bucket, REHYDRATION)).select("doc_id", "copy")
