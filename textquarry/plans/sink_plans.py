"""Sinks, checked by reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.labels import length_bucket
from textquarry.functions.text import PRETOKEN_PLAIN, n_words, pretokens
from textquarry.operators.filters import tag_rejects
from textquarry.operators.projections import to_published
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import n_words as sql_words
from textquarry.session import scratch_path
from textquarry.sources import writers


@query(
    "sink_published", "K2 K3",
    """SELECT lang AS language, source, doc_id::VARCHAR AS id, length(text)::BIGINT AS n_chars,
              CASE WHEN n_chars > 2000 THEN 4 ELSE 1 END::BIGINT AS score FROM documents""",
)
def sink_published(t):
    path = scratch_path(t.spark, "published")
    scored = to_published(t.documents, source_key="source", language_key="lang", id_key="doc_id")
    scored = scored.withColumn("score", F.when(F.length("text") > 2000, 4).otherwise(1))
    writers.write_published(scored, path, ("score",), max_records=100)
    back = t.spark.read.parquet(path)
    return back.select(
        "language", "source", "id", F.length("text").cast("bigint").alias("n_chars"), F.col("score").cast("bigint").alias("score")
    )


@query(
    "keep_reject", "K4",
    f"""SELECT doc_id, CASE WHEN {sql_words('text')} > 50 THEN NULL ELSE 'too_short' END AS drop_reason FROM documents""",
)
def keep_reject(t):
    return tag_rejects(t.documents, n_words(F.col("text")) > 50, "too_short").select("doc_id", "drop_reason")


@query(
    "sink_keep_reject", "K4",
    f"""SELECT ({sql_words('text')} > 50) AS kept, count(*)::BIGINT AS docs FROM documents GROUP BY 1""",
)
def sink_keep_reject(t):
    path = scratch_path(t.spark, "sides")
    writers.write_keep_reject(t.documents, n_words(F.col("text")) > 50, "too_short", path)
    sides = t.spark.read.parquet(path).groupBy(F.col("kept").cast("boolean").alias("kept"))
    return sides.agg(F.count("*").alias("docs"))


@query(
    "sink_tokens", "K6",
    f"""SELECT doc_id, len(regexp_extract_all(text, '{PRETOKEN_PLAIN}'))::INT AS n_tokens FROM documents""",
)
def sink_tokens(t):
    path = scratch_path(t.spark, "tokens")
    writers.write_tokens(t.documents.select("doc_id", pretokens(F.col("text"), PRETOKEN_PLAIN).alias("tokens")), path)
    return t.spark.read.parquet(path).select("doc_id", "n_tokens")


@query(
    "resume_unfinished", "K7 J8 R2",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def resume_unfinished(t):
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return writers.resume(t.orders, done, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    "sink_by_bucket", "K8",
    """SELECT source AS dataset, CASE WHEN n_chars < 4096 THEN '0-4k' WHEN n_chars < 16384 THEN '4k-16k'
              WHEN n_chars < 65536 THEN '16k-64k' ELSE '64k+' END AS length_bucket, count(*)::BIGINT AS docs
       FROM documents GROUP BY 1, 2""",
)
def sink_by_bucket(t):
    path = scratch_path(t.spark, "buckets")
    docs = t.documents.select(
        "doc_id", "text", F.col("source").alias("dataset"), length_bucket(F.col("n_chars")).alias("length_bucket")
    )
    writers.write_by_bucket(docs, path)
    back = t.spark.read.schema("doc_id bigint, dataset string, length_bucket string").json(path)
    return back.groupBy("dataset", "length_bucket").agg(F.count("*").alias("docs"))
