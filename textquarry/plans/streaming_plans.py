"""Streaming queries over files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.hashing import squeeze, uniform
from textquarry.functions.pii import mask_pii
from textquarry.operators.filters import filter_min_words
from textquarry.plans import sqlbits as S
from textquarry.plans.dialogue_plans import _MERGED_SQL, translated_chunks
from textquarry.plans.registry import query
from textquarry.plans.text_plans import sql_mask_pii
from textquarry.session import scratch_path
from textquarry.streaming import documents as X


@query(
    "stream_documents", "R1 S4",
    f"SELECT doc_id, lang, md5({sql_mask_pii('text')}) AS digest FROM documents WHERE {S.n_words('text')} > 50",
)
def stream_documents(t):
    source, out, mark = (scratch_path(t.spark, x) for x in ("arriving", "clean", "progress"))
    # As many files as the table has splits, so that no task gets more of a larger table.
    files = max(4, t.documents.rdd.getNumPartitions())
    t.documents.repartition(files, "doc_id").select("doc_id", "lang", "text").write.json(source)
    stream = X.stream_documents(t.spark, source, "doc_id bigint, lang string, text string", files_per_batch=2)
    clean = X.compose(stream, [filter_min_words, mask_pii])
    X.run_to_parquet(clean.select("doc_id", "lang", F.md5("text").alias("digest")), out, mark)
    return t.spark.read.parquet(out)


@query("stream_resume", "R2", "SELECT doc_id, n_chars FROM documents")
def stream_resume(t):
    source, out, mark = (scratch_path(t.spark, x) for x in ("arriving", "copied", "progress"))
    early = uniform("doc_id", seed="early") < 0.5
    rows = t.documents.select("doc_id", "n_chars")

    def run():
        X.run_to_parquet(X.stream_documents(t.spark, source, "doc_id bigint, n_chars bigint", "parquet"), out, mark)

    rows.where(early).write.parquet(source)
    run()
    rows.where(~early).write.mode("append").parquet(source)
    run()
    run()
    return t.spark.read.parquet(out)


@query(
    "stream_merge_chunks", "R3",
    f"SELECT conv_id::VARCHAR AS id, outcome, digest FROM ({_MERGED_SQL}) ",
)
def merge_arriving_chunks(t):
    source, out, mark = (scratch_path(t.spark, x) for x in ("arriving", "merged", "progress"))
    start = F.lit("2025-01-01 00:00:00").cast("timestamp")
    chunks = translated_chunks(t).select(
        F.col("conv_id").cast("string").alias("id"), "text", F.col("chunk_id").cast("int").alias("chunk_id"),
        F.col("num_chunks").cast("int").alias("num_chunks"), "finish_reason", start.alias("arrived_at"),
    )
    schema = "id string, text string, chunk_id int, num_chunks int, finish_reason string, arrived_at timestamp"
    # Two waves: most documents need both.
    first = uniform("id", "chunk_id", seed="wave") < 0.5

    def run():
        stream = X.stream_merge_chunks(X.stream_documents(t.spark, source, schema, "parquet"))
        digest = F.when(F.col("outcome") != "incomplete", F.md5("text"))
        X.run_to_parquet(stream.select("id", "outcome", digest.alias("digest")), out, mark, **X.KEYED_STATE)

    chunks.where(first).write.parquet(source)
    run()
    chunks.where(~first).write.mode("append").parquet(source)
    run()
    # Time goes on: the first row moves the watermark, and the timers expire with the second.
    for days in (1, 2):
        later = F.date_add(start, days).cast("timestamp")
        clock = t.conversations.agg(F.count("*").alias("_n")).select(
            F.lit("").alias("id"), F.lit("").alias("text"), F.lit(-1).alias("chunk_id"), F.lit(-1).alias("num_chunks"),
            F.lit("").alias("finish_reason"), later.alias("arrived_at"),
        )
        clock.write.mode("append").parquet(source)
        run()
    return t.spark.read.parquet(out)


@query(
    "stream_dedup", "R5",
    f"""WITH c AS (SELECT doc_id, md5({S.squeeze('text')}) AS digest FROM documents)
        SELECT DISTINCT digest, 0 AS hour FROM c UNION ALL SELECT DISTINCT digest, 49 AS hour FROM c WHERE doc_id % 5 = 0""",
)
def stream_dedup(t):
    source, out, mark = (scratch_path(t.spark, x) for x in ("arriving", "first", "progress"))
    start = F.lit("2025-01-01 00:00:00").cast("timestamp")

    def arrive(docs, hour):
        at = (start + F.expr(f"INTERVAL {hour} HOURS")).alias("arrived_at")
        docs.select("text", F.lit(hour).alias("hour"), at).write.mode("append").parquet(source)
        stream = X.stream_documents(t.spark, source, "text string, hour int, arrived_at timestamp", "parquet")
        fresh = X.stream_dedup(stream, F.col("text"), "arrived_at", "2 hours")
        X.run_to_parquet(fresh.select(F.md5(squeeze(F.col("text"))).alias("digest"), "hour"), out, mark)

    clock = t.documents.agg(F.lit("the clock ticks").alias("text"))
    arrive(t.documents, 0)
    arrive(t.documents.where("doc_id % 3 = 0"), 1)  # remembered
    arrive(clock, 30)
    arrive(clock, 48)
    arrive(t.documents.where("doc_id % 5 = 0"), 49)  # forgotten since
    return t.spark.read.parquet(out).where("hour not in (30, 48)")


@query(
    "stream_step_stats", "R4",
    """SELECT event_type AS run, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*)::BIGINT AS steps, round(avg(value), 6) AS mean_step_seconds,
              max(value) AS max_step_seconds, bool_or(value > 200) AS over_limit FROM events GROUP BY ALL""",
)
def stream_step_stats(t):
    source, out, mark = (scratch_path(t.spark, x) for x in ("arriving", "live", "progress"))
    t.events.select(
        F.col("event_type").alias("run"), F.col("value").alias("step_seconds"), F.col("ts").cast("timestamp").alias("logged_at")
    ).repartition(4, "run").write.parquet(source)
    def run():
        stream = X.stream_documents(t.spark, source, "run string, step_seconds double, logged_at timestamp", "parquet")
        X.run_to_parquet(X.stream_step_stats(stream, "1 day", "60 days", limit=200), out, mark)

    run()
    # A last row far in the future moves the watermark past all windows.
    end = t.events.select((F.max("ts").cast("timestamp") + F.expr("INTERVAL 90 DAYS")).alias("logged_at"))
    end.select(F.lit("end").alias("run"), F.lit(0.0).alias("step_seconds"), "logged_at").write.mode("append").parquet(source)
    run()
    live = t.spark.read.parquet(out)
    return live.select(
        "run", F.date_format("window_start", "yyyy-MM-dd").alias("day"), "steps",
        F.round("mean_step_seconds", 6).alias("mean_step_seconds"), "max_step_seconds", "over_limit",
    )
