"""Scans, checked by writing the given tables in each format and reading them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.plans.registry import query
from textquarry.session import scratch_path
from textquarry.sources import readers, writers
from textquarry.sources.zst import write_jsonl_zst


@query(
    "scan_jsonl_gz", "S1 K1",
    "SELECT doc_id::VARCHAR AS id, lang, length(text)::BIGINT AS n_chars, md5(text) AS digest FROM documents",
)
def scan_jsonl_gz(t):
    path = scratch_path(t.spark, "jsonl")
    docs = t.documents.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body"), "lang")
    docs.write.option("compression", "gzip").partitionBy("lang").json(path)
    back = readers.read_jsonl(t.spark, path, "key string, body string", "*.json.gz", "body", "key")
    lang = F.regexp_extract("_metadata.file_path", "lang=([^/]+)", 1)
    return back.select("id", lang.alias("lang"), F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query(
    "scan_jsonl_zst", "S1",
    "SELECT doc_id::VARCHAR AS id, lang, length(text)::BIGINT AS n_chars, md5(text) AS digest FROM documents",
)
def scan_jsonl_zst(t):
    path = scratch_path(t.spark, "jsonl-zst")
    write_jsonl_zst(t.documents.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("body"), "lang"), path)
    back = readers.read_jsonl(t.spark, path, "key string, body string, lang string", "*.jsonl.zst", "body", "key")
    return back.select("id", "lang", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query(
    "scan_parquet", "S2 S4",
    "SELECT doc_id AS id, n_chars, 'train' AS split FROM documents WHERE lang = 'fr'",
)
def scan_parquet(t):
    docs = readers.read_parquet(t.spark, f"{t.folder}/documents.parquet", "text", "doc_id", split="train")
    return docs.where("lang = 'fr'").select("id", "n_chars", "split")


@query(
    "scan_json_documents", "S3",
    "SELECT item_id::BIGINT AS item_id, md5(text) AS digest, 'mmlu' AS task FROM benchmark",
)
def scan_json_documents(t):
    path = scratch_path(t.spark, "json")
    # Each line is a whole file of at most 20 items: a JSON array.
    item = F.struct("item_id", F.col("text").alias("query"))
    files = t.benchmark.groupBy(F.floor(F.col("item_id") / 20).alias("file")).agg(
        F.to_json(F.collect_list(item)).alias("value")
    )
    files.write.partitionBy("file").text(path)
    docs = readers.read_json(t.spark, path, "item_id bigint, query string", "query", {"task": "mmlu"})
    return docs.select("item_id", F.md5("text").alias("digest"), "task")


@query(
    "scan_stats_csv", "S5 K5",
    """SELECT source AS name, sum(n_chars)::BIGINT AS total_tokens, count(*)::BIGINT AS total_sequences
       FROM documents GROUP BY source""",
)
def scan_stats_csv(t):
    path = scratch_path(t.spark, "csv")
    stats = t.documents.groupBy(F.col("source").alias("name")).agg(
        F.sum("n_chars").alias("total_tokens"), F.count("*").alias("total_sequences")
    )
    writers.write_summary(stats, path)
    return readers.read_stats_csv(
        t.spark, path, "name string, total_tokens bigint, total_sequences bigint"
    )


@query(
    "scan_markdown_table", "S6",
    "SELECT n_nationkey::BIGINT AS code, n_name AS name, (n_nationkey * 1234567)::BIGINT AS words FROM nation",
)
def scan_markdown_table(t):
    path = scratch_path(t.spark, "markdown")
    rows = t.nation.select(
        F.concat(
            F.lit("| "), F.col("n_nationkey"), F.lit(" | `"), F.col("n_name"), F.lit("` | "),
            F.format_number(F.col("n_nationkey").cast("bigint") * 1234567, 0), F.lit(" |"),
        ).alias("value")
    )
    head = t.region.where("r_regionkey = 0").select(
        F.explode(F.array(F.lit("| code | name | words |"), F.lit("|---|:---|---:|"))).alias("value")
    )
    head.union(rows).write.text(path)
    return readers.read_markdown_table(
        t.spark, path, [("code", "bigint"), ("name", "string"), ("words", "bigint")]
    )


@query(
    "scan_jsonl_comments", "S7",
    "SELECT r_name AS task, 'acc' AS metric, r_regionkey::BIGINT AS num_classes FROM region",
)
def scan_jsonl_comments(t):
    path = scratch_path(t.spark, "comments")
    line = F.to_json(F.struct(F.col("r_name").alias("task"), F.lit("acc").alias("metric"), F.col("r_regionkey").alias("num_classes")))
    both = F.array(F.concat(F.lit("  // about "), F.col("r_name")), line)
    t.region.select(F.explode(both).alias("value")).write.text(path)
    return readers.read_jsonl_comments(t.spark, path, "task string, metric string, num_classes bigint")


@query(
    "scan_eval_results", "S8",
    """SELECT l_returnflag AS task, m.metric, round(CASE WHEN m.metric = 'acc' THEN avg(l_discount) ELSE stddev_pop(l_discount) END, 6) AS score,
              '100' AS max_samples, '2025-01-02 03:04:05.000006' AS evaluated_at
       FROM lineitem, (VALUES ('acc'), ('acc_stderr')) m(metric) GROUP BY l_returnflag, m.metric""",
)
def scan_eval_results(t):
    path = scratch_path(t.spark, "eval")
    scores = t.lineitem.groupBy("l_returnflag").agg(
        F.create_map(
            F.lit("acc"), F.avg("l_discount"), F.lit("acc_stderr"), F.stddev_pop("l_discount")
        ).alias("metrics")
    )
    one_file = scores.select(
        F.create_map("l_returnflag", "metrics").alias("results"),
        F.struct(F.lit("100").alias("max_samples")).alias("config_general"),
        F.concat(F.lit("results_2025-01-02T03-04-05.000006_"), "l_returnflag").alias("file"),
    )
    one_file.write.partitionBy("file").json(path)
    long = readers.read_eval_results(t.spark, path)
    return long.select(
        "task", "metric", F.round("score", 6).alias("score"), "max_samples",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("evaluated_at"),
    )


@query(
    "scan_run_logs", "S9",
    """SELECT event_type AS run, event_id AS iteration, value AS step_seconds,
              strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS logged_at FROM events""",
)
def scan_run_logs(t):
    path = scratch_path(t.spark, "logs")
    line = F.format_string(
        "[%s] iteration %d/99999 | loss: 1.0 | train_step_timing in s: %s",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_id"), F.col("value").cast("string"),
    )
    t.events.select(line.alias("value"), F.col("event_type").alias("run")).write.partitionBy("run").text(path)
    logs = readers.read_run_logs(t.spark, path)
    return logs.select(
        F.regexp_extract("run", "run=([^/]+)/", 1).alias("run"), "iteration", "step_seconds",
        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss").alias("logged_at"),
    )


@query(
    "path_parts", "S10",
    """SELECT page_id, split_part(url, '/', 4) AS language, split_part(url, '/', 3) AS host,
              string_split(url, '/')[-1] AS last_part FROM pages""",
)
def path_parts(t):
    parts = {"language": 4, "host": 3, "last_part": -1}
    return readers.with_path_parts(t.pages, parts, F.col("url")).select("page_id", *parts)


@query(
    "scan_by_partition", "S11",
    "SELECT doc_id, source, lang FROM documents WHERE lang = 'de' AND source IN ('src1', 'src2')",
)
def scan_by_partition(t):
    path = scratch_path(t.spark, "layout")
    t.documents.select("doc_id", "source", "lang").write.partitionBy("lang", "source").parquet(path)
    back = t.spark.read.schema("doc_id bigint, lang string, source string").parquet(path)
    return back.where("lang = 'de' AND source IN ('src1', 'src2')").select("doc_id", "source", "lang")


@query(
    "scan_by_path_regex", "S12",
    "SELECT doc_id, lang FROM documents WHERE regexp_matches(lang, '^(fr|es)$')",
)
def scan_by_path_regex(t):
    path = scratch_path(t.spark, "regex")
    t.documents.select("doc_id", "lang").write.partitionBy("lang").parquet(path)
    back = t.spark.read.schema("doc_id bigint, lang string").parquet(path)
    return readers.filter_path_rlike(back, "lang=(fr|es)/").select("doc_id", "lang")


@query("scan_limit", "S13", "SELECT least(count(*), 100)::BIGINT AS n, least(count(DISTINCT doc_id), 100)::BIGINT AS ids FROM documents")
def scan_limit(t):
    rows = readers.read_parquet(t.spark, f"{t.folder}/documents.parquet", id_key="doc_id", limit=100)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@query(
    "scan_tolerant", "S14",
    """SELECT sum(CASE WHEN NOT contains(props, '7') THEN 1 ELSE 0 END)::BIGINT AS parsed,
              sum(CASE WHEN contains(props, '7') THEN 1 ELSE 0 END)::BIGINT AS corrupt FROM events""",
)
def scan_tolerant(t):
    path = scratch_path(t.spark, "broken")
    line = F.when(F.contains("props", F.lit("7")), F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props"))
    t.events.select(line.alias("value")).write.text(path)
    lines = readers.read_jsonl(t.spark, path, "k bigint, _corrupt_record string")
    # Counting needs a parsed column next to the raw line, or the parser is skipped.
    return readers.corrupt_counts(lines.select("_corrupt_record", "k").where("k IS NOT NULL OR _corrupt_record IS NOT NULL"))


@query("scan_shuffled", "S15", "SELECT doc_id, md5(text) AS digest FROM documents")
def scan_shuffled(t):
    return readers.read_shuffled(t.spark, [f"{t.folder}/documents.parquet"], "doc_id").select(
        "doc_id", F.md5("text").alias("digest")
    )


@query(
    "concat_sources", "S16 U1",
    """SELECT 'web' AS dataset, page_id AS id, length(html)::BIGINT AS n_chars, NULL::VARCHAR AS lang FROM pages
       UNION ALL SELECT 'docs', doc_id, n_chars, lang FROM documents
       UNION ALL SELECT 'bench', item_id, length(text)::BIGINT, NULL FROM benchmark""",
)
def concat_sources(t):
    return readers.concat_sources(
        {
            "web": t.pages.select(F.col("page_id").alias("id"), F.length("html").cast("bigint").alias("n_chars")),
            "docs": t.documents.select(F.col("doc_id").alias("id"), "n_chars", "lang"),
            "bench": t.benchmark.select(F.col("item_id").alias("id"), F.length("text").cast("bigint").alias("n_chars")),
        }
    )
