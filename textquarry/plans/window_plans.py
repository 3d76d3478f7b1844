"""Ordered operators and top-k reports.

The range size is set far below its default, so that the small test tables too
run through many ranges.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.operators import windows as X
from textquarry.operators.ordering import numbered
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import n_words, uniform
from textquarry.session import written


@query(
    "keep_latest", "W1",
    """SELECT user_id, event_type, props, max(ts)::VARCHAR AS latest FROM events GROUP BY user_id, event_type, props""",
)
def keep_latest(t):
    rows = t.events.select("user_id", "event_type", "props", "ts")
    from textquarry.operators.filters import latest_per_key

    latest = latest_per_key(rows, ["user_id", "event_type", "props"], ["ts"])
    return latest.select("user_id", "event_type", "props", F.col("ts").cast("string").alias("latest"))


@query(
    "group_runs", "W2",
    """WITH s AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY ts, event_id) THEN 1 ELSE 0 END AS st FROM events),
            r AS (SELECT *, sum(st) OVER (ORDER BY ts, event_id) AS run_id FROM s)
       SELECT run_id::BIGINT AS run_id, any_value(event_type) AS event_type, count(*)::BIGINT AS n, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS members
       FROM r GROUP BY run_id""",
)
def group_runs(t):
    events = t.events.select("ts", "event_id", "event_type", F.col("event_id").cast("string").alias("member"))
    runs = X.group_runs(events, ["ts", "event_id"], "event_type", ["member"], rows_per_range=50_000)
    return runs.select("run_id", "event_type", "n", F.array_join("member", ",").alias("members"))



@query(
    "take_until_budget", "W3",
    f"""SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY doc_id) AS running FROM documents) WHERE running <= 1500000""",
)
def take_until_budget(t):
    return X.take_until(t.documents, ["doc_id"], F.col("n_chars"), 1_500_000, rows_per_range=20_000).select("doc_id", "n_chars")


@query(
    "every_kth", "W4",
    "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n % 7 = 0",
)
def every_kth(t):
    return X.every_kth(t.orders, ["o_orderdate", "o_orderkey"], 7, rows_per_range=4_000).select("o_orderkey")


@query(
    "moving_average", "W5",
    """WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, round(avg(value), 4) AS v FROM events GROUP BY ALL),
            x AS (SELECT event_type, day, avg(v) OVER w AS s, count(*) OVER w AS n FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
       SELECT event_type, strftime(day, '%Y-%m-%d') AS day, round(s, 3) AS smoothed FROM x WHERE n = 5""",
)
def moving_average(t):
    daily = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.round(F.avg("value"), 4).alias("v"))
    out = X.moving_average(daily, "day", "v", 5, ["event_type"])
    return out.select("event_type", "day", F.round("smoothed", 3).alias("smoothed"))


@query(
    "pick_checkpoint", "W7",
    """WITH d AS (SELECT user_id, date_diff('day', TIMESTAMP '2023-12-31', ts)::DOUBLE AS tokens, min(value) AS score FROM events GROUP BY ALL)
       SELECT user_id, max(tokens) AS tokens, arg_max(score, tokens) AS score FROM d WHERE tokens <= 20 GROUP BY user_id""",
)
def pick_checkpoint(t):
    tokens = F.datediff(F.col("ts").cast("date"), F.lit("2023-12-31").cast("date")).cast("double")
    points = t.events.groupBy("user_id", tokens.alias("tokens")).agg(F.min("value").alias("score"))
    series = X.series_rows(points, ["user_id"], "tokens", ["score"])
    cut = X.truncate_series(series, "tokens", ["score"], 20).where(F.size("tokens") > 0)
    return X.pick_checkpoint(cut, ["tokens", "score"], -1)


_BINS_SQL = """WITH RECURSIVE o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
       r AS (SELECT doc_id, i, n_chars::BIGINT AS held, 0::BIGINT AS bin FROM o WHERE i = 1
             UNION ALL
             SELECT o.doc_id, o.i, CASE WHEN r.held + o.n_chars > 60000 THEN o.n_chars ELSE r.held + o.n_chars END,
                    CASE WHEN r.held + o.n_chars > 60000 THEN r.bin + 1 ELSE r.bin END FROM r JOIN o ON o.i = r.i + 1)
       SELECT doc_id, bin FROM r"""


@query("ordered_bins", "W8", _BINS_SQL)
def ordered_bins(t):
    return X.ordered_bins(t.documents, ["doc_id"], "n_chars", 60_000).select("doc_id", "bin")


@query("ordered_bins_doubling", "W8", _BINS_SQL)
def ordered_bins_doubling(t):
    return X.ordered_bins(t.documents, ["doc_id"], "n_chars", 60_000, rows_per_range=500).select("doc_id", "bin")


@query(
    "first_occurrence", "W9",
    """SELECT event_type, props, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY event_type, props""",
)
def first_occurrence(t):
    from textquarry.operators.filters import first_per_key

    return first_per_key(t.events.select("event_type", "props", "ts", "event_id"), ["event_type", "props"], ["ts", "event_id"]).select(
        "event_type", "props", "event_id"
    )


@query(
    "epoch_order", "W10",
    f"""WITH n AS (SELECT count(*) AS c FROM orders), e AS (SELECT o_orderkey, unnest(range(0, 3)) AS epoch FROM orders),
        s AS (SELECT o_orderkey, epoch, row_number() OVER (ORDER BY epoch, {uniform('o_orderkey', 'epoch', seed=7)}, o_orderkey) AS position FROM e)
        SELECT o_orderkey, epoch::INT AS epoch, position FROM s, n WHERE position <= c * 5 // 2""",
)
def epoch_order(t):
    wanted = t.orders.count() * 5 // 2
    return X.epoch_order(t.orders, "o_orderkey", wanted, seed=7, rows_per_range=20_000)


@query(
    "geometric_chunks", "W11",
    f"""WITH b AS (SELECT conv_id, turn, text, CASE WHEN {uniform('conv_id', 'turn')} < {1 / 3} THEN 1 ELSE 0 END AS e FROM conversations),
        c AS (SELECT *, coalesce(sum(e) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunk_id FROM b)
        SELECT conv_id, chunk_id, count(*)::BIGINT AS n, md5(string_agg(text, chr(10) ORDER BY turn)) AS digest FROM c GROUP BY conv_id, chunk_id""",
)
def geometric_chunks(t):
    chunks = X.geometric_chunks(t.conversations, "conv_id", "turn", ["text"])
    return chunks.select("conv_id", "chunk_id", "n", F.md5("text").alias("digest"))


@query(
    "last_per_configuration", "W12",
    "SELECT o_custkey, o_orderpriority, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price FROM orders GROUP BY ALL",
)
def last_per_configuration(t):
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_price")
    )


@query(
    "skip_warmup", "W13",
    """SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WHERE n > 5""",
)
def skip_warmup(t):
    rows = t.events.select("event_type", "event_id", "ts")
    steps = numbered(rows, ["ts", "event_id"], "n", partition=["event_type"], rows_per_range=50_000)
    return steps.where("n > 5").select("event_type", "event_id")


@query(
    "token_offsets", "W14",
    f"""WITH w AS (SELECT doc_id, {n_words('text')} AS n FROM documents)
        SELECT doc_id, (sum(n) OVER (ORDER BY doc_id) - n)::BIGINT AS "offset", (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_index FROM w""",
)
def token_offsets(t):
    from textquarry.functions.text import n_words as count_words

    sized = t.documents.select("doc_id", count_words(F.col("text")).alias("n"))
    return X.with_offsets(sized, ["doc_id"], F.col("n"), rows_per_range=20_000).drop("n")


@query(
    "share_of_total", "W15",
    "SELECT l_returnflag, l_linestatus, round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem), 6) AS share FROM lineitem GROUP BY ALL",
)
def share_of_total(t):
    from textquarry.operators.mixing import share

    totals = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"))
    return share(totals, "q", "share").select("l_returnflag", "l_linestatus", F.round("share", 6).alias("share"))


@query(
    "sorted_report", "O1",
    "SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY ALL ORDER BY n DESC, o_orderstatus, o_orderpriority",
)
def sorted_report(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "o_orderstatus", "o_orderpriority"
    )


@query(
    "top_means", "O2",
    "SELECT user_id, round(avg(value), 6) AS mean FROM events GROUP BY user_id ORDER BY round(avg(value), 6) DESC, user_id LIMIT 50",
)
def top_means(t):
    means = t.events.groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("mean")).dropna()
    return means.orderBy(F.desc("mean"), "user_id").limit(50)


@query(
    "plain_names_first", "O3",
    """SELECT name, (row_number() OVER (ORDER BY contains(name, '-'), name))::BIGINT AS position FROM
       (SELECT DISTINCT CASE WHEN p_size > 25 THEN replace(p_name, ' ', '-') ELSE replace(p_name, ' ', '_') END AS name FROM part)""",
)
def plain_names_first(t):
    sep = F.when(F.col("p_size") > 25, "-").otherwise("_")
    names = t.part.select(F.translate("p_name", " ", "\u0001").alias("n"), sep.alias("sep")).select(
        F.replace("n", F.lit("\u0001"), F.col("sep")).alias("name")
    ).distinct()
    keyed = names.withColumn("_h", F.contains("name", F.lit("-")))
    return numbered(keyed, ["_h", "name"], "position").drop("_h")


@query(
    "numeric_file_order", "O4",
    """SELECT file, (row_number() OVER (ORDER BY try_cast(regexp_extract(file, '(\\d+)_chunk_(\\d+)\\.jsonl\\.gz$', 1) AS INT) NULLS LAST,
              try_cast(regexp_extract(file, '(\\d+)_chunk_(\\d+)\\.jsonl\\.gz$', 2) AS INT) NULLS LAST, file))::BIGINT AS position FROM
       (SELECT CASE WHEN l_linenumber = 7 THEN 'part-' || l_orderkey || '-' || l_partkey || '-' || l_suppkey ELSE l_orderkey || '_chunk_' || l_partkey || '.jsonl.gz' END AS file FROM lineitem GROUP BY 1)""",
)
def numeric_file_order(t):
    name = F.when(
        F.col("l_linenumber") == 7, F.concat_ws("-", F.lit("part"), "l_orderkey", "l_partkey", "l_suppkey")
    ).otherwise(F.concat("l_orderkey", F.lit("_chunk_"), "l_partkey", F.lit(".jsonl.gz")))
    files = t.lineitem.select(name.alias("file")).distinct()
    pattern = r"(\d+)_chunk_(\d+)\.jsonl\.gz$"

    def part(i):
        # Names that do not match sort last.
        return F.coalesce(F.regexp_extract("file", pattern, i).try_cast("bigint"), F.lit(2**62))

    keyed = written(files.withColumns({"_a": part(1), "_b": part(2)}), "files")
    return numbered(keyed, ["_a", "_b", "file"], "position", rows_per_range=20_000).select("file", "position")


@query(
    "head_and_tail", "O5",
    """WITH n AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS a, row_number() OVER (ORDER BY doc_id DESC) AS b FROM documents)
       SELECT doc_id, CASE WHEN length(text) > 110 THEN substr(text, 1, 50) || ' ... ' || (length(text) - 100) || ' ... ' || right(text, 50) ELSE text END AS shown
       FROM n WHERE a <= 6 OR b <= 5""",
)
def head_and_tail(t):
    from textquarry.functions.text import truncate_marked

    return X.preview(t.documents.select("doc_id", "text"), ["doc_id"]).select("doc_id", truncate_marked(F.col("text")).alias("shown"))


@query(
    "most_frequent_words", "O6",
    """SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+')) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT 100""",
)
def most_frequent_words(t):
    from textquarry.functions.text import words
    from textquarry.operators.aggregates import most_frequent

    return most_frequent(t.documents.select(F.explode(words(F.col("text"))).alias("word")), "word", 100)


@query(
    "long_examples", "O7",
    f"SELECT doc_id, {n_words('text')} AS words FROM documents WHERE {n_words('text')} > 1000 ORDER BY doc_id LIMIT 10",
)
def long_examples(t):
    from textquarry.functions.text import n_words as count_words

    counted = t.documents.select("doc_id", count_words(F.col("text")).alias("words"))
    return counted.where("words > 1000").orderBy("doc_id").limit(10)
