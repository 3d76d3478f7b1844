"""Counts, distributions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.hashing import content_hash
from textquarry.functions.labels import length_bucket
from textquarry.functions.pii import mask_phone, mask_pii
from textquarry.functions.text import PRETOKEN_PLAIN, n_words, pretokens
from textquarry.operators import aggregates as X
from textquarry.operators.dedup import first_of_copies
from textquarry.operators.filters import filter_min_words, url_host, url_path
from textquarry.plans import sqlbits as S
from textquarry.plans.filter_plans import _BUCKET
from textquarry.plans.registry import Tables, query
from textquarry.plans.text_plans import sql_mask_phone, sql_mask_pii


@query(
    "clean_corpus_report", "F6 T1 T2 D1 F12 A28",
    f"""WITH masked AS (SELECT doc_id, lang, {sql_mask_pii('text')} AS text FROM documents WHERE {S.n_words('text')} > 50),
        phones AS (SELECT doc_id, lang, {sql_mask_phone('text', 'lang')} AS text FROM masked),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY md5({S.squeeze('text')}) ORDER BY doc_id) AS rn FROM phones),
        sized AS (SELECT lang, length(text) AS n_chars, len(regexp_extract_all(text, '{PRETOKEN_PLAIN}')) AS n_tokens FROM firsts WHERE rn = 1)
        SELECT lang, {_BUCKET} AS length_bucket, count(*)::BIGINT AS docs, sum(n_tokens)::BIGINT AS tokens FROM sized GROUP BY ALL""",
)
def clean_corpus_report(t):
    docs = filter_min_words(t.documents.select("doc_id", "lang", "text"), 50)
    masked = mask_phone(mask_pii(docs))
    # The report needs no text after this point, so duplicates are settled on narrow rows.
    sized = masked.select(
        "doc_id", "lang", content_hash(F.col("text")).alias("content_hash"),
        length_bucket(F.length("text")).alias("length_bucket"),
        F.regexp_count("text", F.lit(PRETOKEN_PLAIN)).cast("bigint").alias("n_tokens"),
    )
    unique = first_of_copies(sized, ["doc_id"])
    return unique.groupBy("lang", "length_bucket").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


@query(
    "corpus_counts", "A1",
    f"SELECT lang, source, count(*)::BIGINT AS pages, sum({S.n_words('text')})::BIGINT AS words, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL",
)
def corpus_counts(t):
    return X.corpus_counts(t.documents, ["lang", "source"])


@query(
    "field_counts", "A1",
    f"""SELECT field, count(*)::BIGINT AS pages, sum({S.n_words('value')})::BIGINT AS words, sum(length(value))::BIGINT AS chars
        FROM (SELECT 'text' AS field, text AS value FROM documents UNION ALL SELECT 'source', source FROM documents) GROUP BY field""",
)
def field_counts(t):
    return X.field_counts(t.documents, "doc_id", ["text", "source"])


@query(
    "tokenizer_stats", "A2",
    f"""WITH d AS (SELECT lang, text, regexp_extract_all(text, '{PRETOKEN_PLAIN}') AS tok FROM documents),
        s AS (SELECT lang, count(*)::BIGINT AS pages, sum(len(string_split(text, chr(10) || chr(10))))::BIGINT AS paragraphs, sum(len(string_split(text, chr(10))))::BIGINT AS lines,
              sum({S.n_words('text')})::BIGINT AS words, sum(length(text))::BIGINT AS chars, sum(strlen(text))::BIGINT AS bytes,
              sum(length(text) - length(replace(text, ' ', '')))::BIGINT AS spaces, sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS linebreaks,
              sum(length(text) - length(replace(text, chr(9), '')))::BIGINT AS tabs, sum(len(regexp_extract_all(text, '[0-9]')))::BIGINT AS digits,
              sum(len(tok))::BIGINT AS tokens, sum(len(list_filter(tok, lambda x: regexp_matches(x, '^ +$'))))::BIGINT AS tokens_space,
              sum(len(list_filter(tok, lambda x: regexp_matches(x, '^\\n+$'))))::BIGINT AS tokens_linebreak, sum(len(list_filter(tok, lambda x: regexp_matches(x, '^\\t+$'))))::BIGINT AS tokens_tab,
              sum(len(list_filter(tok, lambda x: regexp_matches(x, '^[0-9]+$'))))::BIGINT AS tokens_digit, sum(len(list_filter(tok, lambda x: strlen(x) = 1)))::BIGINT AS tokens_single_byte
              FROM d GROUP BY lang)
        SELECT *, round(tokens::DOUBLE / words, 3) AS fertility, round(chars::DOUBLE / tokens, 3) AS chars_per_token FROM s""",
)
def tokenizer_stats(t):
    return X.tokenizer_stats(t.documents, pretokens(F.col("text"), PRETOKEN_PLAIN), ["lang"])


@query(
    "length_stats", "A3",
    """SELECT lang, sum(n_chars)::BIGINT AS total_tokens, count(*)::BIGINT AS total_sequences, min(n_chars) AS min_tokens, max(n_chars) AS max_tokens,
              round(sum(n_chars)::DOUBLE / count(*), 6) AS mean_tokens, quantile_cont(n_chars, 0.25)::DOUBLE AS Q1_tokens,
              quantile_cont(n_chars, 0.5)::DOUBLE AS Q2_tokens, quantile_cont(n_chars, 0.75)::DOUBLE AS Q3_tokens FROM documents GROUP BY lang""",
)
def length_stats(t):
    return X.length_stats(t.documents, ["lang"], F.col("n_chars")).withColumn("mean_tokens", F.round("mean_tokens", 6))


@query("length_histogram", "A4", "SELECT n_chars AS length, count(*)::BIGINT AS n FROM documents GROUP BY n_chars")
def length_histogram(t):
    return X.length_histogram(t.documents, F.col("n_chars"))


@query(
    "log_length_histogram", "A4",
    "SELECT lang, floor(log10(greatest(n_chars, 1)) * 10)::BIGINT AS log_bin, count(*)::BIGINT AS n FROM documents GROUP BY ALL",
)
def log_length_histogram(t):
    return X.log_histogram(t.documents, F.col("n_chars"), by=["lang"])


_ALPHABET_SQL = """WITH c AS (SELECT unnest(string_split(text, '')) AS char FROM documents), n AS (SELECT char, count(*)::BIGINT AS "count" FROM c WHERE char <> '' GROUP BY char)
   SELECT char, "count", unicode(char)::INT AS ord, CASE WHEN unicode(char) BETWEEN 65 AND 122 OR unicode(char) BETWEEN 192 AND 591 THEN 'LATIN'
     WHEN unicode(char) BETWEEN 880 AND 1023 THEN 'GREEK' WHEN unicode(char) BETWEEN 1536 AND 1791 OR unicode(char) BETWEEN 1872 AND 1919 OR unicode(char) BETWEEN 2208 AND 2303 THEN 'ARABIC'
     WHEN unicode(char) < 127 AND unicode(char) >= 32 AND char <> '$' OR unicode(char) IN (9, 10) THEN 'CODE' ELSE 'OTHER' END AS family FROM n"""


@query("char_alphabet", "A5", _ALPHABET_SQL)
def char_alphabet(t):
    return X.char_alphabet(t.documents).drop("category")


@query("select_alphabet", "A35")
def select_alphabet(t):
    return X.select_alphabet(X.char_alphabet(t.documents), 1000)


@query(
    "word_stats", "A6",
    rf"""WITH w AS (SELECT lang, {S.words('text')} AS w FROM documents)
         SELECT lang, count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS n_words,
                round(avg(length(list_aggregate(w, 'string_agg', ''))::DOUBLE / len(w)), 6) AS avg_word_length,
                round(avg(len(list_distinct(w))::DOUBLE / len(w)), 6) AS type_token_ratio,
                round(avg(len(list_filter(w, lambda x: lower(x) IN ('the', 'of', 'and', 'de', 'la', 'der', 'die', 'que')))::DOUBLE / len(w)), 6) AS stop_word_ratio
         FROM w WHERE len(w) > 0 GROUP BY lang""",
)
def word_stats(t):
    out = X.word_stats(t.documents, ["lang"])
    return out.select(
        "lang", "docs", "n_words", *[F.round(c, 6).alias(c) for c in ("avg_word_length", "type_token_ratio", "stop_word_ratio")]
    )


@query(
    "grouped_stats", "A7",
    """WITH e AS (SELECT event_type, user_id, 'value' AS metric, value AS v FROM events UNION ALL SELECT event_type, user_id, 'doubled', value * 2 FROM events),
            g AS (SELECT metric, CASE WHEN grouping(event_type) = 0 THEN 'event_type' WHEN grouping(user_id) = 0 THEN 'user_id' ELSE 'summary' END AS "group",
                  CASE WHEN grouping(event_type) = 0 THEN event_type WHEN grouping(user_id) = 0 THEN user_id::VARCHAR ELSE 'summary' END AS value,
                  sum(v) AS total, count(*)::BIGINT AS n FROM e GROUP BY GROUPING SETS ((metric), (metric, event_type), (metric, user_id)))
       SELECT "group", value, metric, round(total, 4) AS total, n, round(total / n, 6) AS mean FROM g""",
)
def grouped_stats(t):
    events = t.events.select("event_type", "user_id", "value", (F.col("value") * 2).alias("doubled"))
    out = X.grouped_stats(events, ["value", "doubled"], ["event_type", "user_id"])
    return out.select("group", "value", "metric", F.round("total", 4).alias("total"), "n", F.round("mean", 6).alias("mean"))


@query("metric_histogram", "A7", "SELECT round(value, 1) AS value, count(*)::BIGINT AS n FROM events GROUP BY 1")
def metric_histogram(t):
    return X.metric_histogram(t.events, "value", 1)


@query(
    "language_from_path", "A8",
    "SELECT split_part(url, '/', 4) AS language, count(*)::BIGINT AS n FROM pages GROUP BY 1",
)
def language_from_path(t):
    return t.pages.groupBy(F.regexp_extract("url", "^[a-z]+://[^/]+/([^/]+)/", 1).alias("language")).agg(F.count("*").alias("n"))


@query(
    "merged_stats", "A9",
    """SELECT l_returnflag, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS total, min(l_quantity) AS least, max(l_quantity) AS most,
              round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem GROUP BY l_returnflag""",
)
def merged_stats(t):
    shards = X.partial_stats(t.lineitem, ["l_returnflag", "l_linenumber"], "l_quantity")
    out = X.merge_stats(shards, ["l_returnflag"])
    return out.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "crosstab", "A10",
    """SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS "F", sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS "O",
              sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::BIGINT AS "P" FROM orders GROUP BY o_orderpriority""",
)
def crosstab(t):
    return X.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "crosstab_from_index", "A10",
    """SELECT quality::VARCHAR AS edu_score, toxic::VARCHAR AS cluster_size, count(*)::BIGINT AS n FROM labels GROUP BY ALL""",
)
def crosstab_from_index(t):
    index = F.concat(F.lit("edu_score_"), "quality", F.lit("_cluster_size-"), "toxic")
    pattern = r"edu_score_(\d+)_cluster_size-(.*)"
    grouped = t.labels.groupBy(index.alias("index")).agg(F.count("*").alias("n"))
    return grouped.select(
        F.regexp_extract("index", pattern, 1).alias("edu_score"), F.regexp_extract("index", pattern, 2).alias("cluster_size"), "n"
    )


@query(
    "classification_report", "A11",
    """WITH l AS (SELECT DISTINCT unnest([quality, toxic])::BIGINT AS label FROM labels),
        s AS (SELECT label, (SELECT count(*) FROM labels WHERE quality = label) AS support, (SELECT count(*) FROM labels WHERE toxic = label) AS predicted,
                     (SELECT count(*) FROM labels WHERE quality = label AND toxic = label) AS hits FROM l),
        p AS (SELECT label, support::BIGINT AS support, CASE WHEN predicted > 0 THEN hits::DOUBLE / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS r FROM s)
       SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, support FROM p""",
)
def classification_report(t):
    out = X.classification_report(t.labels, "quality", "toxic")
    return out.select(F.col("label").cast("bigint").alias("label"), *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("confusion_matrix", "A11", "SELECT quality AS \"true\", toxic AS pred, count(*)::BIGINT AS n FROM labels GROUP BY ALL")
def confusion_matrix(t):
    return X.confusion_matrix(t.labels, "quality", "toxic")


@query(
    "profile_columns", "A12",
    """SELECT 'quality' AS "column", quality::VARCHAR AS value, count(*)::BIGINT AS n FROM labels GROUP BY ALL
       UNION ALL SELECT 'toxic', toxic::VARCHAR, count(*)::BIGINT FROM labels GROUP BY ALL
       UNION ALL SELECT 'kind', CASE WHEN toxic = 1 THEN 'ad' ELSE 'text' END, count(*)::BIGINT FROM labels GROUP BY ALL""",
)
def profile_columns(t):
    labels = t.labels.withColumn("kind", F.when(F.col("toxic") == 1, "ad").otherwise("text"))
    return X.profile(labels, ["quality", "toxic", "kind"])


@query(
    "totals_by_label", "A13",
    "SELECT l_shipmode AS label, total FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, round(sum(l_extendedprice) / 1e6, 6) AS total FROM lineitem GROUP BY 1) WHERE total > 0",
)
def totals_by_label(t):
    lines = t.lineitem.withColumn("label", F.concat("l_returnflag", "l_linestatus"))
    return X.totals_by(lines, "label", "l_extendedprice", 1e6).withColumn("total", F.round("total", 6))


_FILE = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) || regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1)"


@query(
    "folder_sizes", "A14",
    f"""WITH f AS (SELECT string_split({_FILE}, '/') AS p, length(html) AS s FROM pages), e AS (SELECT p, s, unnest(range(1, len(p))) AS i FROM f)
        SELECT list_aggregate(p[1:i], 'string_agg', '/') AS folder, sum(s)::BIGINT AS size, sum(s) > 200000 AS big FROM e GROUP BY 1""",
)
def folder_sizes(t):
    path = F.concat(url_host(F.col("url")), url_path(F.col("url")))
    files = t.pages.select(path.alias("path"), F.length("html").cast("bigint").alias("size"))
    return X.folder_sizes(files, "path", "size").withColumn("big", F.col("size") > 200_000)


@query(
    "bucket_stats", "A28",
    f"SELECT {_BUCKET} AS bucket, count(*)::BIGINT AS docs, sum(n_chars)::BIGINT AS length FROM documents GROUP BY 1",
)
def bucket_stats(t):
    return t.documents.groupBy(length_bucket(F.col("n_chars")).alias("bucket")).agg(
        F.count("*").alias("docs"), F.sum("n_chars").alias("length")
    )


@query(
    "observed_counts", "A29",
    """SELECT count(*)::BIGINT AS total, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END)::BIGINT AS converted,
              sum(CASE WHEN role <> 'assistant' THEN 1 ELSE 0 END)::BIGINT AS skipped FROM conversations""",
)
def observed_counts(t):
    from textquarry.operators.runs import observed_counts as observed

    tests = {"converted": F.col("role") == "assistant", "skipped": F.col("role") != "assistant"}
    # A session of its own: once a session has observed something, ML transformers fail to
    # serialize in it (they would ship the session's observation registry).
    turns = Tables(t.spark.newSession(), t.folder).conversations
    counted, counts = observed(turns, tests)
    counted.write.format("noop").mode("overwrite").save()
    got = counts.get
    return t.spark.range(1).select(*[F.lit(got[k]).cast("bigint").alias(k) for k in ("total", "converted", "skipped")])


@query(
    "check_tokens", "A30",
    f"""WITH t AS (SELECT text, regexp_extract_all(text, '{PRETOKEN_PLAIN}') AS tok FROM documents)
        SELECT count(*)::BIGINT AS docs, sum(len(tok))::BIGINT AS tokens, sum(length(replace(list_aggregate(tok, 'string_agg', ''), chr(10), '\\n')))::BIGINT AS chars FROM t""",
)
def check_tokens(t):
    return X.check_tokens(t.documents.select(pretokens(F.col("text"), PRETOKEN_PLAIN).alias("tokens")))


_PRETOKENS_SQL = f"SELECT pretoken, count(*)::BIGINT AS n FROM (SELECT unnest(regexp_extract_all(text, '{PRETOKEN_PLAIN}')) AS pretoken FROM documents) GROUP BY pretoken"


@query("pretoken_counts", "A34", _PRETOKENS_SQL)
def pretoken_counts(t):
    return X.pretoken_counts(t.documents, pretokens(F.col("text"), PRETOKEN_PLAIN))


@query(
    "pair_counts", "A34",
    f"""WITH p AS ({_PRETOKENS_SQL}), i AS (SELECT pretoken, n, unnest(range(1, length(pretoken))) AS i FROM p)
        SELECT substr(pretoken, i, 1) AS "left", substr(pretoken, i + 1, 1) AS "right", sum(n)::BIGINT AS n FROM i GROUP BY ALL""",
)
def pair_counts(t):
    return X.pair_counts(X.pretoken_counts(t.documents, pretokens(F.col("text"), PRETOKEN_PLAIN)))
