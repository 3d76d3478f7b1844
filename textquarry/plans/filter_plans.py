"""Filters over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions import labels as L
from textquarry.functions.hashing import uniform
from textquarry.operators import filters as X
from textquarry.operators.reference_lists import KNOWN_URL_PREFIXES, expand_prefixes
from textquarry.plans import sqlbits as S
from textquarry.plans.registry import query

# The given pages live on example hosts, so prefixes for them extend the fixed list.
PAGE_PREFIXES = ["www.cheap-pills.example.com/", "spam-farm.", "blog.ththan.example.net/{lan}/", "m.{lan}.example"]
ALL_PREFIXES = expand_prefixes(KNOWN_URL_PREFIXES + PAGE_PREFIXES)
_PREFIX_ROWS = ", ".join(f"({i}, '{p}')" for i, p in enumerate(ALL_PREFIXES))
_HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"
_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1)"


@query(
    "known_url_reasons", "F1 J5",
    f"""WITH p(ord, prefix) AS (VALUES {_PREFIX_ROWS})
        SELECT page_id, 'duplicate_url:' || arg_min(p.prefix, p.ord) AS drop_reason
        FROM pages LEFT JOIN p ON starts_with(regexp_replace(url, '^[a-z]+://', ''), p.prefix) GROUP BY page_id""",
)
def known_url_reasons(t):
    return X.tag_known_urls(t.pages, prefixes=ALL_PREFIXES).select("page_id", "drop_reason")


@query(
    "filter_known_urls_raw", "F1",
    f"""WITH p(ord, prefix) AS (VALUES {_PREFIX_ROWS})
        SELECT page_id FROM pages WHERE NOT EXISTS (SELECT 1 FROM p WHERE starts_with(url, p.prefix))""",
)
def filter_known_urls_raw(t):
    return X.filter_known_urls(t.pages, prefixes=ALL_PREFIXES, strip_scheme=False).select("page_id")


@query(
    "prefix_join", "J5",
    f"""WITH p AS (SELECT DISTINCT {_HOST} || '/' || split_part(url, '/', 4) AS prefix FROM pages
                  UNION SELECT DISTINCT {_HOST} FROM pages),
        u AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS target FROM pages)
        SELECT page_id, prefix, length(prefix)::INT AS n FROM u JOIN p ON length(prefix) > 0 AND starts_with(target, prefix)""",
)
def prefix_join(t):
    from textquarry.operators.joins import prefix_join as join

    host = X.url_host(F.col("url"))
    folder = F.concat(host, F.lit("/"), F.coalesce(F.get(F.split("url", "/"), F.lit(3)), F.lit("")))
    prefixes = t.pages.select(folder.alias("prefix")).union(t.pages.select(host)).distinct()
    targets = t.pages.select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("target"))
    return join(targets, prefixes.withColumn("n", F.length("prefix")), "page_id", "target")


@query(
    "known_url_first_prefix", "F1 J5",
    f"""WITH p(ord, prefix) AS (VALUES {_PREFIX_ROWS})
        SELECT page_id, arg_min(p.prefix, p.ord) AS prefix
        FROM pages JOIN p ON starts_with(regexp_replace(url, '^[a-z]+://', ''), p.prefix) GROUP BY page_id""",
)
def known_url_first_prefix(t):
    from textquarry.operators.joins import first_prefix

    prefixes = t.spark.createDataFrame(list(enumerate(ALL_PREFIXES)), "ord int, prefix string")
    return first_prefix(t.pages.withColumn("url", F.regexp_replace("url", "^[a-z]+://", "")), prefixes, "page_id", "url")


def crawl_rules(t):
    """Crawl rules derived from the pages: one rule per host and first folder."""
    host = X.url_host(F.col("url"))
    path = F.concat(F.lit("/"), F.get(F.split("url", "/"), F.lit(3)), F.lit("/"))
    rules = t.pages.select(host.alias("host"), path.alias("path")).distinct()
    return rules.where(uniform("host", seed="seen") < 0.8).select(
        "host", "path",
        (uniform("host", "path", seed="allow") < 0.6).alias("allow"),
        (uniform("host", seed="malformed") < 0.1).alias("malformed"),
    )


@query(
    "robots_reasons", "F2 J7",
    f"""WITH raw AS (SELECT DISTINCT {_HOST} AS host, '/' || split_part(url, '/', 4) || '/' AS path FROM pages),
        rules AS (SELECT host, path, {S.uniform('host', 'path', seed='allow')} < 0.6 AS allow,
                         {S.uniform('host', seed='malformed')} < 0.1 AS malformed
                  FROM raw WHERE {S.uniform('host', seed='seen')} < 0.8),
        sites AS (SELECT host, bool_or(malformed) AS malformed FROM rules GROUP BY host),
        best AS (SELECT page_id, arg_max(allow, length(path)) AS allow FROM pages JOIN rules r
                 ON {_HOST} = r.host AND starts_with({_PATH}, r.path) GROUP BY page_id)
        SELECT page_id, CASE WHEN s.host IS NULL THEN 'robots:unknown_host' WHEN s.malformed THEN NULL
               WHEN NOT coalesce(b.allow, TRUE) THEN 'robots:disallowed' END AS drop_reason
        FROM pages LEFT JOIN sites s ON {_HOST} = s.host LEFT JOIN best b USING (page_id)""",
)
def robots_reasons(t):
    return X.tag_robots(t.pages, crawl_rules(t)).select("page_id", "drop_reason")


def agent_rules(t):
    """Rules per host with agents, a wildcard and an end mark, from the pages' own targets."""
    target = X.url_target(F.col("url"))
    rules = t.pages.select(X.url_host(F.col("url")).alias("host"), F.substr(target, F.lit(1), F.lit(6)).alias("p"), target.alias("whole"))
    kinds = F.array(
        F.struct(F.lit("*").alias("agent"), F.concat("p", F.lit("*7")).alias("path"), F.lit(False).alias("allow")),
        F.struct(F.lit("OurBot").alias("agent"), F.concat("whole", F.lit("$")).alias("path"), F.lit(True).alias("allow")),
        F.struct(F.lit("ourbot").alias("agent"), F.col("p").alias("path"), F.lit(False).alias("allow")),
    )
    named = rules.select("host", F.explode(kinds).alias("k")).select("host", "k.*").distinct()
    # Half of the hosts name the agent.
    seen = named.where((F.col("agent") == "*") | (uniform("host", seed="agent") < 0.5))
    return seen.where((F.col("allow") == F.lit(False)) | (uniform("path", seed="exact") < 0.5)).withColumn("malformed", F.lit(False))


_TARGET = "(CASE WHEN starts_with(t0, '/') THEN t0 ELSE '/' || t0 END)"
_AGENT_SQL = f"""WITH u AS (SELECT page_id, {_HOST} AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([/?][^#]*)', 1) AS t0 FROM pages),
        g AS (SELECT page_id, host, {_TARGET} AS target FROM u),
        named AS (SELECT DISTINCT host, {S.uniform('host', seed='agent')} < 0.5 AS own FROM g),
        p AS (SELECT DISTINCT host, substr(target, 1, 6) AS p FROM g),
        e AS (SELECT DISTINCT host, target FROM g WHERE {S.uniform("(target || '$')", seed='exact')} < 0.5),
        common AS (SELECT page_id, bool_or(starts_with(g.target, p.p) AND contains(substr(g.target, length(p.p) + 1), '7')) AS hit FROM g JOIN p USING (host) GROUP BY page_id),
        mine AS (SELECT page_id, bool_or(starts_with(g.target, p.p)) AS hit, max(CASE WHEN starts_with(g.target, p.p) THEN length(p.p) END) AS n FROM g JOIN p USING (host) GROUP BY page_id),
        exact AS (SELECT page_id, count(e.target) > 0 AS hit FROM g LEFT JOIN e ON e.host = g.host AND e.target = g.target GROUP BY page_id)"""


@query(
    "robots_agent", "F2 J7",
    f"""{_AGENT_SQL} SELECT page_id, CASE WHEN own THEN CASE WHEN exact.hit THEN NULL WHEN mine.hit THEN 'robots:disallowed' END
               WHEN common.hit THEN 'robots:disallowed' END AS drop_reason
        FROM g JOIN named USING (host) JOIN common USING (page_id) JOIN mine USING (page_id) JOIN exact USING (page_id)""",
)
def robots_agent(t):
    return X.tag_robots(t.pages, agent_rules(t), agent="OurBot").select("page_id", "drop_reason")


@query(
    "robots_must_allow", "F2 J7",
    f"""{_AGENT_SQL} SELECT page_id, CASE WHEN own AND exact.hit THEN NULL ELSE 'robots:disallowed' END AS drop_reason
        FROM g JOIN named USING (host) JOIN exact USING (page_id)""",
)
def robots_must_allow(t):
    return X.tag_robots(t.pages, agent_rules(t), agent="OurBot", must_allow=True).select("page_id", "drop_reason")


@query(
    "latest_rules", "F3 W1 W12",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_rules(t):
    return X.latest_per_key(t.events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


@query("filter_language_list", "F4", "SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'de', 'it')")
def filter_language_list(t):
    return X.filter_in(t.documents, "lang", ["fr", "de", "it"]).select("doc_id", "lang")


@query("filter_min_words", "F6", f"SELECT doc_id FROM documents WHERE {S.n_words('text')} > 50")
def filter_min_words(t):
    return X.filter_min_words(t.documents, 50).select("doc_id")


_STARS = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE floor(o_totalprice / 100000)::BIGINT END"


@query(
    "filter_min_or_missing", "F7",
    f"SELECT o_orderkey FROM orders WHERE coalesce({_STARS} >= 2, TRUE)",
)
def filter_min_or_missing(t):
    stars = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 100000))
    return X.filter_min_or_missing(t.orders.withColumn("stars", stars), "stars", 2).select("o_orderkey")


@query("filter_not_in", "F8", "SELECT doc_id FROM documents WHERE source NOT IN ('src0', 'src7')")
def filter_not_in(t):
    return X.filter_not_in(t.documents, "source", ["src0", "src7"]).select("doc_id")


@query(
    "filter_quality", "F9",
    """SELECT event_id, printf('%.2f', round_even(value / 100 / 0.05, 0) * 0.05) AS quality_score_rounded
       FROM events WHERE event_type <> 'click' AND value / 100 > 0.5""",
)
def filter_quality(t):
    scored = t.events.withColumn("score", F.when(F.col("event_type") != "click", F.col("value") / 100))
    return X.filter_quality(scored, "score").select(
        "event_id", L.rounded_quality(F.col("score")).alias("quality_score_rounded")
    )


@query(
    "expected_score", "F10",
    """SELECT doc_id, round((quality * 0.25 + 2 * toxic * 0.5 + 3 * 0.25)::DOUBLE, 6) AS edu_score_mean,
              round_even(quality * 0.25 + 2 * toxic * 0.5 + 3 * 0.25, 0)::BIGINT AS edu_score FROM labels""",
)
def expected_score(t):
    probs = F.create_map(
        F.concat(F.lit("__label__"), F.col("quality").cast("string")), F.lit(0.25),
        F.concat(F.lit("x__label__"), (F.col("toxic") * 2).cast("string")), F.lit(0.5),
        F.lit("__label__3"), F.lit(0.25),
    )
    mean = L.expected_score(probs)
    return t.labels.select("doc_id", F.round(mean, 6).alias("edu_score_mean"), F.bround(mean, 0).cast("bigint").alias("edu_score"))


@query(
    "cluster_bucket", "F11 D2",
    f"""WITH c AS (SELECT doc_id, count(*) OVER (PARTITION BY md5({S.squeeze('text')})) AS n FROM documents)
        SELECT doc_id, n::BIGINT AS minhash_cluster_size, CASE WHEN n BETWEEN 1 AND 4 THEN 'cluster_size-' || n
               WHEN n < 100 THEN 'cluster_size-5-100' WHEN n < 1000 THEN 'cluster_size-100-1000'
               ELSE 'cluster_size-1000+' END AS cluster_size_group FROM c""",
)
def cluster_bucket(t):
    from textquarry.operators.dedup import with_cluster_size

    sized = with_cluster_size(t.documents, "minhash_cluster_size")
    return sized.select("doc_id", "minhash_cluster_size", L.cluster_bucket(F.col("minhash_cluster_size")).alias("cluster_size_group"))


_BUCKET = """CASE WHEN n_chars < 4096 THEN '0-4k' WHEN n_chars < 16384 THEN '4k-16k'
             WHEN n_chars < 65536 THEN '16k-64k' ELSE '64k+' END"""


@query("length_bucket", "F12", f"SELECT doc_id, {_BUCKET} AS bucket FROM documents")
def length_bucket(t):
    return t.documents.select("doc_id", L.length_bucket(F.col("n_chars")).alias("bucket"))


@query(
    "prompt_level", "F13",
    """SELECT doc_id, CASE WHEN contains(text, 'ingthe') THEN 'easy' WHEN contains(text, 'onhe') THEN 'medium'
              WHEN contains(text, 'eaux') THEN 'hard' ELSE 'unknown' END AS prompt_level FROM documents""",
)
def prompt_level(t):
    levels = [("ingthe", "easy"), ("onhe", "medium"), ("eaux", "hard")]
    return t.documents.select("doc_id", L.prompt_level(F.col("text"), levels).alias("prompt_level"))


def books(t):
    """Books derived from orders; a customer is the author, and a third of the dates is missing."""
    lived = F.floor(F.col("o_totalprice") / 5000).cast("int")
    dated = F.col("o_orderstatus") != "P"
    return t.orders.select(
        F.col("o_orderkey").alias("book_id"),
        F.col("o_custkey").alias("author"),
        F.when(dated, F.lit(1800) + lived).alias("birth"),
        F.when(dated & (F.col("o_orderpriority") != "5-LOW"), F.lit(1870) + lived).alias("death"),
        F.when(F.col("o_orderstatus") == "F", "fr").otherwise("en").alias("language"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "copyright").otherwise("free").alias("rights"),
    )


@query(
    "filter_public_domain", "F14 W6",
    """WITH books AS (SELECT o_orderkey AS book_id, o_custkey AS author,
               CASE WHEN o_orderstatus <> 'P' THEN 1800 + floor(o_totalprice / 5000)::INT END AS birth,
               CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN 1870 + floor(o_totalprice / 5000)::INT END AS death,
               CASE WHEN o_orderstatus = 'F' THEN 80 ELSE 70 END AS thr,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'copyright' ELSE 'free' END AS rights FROM orders),
        f AS (SELECT *, first_value(birth) OVER w AS b0, first_value(death) OVER w AS d0 FROM books
              WINDOW w AS (PARTITION BY author ORDER BY book_id)),
        g AS (SELECT book_id, thr, rights, CASE WHEN birth IS NULL AND death IS NULL THEN b0 ELSE birth END AS birth,
                     CASE WHEN birth IS NULL AND death IS NULL THEN d0 ELSE death END AS death FROM f)
        SELECT book_id, birth, death FROM g WHERE rights <> 'copyright' AND
          CASE WHEN death IS NOT NULL THEN death <= 2025 - thr WHEN birth IS NOT NULL THEN birth <= 2025 - thr - 80 ELSE TRUE END""",
)
def filter_public_domain(t):
    return X.filter_public_domain(books(t)).select("book_id", "birth", "death")


@query(
    "filter_path", "F15",
    "SELECT page_id FROM pages WHERE contains(url, '/fr/') OR contains(url, 'blog.')",
)
def filter_path(t):
    return X.filter_path_contains(t.pages, "url", ["/fr/", "blog."]).select("page_id")


@query("filter_success", "F16", "SELECT event_id FROM events WHERE event_type <> 'error'")
def filter_success(t):
    return t.events.withColumn("success", F.col("event_type") != "error").where("success").select("event_id")


@query(
    "filter_rag_rows", "F17",
    """SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 1""",
)
def filter_rag_rows(t):
    rows = t.labels.select(
        "doc_id", (F.col("toxic") == 1).alias("is_unanswerable"), (F.col("quality") == 1).alias("eval_answer_correct"),
        F.when(F.col("quality") == 1, F.lit(1.0)).alias("eval_chunk_f1"),
    )
    return X.filter_rag(rows).select("doc_id")


@query(
    "select_checkpoints", "F19",
    """SELECT o_orderkey, o_orderkey AS step FROM orders
       WHERE o_orderkey + 1 >= 500 AND (o_orderkey + 1) % 250 = 0 AND o_orderstatus <> 'P'""",
)
def select_checkpoints(t):
    last = F.when(F.col("o_orderstatus") == "P", "-last").otherwise("")
    named = t.orders.withColumn("checkpoint", F.concat(F.lit("model--step="), F.col("o_orderkey"), last))
    return X.select_checkpoints(named, min_step=500, multiple_of=250).select("o_orderkey", "step")


@query(
    "keep_complete_groups", "F20",
    """WITH need AS (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem),
        full_sets AS (SELECT l_partkey FROM (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem)
                 GROUP BY l_partkey HAVING count(*) = (SELECT count(*) FROM need))
        SELECT l_partkey, count(*)::BIGINT AS lines FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM full_sets) GROUP BY l_partkey""",
)
def keep_complete_groups(t):
    need = t.lineitem.select("l_returnflag", "l_linestatus").distinct()
    return X.keep_complete(t.lineitem, need, "l_partkey").groupBy("l_partkey").agg(F.count("*").alias("lines"))


@query(
    "pair_membership", "F21 J10",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber FROM lineitem WHERE (l_returnflag, l_linestatus) IN
       (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_discount > 0.099)""",
)
def pair_membership(t):
    pairs = t.lineitem.where("l_discount > 0.099").select("l_returnflag", "l_linestatus").distinct()
    return t.lineitem.join(pairs, ["l_returnflag", "l_linestatus"], "left_semi").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber")
    )


@query("non_null_labels", "F22", "SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def non_null_labels(t):
    return t.documents.join(t.labels, "doc_id", "left").dropna(subset=["quality"]).select("doc_id")
