"""Joins, set operations and contamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.operators import decontamination as C
from textquarry.operators import joins as J
from textquarry.operators.dialogue import pair_by_position
from textquarry.operators.ordering import numbered
from textquarry.operators.windows import ordered_distinct
from textquarry.plans.registry import query


@query(
    "join_one_to_one", "J1 D4",
    """SELECT c.n_nationkey::BIGINT AS nationkey, n_name, customers FROM (SELECT c_nationkey AS n_nationkey, count(*)::BIGINT AS customers FROM customer GROUP BY 1) c
       LEFT JOIN nation n USING (n_nationkey)""",
)
def join_one_to_one(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    joined = J.join_1to1(counts, t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return joined.select(F.col("n_nationkey").cast("bigint").alias("nationkey"), "n_name", "customers")


@query(
    "duplicate_names", "D4",
    "SELECT p_name AS name, count(*)::BIGINT AS n FROM part GROUP BY p_name HAVING count(*) > 1",
)
def duplicate_names(t):
    from textquarry.operators.dedup import duplicate_names as dup

    return dup(t.part.withColumnRenamed("p_name", "name"))


@query(
    "outer_join_filled", "J2",
    """WITH a AS (SELECT o_custkey AS key, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            b AS (SELECT o_custkey AS key, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
       SELECT key, coalesce(a.n, 0) AS n_1, coalesce(b.n, 0) AS n_2 FROM a FULL JOIN b USING (key)""",
)
def outer_join_filled(t):
    def counted(status):
        return t.orders.where(F.col("o_orderstatus") == status).groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n"))

    return J.outer_fill(counted("F"), counted("P"), "key")


@query(
    "lookup_metadata", "J3",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, p_brand, s_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey",
)
def lookup_metadata(t):
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = J.lookup(J.lookup(t.lineitem, parts, "l_partkey"), suppliers, "l_suppkey")
    return joined.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "p_brand", "s_name")


@query(
    "join_task_info", "J4",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, o.o_orderpriority AS language FROM lineitem JOIN
       (SELECT o_orderkey, o_orderpriority FROM orders) o ON o_orderkey = l_orderkey WHERE l_returnflag = 'A'""",
)
def join_task_info(t):
    scores = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.concat(F.lit("suite|task"), "l_orderkey", F.lit("|5")).alias("task"), F.col("l_returnflag").alias("metric"),
    )
    info = t.orders.select(
        F.concat(F.lit("suite|task"), "o_orderkey").alias("task"), F.lit("A").alias("metric"), F.col("o_orderpriority").alias("language")
    )
    return J.join_task_info(scores, info).select("l_orderkey", "l_linenumber", "language")


_NGRAM_SQL = """string_split(trim(regexp_replace(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}} \\t\\n\\r\\f\\x0B]', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')), ' ')"""


def _contaminated_sql(n: int) -> str:
    def grams(table, key, text):
        cut = f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"
        return f"SELECT {key} AS k, unnest({cut}) AS g FROM (SELECT {key}, {_NGRAM_SQL.format(text)} AS w FROM {table})"

    return f"""SELECT DISTINCT d.k FROM ({grams('documents', 'doc_id', 'text')}) d
               WHERE d.g IN (SELECT g FROM ({grams('benchmark', 'item_id', 'text')}))"""


@query(
    "decontaminate_removed", "J6",
    f"SELECT doc_id, n_chars FROM documents WHERE doc_id IN ({_contaminated_sql(13)})",
)
def decontaminate_removed(t):
    return C.decontaminate(t.documents, C.build_ngram_index(t.benchmark))[1].select("doc_id", "n_chars")


@query(
    "decontaminate_clean", "J6",
    f"SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN ({_contaminated_sql(13)})",
)
def decontaminate_clean(t):
    # A filter far too small for the index: nearly everything passes it, and the exact joins decide.
    return C.decontaminate(t.documents, C.build_ngram_index(t.benchmark), bloom_words=16)[0].select("doc_id", "n_chars")


@query(
    "decontaminate_query", "J6",
    f"SELECT doc_id, n_chars FROM documents WHERE doc_id IN ({_contaminated_sql(13)})",
)
def decontaminate_query(t):
    # Each item is a query and its answer; together with the seam they have the n-grams of the whole.
    w = C.normalized_words(F.col("text"))
    half = F.greatest(F.floor(F.size(w) / 2).cast("int"), F.lit(0))
    items = t.benchmark.select(
        F.array_join(F.slice(w, F.lit(1), half), " ").alias("query"), F.array_join(F.slice(w, half + 1, F.size(w)), " ").alias("text")
    )
    return C.decontaminate(t.documents, C.build_ngram_index(items, query="query"))[1].select("doc_id", "n_chars")


@query(
    "parameter_grid", "J9",
    """SELECT n_name, r.length FROM nation, (VALUES (4096), (8192), (16384)) r(length)
       WHERE NOT (n_name = 'NATION_3' AND r.length = 4096)""",
)
def parameter_grid(t):
    return J.parameter_grid(t.nation, "length", [4096, 8192, 16384], [("NATION_3", 4096)], key="n_name").select("n_name", "length")


@query(
    "explode_questions", "J11",
    """WITH lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem),
            docs AS (SELECT l_orderkey, max(rn) AS n FROM lines GROUP BY 1)
       SELECT l_orderkey || '_q' || rn AS id, CASE l_returnflag WHEN 'A' THEN l_partkey || ', ' || l_suppkey WHEN 'N' THEN l_quantity::BIGINT::VARCHAR ELSE l_linestatus END AS answer,
              CASE l_returnflag WHEN 'A' THEN 'multi-span' WHEN 'N' THEN 'count' ELSE 'span' END AS answer_type,
              CASE l_linestatus WHEN 'O' THEN 'Table|Paragraph ' || rn ELSE 'Paragraph ' || rn END AS titles,
              (n + 1)::INT AS chunks FROM lines JOIN docs USING (l_orderkey)""",
)
def explode_questions(t):
    lines = numbered(
        t.lineitem, ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "rn", partition=["l_orderkey"]
    )
    quoted = F.concat(F.lit('["'), "l_partkey", F.lit('", "'), "l_suppkey", F.lit('"]'))
    question = F.struct(
        F.concat(F.lit("q"), "rn").alias("uid"), F.lit("which?").alias("question"),
        F.when(F.col("l_returnflag") == "A", quoted).when(F.col("l_returnflag") == "N", F.col("l_quantity").cast("string"))
        .otherwise(F.concat(F.lit('"'), "l_linestatus", F.lit('"'))).alias("answer"),
        F.when(F.col("l_returnflag") == "A", "multi-span").when(F.col("l_returnflag") == "N", "count").otherwise("span").alias("answer_type"),
        F.when(F.col("l_linestatus") == "O", "table-text").otherwise("text").alias("answer_from"),
        F.lit("").alias("scale"), F.array(F.col("rn").cast("string")).alias("rel_paragraphs"),
    )
    # One order is one document: a handful of lines.
    docs = lines.groupBy(F.col("l_orderkey").cast("string").alias("table_uid")).agg(
        F.collect_list(F.struct(F.col("rn").cast("int").alias("order"), F.col("l_returnflag").alias("text"))).alias("paragraphs"),
        F.collect_list(question).alias("questions"),
        F.array(F.array(F.lit("price")), F.array(F.max("l_extendedprice").cast("string"))).alias("table"),
    )
    rows = J.explode_questions(docs)
    return rows.select(
        "id", "answer", "answer_type", F.array_join("supporting_facts.title", "|").alias("titles"), F.size("context.title").alias("chunks")
    )


@query(
    "pair_by_position", "J12",
    """WITH u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
            a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant')
       SELECT u.conv_id, u.pos, md5(u.text) AS left_value, md5(a.text) AS right_value FROM u LEFT JOIN a ON u.conv_id = a.conv_id AND u.pos = a.pos AND u.n = a.n""",
)
def pair_positions(t):
    def side(role):
        rows = t.conversations.where(F.col("role") == role).select("conv_id", "turn", F.md5("text").alias("digest"))
        return numbered(rows, ["turn"], "pos", partition=["conv_id"])

    return pair_by_position(side("user"), side("assistant"), "conv_id", "pos", "digest")


@query(
    "attach_labels", "J13",
    "SELECT doc_id, quality::BIGINT AS quality, toxic::BIGINT AS toxic, md5(replace(text, chr(10), ' ')) AS digest FROM documents JOIN labels USING (doc_id)",
)
def attach_labels(t):
    digest = F.md5(F.replace("text", F.lit("\n"), F.lit(" ")))
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("quality").cast("bigint").alias("quality"), F.col("toxic").cast("bigint").alias("toxic"), digest.alias("digest")
    )


@query(
    "union_all", "U1",
    """SELECT o_orderkey AS key, 'order' AS kind FROM orders UNION ALL SELECT l_orderkey, 'line' FROM lineitem""",
)
def union_all(t):
    return J.concat(
        [
            t.orders.select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind")),
            t.lineitem.select(F.col("l_orderkey").alias("key"), F.lit("line").alias("kind")),
        ]
    )


@query(
    "compare_sets", "U2",
    """WITH a AS (SELECT DISTINCT lang, source FROM documents WHERE n_chars > 2000), b AS (SELECT DISTINCT lang, source FROM documents WHERE n_chars < 150)
       SELECT *, 'missing' AS status FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def compare_sets(t):
    return J.compare_sets(t.documents.where("n_chars > 2000"), t.documents.where("n_chars < 150"), "source", ["lang"])


@query(
    "intersect_keys", "U3",
    "SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
)
def intersect_keys(t):
    key = F.col("o_custkey").alias("key")
    return t.orders.where("o_orderstatus = 'F'").select(key).intersect(t.orders.where("o_orderstatus = 'P'").select(key))


@query("distinct_rows", "U4", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("bigint").alias("l_linenumber")).distinct()


@query(
    "ordered_distinct", "U5",
    """WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\n]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^ \\n]+'), 1) AS i FROM documents),
            f AS (SELECT doc_id, word, min(i) AS i FROM w GROUP BY ALL)
       SELECT doc_id, md5(coalesce(string_agg(word, ' ' ORDER BY i), '')) AS digest FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id""",
)
def ordered_distinct_words(t):
    found = F.regexp_extract_all("text", F.lit(r"[^ \n]+"), F.lit(0))
    return t.documents.select("doc_id", F.md5(F.array_join(ordered_distinct(found), " ")).alias("digest"))
