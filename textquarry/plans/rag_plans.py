"""Question-answering rows derived from conversations and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions import answers as A

from textquarry.functions.text import words
from textquarry.operators import rag as X
from textquarry.operators.dialogue import collapse_turns
from textquarry.operators.filters import filter_rag
from textquarry.plans import sqlbits as S
from textquarry.plans.registry import query


def qa_rows(t):
    """One row per conversation: user turns are passages, the last assistant turn holds the answer.

    Every second passage is a supporting one. The reasoning cites the first
    passage, a wrong one, or nothing, and answers right, nearly right or wrong.
    """
    convs = collapse_turns(t.conversations)
    users = F.filter("messages", lambda m: m["role"] == "user")
    last = F.try_element_at(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(-1))["content"]
    base = convs.select(
        F.concat(F.lit("c"), "conv_id").alias("id"), "conv_id",
        F.get(users, F.lit(0))["content"].alias("question"),
        F.array_join(words(last), " ").alias("answer"),
        F.transform(users, lambda m, i: F.concat(F.lit("Passage "), (i + 1).cast("string"))).alias("titles"),
        F.transform(users, lambda m: F.array(m["content"])).alias("sentences"),
    )
    variant = F.col("conv_id") % 4
    said = (
        F.when(variant == 0, F.concat(F.lit("The "), "answer", F.lit("!.")))
        .when(variant == 1, F.concat("answer", F.lit(" indeed")))
        .when(variant == 2, F.lit("something else"))
    )
    cite = (
        F.when(variant == 0, F.lit('##Cite "Passage 1"##'))
        .when(variant == 1, F.lit('##Cite  "passage 1" ## and ##Cite "Passage 99"##'))
        .when(variant == 2, F.lit("##Cite Passage 1 ##"))
        .otherwise("")
    )
    trace = F.concat(
        F.lit("We read ##begin_quote##it##end_quote## "), cite, F.lit(".\n"),
        F.coalesce(F.concat(F.lit("**Final Answer:** "), said), F.lit("Unsure")),
    )
    return base.select(
        "id", "conv_id", "question", "answer",
        F.struct(F.col("titles").alias("title"), F.col("sentences").alias("sentences")).alias("context"),
        F.struct(F.filter("titles", lambda _, i: i % 2 == 0).alias("title")).alias("supporting_facts"),
        F.filter("titles", lambda _, i: i % 2 == 0).alias("supporting_facts_titles"),
        trace.alias("reasoning_trace"),
        F.when(F.col("conv_id") % 3 == 0, "bridge").otherwise("comparison").alias("type"),
        (F.col("conv_id") % 10 == 9).alias("is_unanswerable"),
    )


_LAST = "list_aggregate(regexp_extract_all(last, '[^ \\t\\n\\r\\f\\x0B]+'), 'string_agg', ' ')"
_QA_SQL = f"""qa0 AS (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS users, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS last FROM conversations GROUP BY conv_id),
    qa AS (SELECT conv_id, users, {_LAST} AS answer FROM qa0)"""
# Longer findings than 299 characters are no answers; asterisks are not part of one.
_SAID = "CASE conv_id % 4 WHEN 0 THEN 'The ' || answer || '!' WHEN 1 THEN answer || ' indeed' WHEN 2 THEN 'something else' END"
_FOUND = f"(CASE WHEN length(replace({_SAID}, '*', '')) BETWEEN 1 AND 299 THEN replace({_SAID}, '*', '') END)"


@query(
    "extract_answer", "T23",
    f"""WITH {_QA_SQL} SELECT conv_id, {_FOUND} AS extracted FROM qa""",
)
def extract_answer(t):
    return qa_rows(t).select("conv_id", A.extract_answer(F.col("reasoning_trace")).alias("extracted"))


@query(
    "extract_citations", "T24",
    f"""WITH {_QA_SQL} SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'Passage 1' WHEN 1 THEN 'passage 1|Passage 99' WHEN 2 THEN 'Passage 1' ELSE '' END AS cited FROM qa""",
)
def extract_citations(t):
    return qa_rows(t).select("conv_id", F.array_join(A.extract_citations(F.col("reasoning_trace")), "|").alias("cited"))


@query(
    "parse_numbers", "T25",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, -l_quantity AS n1, l_extendedprice AS n2, l_linenumber::DOUBLE AS n3, (l_linenumber <> 3) AS matches FROM lineitem""",
)
def parse_numbers(t):
    text = F.concat(
        F.lit("lost ("), F.format_number("l_quantity", 1), F.lit(") of $"), F.format_number("l_extendedprice", 2),
        F.lit(", or "), "l_linenumber", F.lit("%"),
    )
    found = A.numbers(text)
    rows = t.lineitem.withColumn("found", found)
    scale = F.when(F.col("l_linenumber") == 3, "million").otherwise("thousand")
    # The expected value is off by less than one percent and in thousands.
    expected = F.array(F.col("l_extendedprice") * 1.005 / 1000)
    observed = F.slice("found", 2, 1)
    return rows.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.get("found", F.lit(0)).alias("n1"),
        F.get("found", F.lit(1)).alias("n2"), F.get("found", F.lit(2)).alias("n3"), A.numeric_match(expected, observed, scale).alias("matches"),
    )


@query(
    "reformat_context", "T26",
    f"""WITH {_QA_SQL}, u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE role = 'user')
        SELECT u.conv_id, md5(string_agg('[Passage ' || i || ']' || chr(10) || trim(text), chr(10) || '----------' || chr(10) || chr(10) ORDER BY i)) AS digest
        FROM u JOIN qa USING (conv_id) GROUP BY u.conv_id""",
)
def reformat_context(t):
    listed = F.transform(X.passages(F.col("context")), lambda p: F.concat(F.lit("["), p["title"], F.lit("]\n"), p["text"]))
    raw = F.array_join(listed, "\n\n")
    return qa_rows(t).select("conv_id", F.md5(X.reformat_context(raw)).alias("digest"))


@query(
    "restyle_citations", "T27",
    f"""WITH {_QA_SQL}, a AS (SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'The ' || answer || '!.' WHEN 1 THEN answer || ' indeed' WHEN 2 THEN 'something else' END AS said, conv_id % 4 AS v FROM qa),
        b AS (SELECT *, coalesce('**Final Answer:** ' || said, 'Unsure') AS tail FROM a)
        SELECT conv_id, 'We read <quote>it</quote> ' || CASE v WHEN 0 THEN '<cite>"Passage 1"</cite>' WHEN 1 THEN '<cite>"passage 1"</cite> and <cite>"Passage 99"</cite>' WHEN 2 THEN '##Cite Passage 1 ##' ELSE '' END || '.' || chr(10) || tail AS inline_style,
               'We read [QUOTE]it[/QUOTE]' || CASE v WHEN 1 THEN ' and' WHEN 2 THEN ' ##Cite Passage 1 ##' WHEN 3 THEN ' ' ELSE '' END || '.' || chr(10) || tail ||
               CASE v WHEN 0 THEN chr(10) || chr(10) || '**References**' || chr(10) || '- [Source: "Passage 1"]' WHEN 1 THEN chr(10) || chr(10) || '**References**' || chr(10) || '- [Source: "passage 1"]' || chr(10) || '- [Source: "Passage 99"]' ELSE '' END AS end_style FROM b""",
)
def restyle_citations(t):
    trace = X.normalize_citations(F.col("reasoning_trace"))
    return qa_rows(t).select(
        "conv_id", X.restyle_citations(trace, X.CITATION_STYLES[1], False).alias("inline_style"),
        X.restyle_citations(trace, X.CITATION_STYLES[2], True).alias("end_style"),
    )


@query("sft_rows", "T28")
def sft_rows(t):
    return X.to_sft(X.assemble_context(qa_rows(t))).select("id", "prompt", "completion", "citation_style", "end_of_completion_citations")


@query(
    "sft_chat_rows", "T28",
    f"""WITH {_QA_SQL} SELECT 'c' || conv_id AS id, 3 AS turns, 'system|user|assistant' AS roles, ['default', 'xml', 'bracket', 'double_angle'][floor({S.uniform("'c' || conv_id", seed='42-style')} * 4)::INT + 1] AS citation_style,
        {S.uniform("'c' || conv_id", seed='42-end')} < 0.3 AS end_of_completion_citations FROM qa""",
)
def sft_chat_rows(t):
    rows = X.to_sft(X.assemble_context(qa_rows(t)), chat=True)
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), "|")
    return rows.select("id", F.size("messages").alias("turns"), roles.alias("roles"), "citation_style", "end_of_completion_citations")


def _norm(expr: str) -> str:
    """Normalization by repeated article removal (three rounds reach neighbours)."""
    out = f"lower({expr})"
    for _ in range(3):
        out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}_])(a|an|the)($|[^\p{{L}}\p{{N}}_])', '\1 \3', 'g')"
    return S.squeeze(rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}_ \t\n\r\f\x0B]', '', 'g')")


_SCORED_SQL = f"""{_QA_SQL}, a AS (SELECT *, {_FOUND} AS x FROM qa),
    n AS (SELECT conv_id, x, {_norm('answer')} AS e, {_norm('x')} AS o FROM a),
    l AS (SELECT *, list_distinct(list_filter(string_split(e, ' '), lambda z: z <> '')) AS ew, list_distinct(list_filter(string_split(o, ' '), lambda z: z <> '')) AS ow FROM n),
    k AS (SELECT conv_id, CASE WHEN conv_id % 10 = 9 THEN 'unanswerable' WHEN x IS NULL THEN 'none' WHEN e = o THEN 'exact'
            WHEN e <> '' AND o <> '' AND (contains(o, e) OR contains(e, o)) THEN 'fuzzy'
            WHEN len(ew) > 0 AND len(ow) > 0 AND len(list_intersect(ew, ow))::DOUBLE / len(ew) >= 0.8 THEN 'fuzzy' ELSE 'none' END AS match FROM l)"""


@query("score_answers", "A23", f"WITH {_SCORED_SQL} SELECT 'c' || conv_id AS id, match AS eval_answer_match_type, match <> 'none' AS eval_answer_correct FROM k")
def score_answers(t):
    return X.score_answers(qa_rows(t)).select("id", "eval_answer_match_type", "eval_answer_correct")


@query(
    "answer_accuracy", "A23",
    f"""WITH {_SCORED_SQL} SELECT CASE WHEN conv_id % 3 = 0 THEN 'bridge' ELSE 'comparison' END AS type, count(*)::BIGINT AS total, count(*) FILTER (WHERE match <> 'none')::BIGINT AS correct,
        round(count(*) FILTER (WHERE match <> 'none')::DOUBLE / count(*), 6) AS accuracy FROM k GROUP BY 1""",
)
def answer_accuracy(t):
    return X.accuracy(X.score_answers(qa_rows(t)), ["type"]).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "score_table_answers", "A24",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE l_returnflag WHEN 'A' THEN 'multi_span_all' WHEN 'N' THEN CASE WHEN l_linenumber < 4 THEN 'numeric_tol_1pct' ELSE 'none' END
              ELSE CASE WHEN l_linestatus = 'O' THEN 'exact' ELSE 'none' END END AS match FROM lineitem""",
)
def score_table_answers(t):
    flag, near = F.col("l_returnflag"), F.when(F.col("l_linenumber") < 4, 1.005).otherwise(1.05)
    qty = F.col("l_quantity").cast("int").cast("string")
    rows = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.when(flag == "A", "multi-span").when(flag == "N", "arithmetic").otherwise("span").alias("answer_type"),
        F.when(flag == "A", F.concat(F.lit("q"), qty, F.lit(", r"))).when(flag == "N", F.col("l_quantity").cast("string")).otherwise("Open").alias("answer"),
        F.when(flag == "A", F.concat(F.lit('["q'), qty, F.lit('", "r"]'))).when(flag == "N", F.col("l_quantity").cast("string")).alias("answer_raw"),
        F.when(flag == "N", "thousand").otherwise("").alias("scale"), F.lit(False).alias("is_unanswerable"),
        F.when(flag == "A", F.concat(F.lit("The r and Q"), qty)).when(flag == "N", F.concat(F.lit("about $"), F.format_number(F.col("l_quantity") * 1000 * near, 2)))
        .otherwise(F.when(F.col("l_linestatus") == "O", "the open!").otherwise("closed")).alias("eval_extracted_answer"),
    )
    return X.score_table_answers(rows).select("l_orderkey", "l_linenumber", F.col("eval_answer_match_type").alias("match"))


_CITED_SQL = f"""{_QA_SQL}, c AS (SELECT conv_id, (users + 1) // 2 AS want, CASE conv_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS cited,
    CASE WHEN conv_id % 4 < 3 AND users > 0 THEN 1 ELSE 0 END AS hit FROM qa),
    s AS (SELECT *, CASE WHEN cited > 0 THEN hit::DOUBLE / cited END AS p, CASE WHEN want > 0 THEN hit::DOUBLE / want END AS r FROM c),
    f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END AS f1 FROM s)"""


@query(
    "score_citations", "A25",
    f"WITH {_CITED_SQL} SELECT 'c' || conv_id AS id, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, (cited - hit)::INT AS extra, (want - hit)::INT AS missed FROM f",
)
def score_citations(t):
    s = X.score_citations(qa_rows(t))
    return s.select(
        "id", F.round("eval_chunk_precision", 6).alias("precision"), F.round("eval_chunk_recall", 6).alias("recall"),
        F.round("eval_chunk_f1", 6).alias("f1"), F.col("extra_citations").alias("extra"), F.col("missed_citations").alias("missed"),
    )


@query(
    "citation_report", "A25",
    f"""WITH {_CITED_SQL}, g AS (SELECT count(*)::BIGINT AS evaluated, count(*) FILTER (WHERE cited > 0)::BIGINT AS with_citations, avg(p) AS mp, avg(r) AS mr, avg(f1) AS mf,
               count(*) FILTER (WHERE p = 1 AND r = 1)::BIGINT AS perfect, sum(cited - hit)::BIGINT AS extra, sum(want - hit)::BIGINT AS missed FROM f WHERE want > 0)
        SELECT evaluated, with_citations, round(mp, 6) AS mean_precision, round(mr, 6) AS mean_recall, round(mf, 6) AS mean_f1, perfect, extra, missed, round(2 * mp * mr / (mp + mr), 6) AS f1_of_means FROM g""",
)
def citation_report(t):
    report = X.citation_report(X.score_citations(qa_rows(t)))
    return report.withColumns({c: F.round(c, 6) for c in ("mean_precision", "mean_recall", "mean_f1", "f1_of_means")})


@query(
    "judge_scores", "A26",
    """WITH s AS (SELECT 1 + 3 * quality + toxic AS score FROM labels), t AS (SELECT count(*) AS total FROM s)
       SELECT r.score::INT AS score, count(s.score)::BIGINT AS n, round(count(s.score)::DOUBLE / any_value(total), 6) AS share FROM range(1, 6) r(score) LEFT JOIN s ON s.score = r.score, t GROUP BY r.score""",
)
def judge_scores(t):
    from textquarry.operators.aggregates import score_distribution

    scored = t.labels.select((1 + 3 * F.col("quality") + F.col("toxic")).alias("score"))
    return score_distribution(scored, "score").withColumn("share", F.round("share", 6))


@query(
    "add_unanswerable", "SP8",
    f"""WITH {_QA_SQL}, n AS (SELECT count(*) AS n, count(*) FILTER (WHERE conv_id % 10 = 9) AS u FROM qa),
        r AS (SELECT conv_id, users, row_number() OVER (ORDER BY {S.uniform("'c' || conv_id")}, 'c' || conv_id) AS rn FROM qa WHERE conv_id % 10 <> 9)
        SELECT 'c' || conv_id AS id, conv_id % 10 = 9 AS is_unanswerable, users::INT AS passages FROM qa
        UNION ALL SELECT 'c' || conv_id || '_unanswerable', TRUE, (users // 2)::INT FROM r, n WHERE rn <= floor(n * 0.3) - u AND users // 2 >= 1""",
)
def add_unanswerable(t):
    out = X.add_unanswerable(qa_rows(t), 0.3)
    return out.select("id", "is_unanswerable", F.size("context.title").alias("passages"))


_ASSEMBLE_SQL = f"""WITH {_QA_SQL}, c AS (SELECT conv_id, users, (users + 1) // 2 AS rel, users // 2 AS bg, {S.uniform("'c' || conv_id", seed='42-ratio')} * 0.7 AS ratio FROM qa)
    SELECT 'c' || conv_id AS id, rel::INT AS chunks_relevant, bg::INT AS chunks_background_initial, least(floor(bg * ratio), greatest(users - 2, 0))::INT AS chunks_background_removed,
           (users - least(floor(bg * ratio), greatest(users - 2, 0)))::INT AS chunks_total FROM c"""


@query("assemble_context", "SP9", _ASSEMBLE_SQL)
def assemble_context(t):
    out = X.assemble_context(qa_rows(t))
    return out.select("id", "chunks_relevant", "chunks_background_initial", "chunks_background_removed", "chunks_total")


_TEXT_SQL = f"""WITH s AS ({_ASSEMBLE_SQL}),
    m AS (SELECT 'c' || conv_id AS id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE role = 'user'),
    p AS (SELECT *, i % 2 = 1 AS removable, {S.uniform('id', 'i', seed='42-drop')} AS u, {S.uniform('id', 'i', seed='42-order')} AS v FROM m),
    k AS (SELECT *, row_number() OVER (PARTITION BY id, removable ORDER BY u, i) AS rn FROM p),
    t AS (SELECT id, string_agg('[Passage ' || (i + 1) || ']' || chr(10) || trim(text), chr(10) || chr(10) ORDER BY v, i) AS context_text
          FROM k JOIN s USING (id) WHERE NOT removable OR rn <= chunks_background_initial - chunks_background_removed GROUP BY id)
    SELECT id, coalesce(context_text, '') AS context_text FROM s LEFT JOIN t USING (id)"""


@query("assembled_text", "SP9", _TEXT_SQL)
def assembled_text(t):
    return X.assemble_context(qa_rows(t)).select("id", "context_text")


@query(
    "filter_scored_rows", "F17",
    f"WITH {_SCORED_SQL} SELECT 'c' || conv_id AS id FROM k WHERE match = 'unanswerable' OR match <> 'none'",
)
def filter_scored_rows(t):
    return filter_rag(X.score_answers(qa_rows(t))).select("id")
