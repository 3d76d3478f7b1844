"""Conversations: rendering, chunk merging and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.hashing import uniform
from textquarry.operators import dialogue as X
from textquarry.plans import sqlbits as S
from textquarry.plans.registry import query
from textquarry.plans.text_plans import tagged_turns


def _stopped(key: str):
    return F.when(uniform(key, "chunk_id", seed="finish") < 0.95, "stop").otherwise("length")


_CHUNKS_SQL = f"""SELECT conv_id, turn AS chunk_id, count(*) OVER (PARTITION BY conv_id) AS num_chunks, text,
    CASE WHEN {S.uniform('conv_id', 'turn', seed='finish')} < 0.95 THEN 'stop' ELSE 'length' END AS finish_reason,
    {S.uniform('conv_id', 'turn', seed='lost')} AS lost FROM conversations"""


def translated_chunks(t):
    """Turns as translated chunks of one document; a few are lost, a few did not finish."""
    counts = t.conversations.groupBy("conv_id").agg(F.count("*").alias("num_chunks"))
    chunks = t.conversations.join(counts, "conv_id").withColumnRenamed("turn", "chunk_id")
    return chunks.withColumn("finish_reason", _stopped("conv_id")).where(uniform("conv_id", "chunk_id", seed="lost") > 0.05)


_MERGED_SQL = f"""WITH c AS ({_CHUNKS_SQL}), k AS (SELECT * FROM c WHERE lost > 0.05),
    g AS (SELECT conv_id, count(*) AS have, max(num_chunks) AS num_chunks, bool_and(finish_reason = 'stop') AS ok, string_agg(text, chr(10) || chr(10) ORDER BY chunk_id) AS text FROM k GROUP BY conv_id)
    SELECT conv_id, CASE WHEN have < num_chunks THEN 'incomplete' WHEN ok THEN 'merged' ELSE 'rejected' END AS outcome,
           CASE WHEN have = num_chunks THEN md5(text) END AS digest FROM g"""


@query("merge_chunks", "T10", _MERGED_SQL)
def merge_chunks(t):
    merged, rejected, incomplete = X.merge_chunks(translated_chunks(t), "conv_id")

    def side(df, name, digest):
        return df.select("conv_id", F.lit(name).alias("outcome"), digest.alias("digest"))

    none = F.lit(None).cast("string")
    return side(merged, "merged", F.md5("text")).unionByName(side(rejected, "rejected", F.md5("text"))).unionByName(
        side(incomplete, "incomplete", none)
    )


def _three_turns(turns):
    """Every three neighbouring messages of a conversation; a dialogue has exactly three."""
    convs = X.collapse_turns(turns)
    starts = F.sequence(F.lit(0), F.size("messages") - 3)
    cut = convs.where(F.size("messages") >= 3).withColumn("start", F.explode(starts))
    return cut.withColumn("messages", F.slice("messages", F.col("start") + 1, 3)).withColumn(
        "part_id", F.concat_ws("-", "conv_id", "start")
    )


_THREE_SQL = """WITH u AS (SELECT conv_id, row_number() OVER w AS rn, lead(text, 1) OVER w AS q, lead(text, 2) OVER w AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id || '-' || (rn - 1) AS part_id, q, a FROM u WHERE a IS NOT NULL"""


@query("render_dialogue", "T11")
def render_dialogue(t):
    return X.render_dialogue(_three_turns(tagged_turns(t)), "part_id", "fr", keep_thinking=True).select("part_id", "text")


def _label(options, seed):
    return S.pick(options, "part_id", seed=seed)


@query(
    "render_dialogue_plain", "T11",
    rf"""WITH c AS ({_THREE_SQL}), l AS (SELECT part_id, q, a, {_label(X.PROBLEM_LABELS['en'], '42-problem')} AS p, {_label(X.SOLUTION_LABELS['en'], '42-solution')} AS s FROM c)
         SELECT part_id, md5(regexp_replace(p || chr(10) || q || chr(10) || CASE p WHEN '' THEN '' WHEN 'user:' THEN 'assistant:' ELSE s END || chr(10) || a,
                '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')) AS digest FROM l""",
)
def render_dialogue_plain(t):
    return X.render_dialogue(_three_turns(t.conversations), "part_id").select("part_id", F.md5("text").alias("digest"))


@query(
    "join_messages", "T13",
    r"SELECT conv_id, md5(regexp_replace(string_agg(text, chr(10) ORDER BY turn), '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')) AS digest FROM conversations GROUP BY conv_id",
)
def join_messages(t):
    return X.collapse_turns(t.conversations).select("conv_id", F.md5(X.join_messages(F.col("messages"))).alias("digest"))


@query(
    "normalize_messages", "T14",
    """WITH m AS (SELECT conv_id, turn, role || '=' || md5(text) AS x FROM conversations UNION ALL SELECT conv_id, -1, 'system=' || md5('sys ' || conv_id) FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id % 2 = 0)
       SELECT conv_id, string_agg(x, ',' ORDER BY turn) AS turns FROM m GROUP BY conv_id""",
)
def normalize_messages(t):
    legacy_role = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.initcap("role"))
    convs = X.collapse_turns(t.conversations.withColumn("role", legacy_role))
    legacy = F.transform("messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value")))
    system = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("sys "), "conv_id")).otherwise("")
    messages = X.normalize_messages(legacy, system)
    shown = F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), F.md5(m["content"])))
    return convs.select("conv_id", F.array_join(shown, ",").alias("turns"))


@query(
    "render_chat", "T15",
    """WITH m AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || CASE WHEN turn = 1 AND conv_id % 2 = 0 THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || '<think>' ELSE '' END || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS x FROM conversations GROUP BY conv_id)
       SELECT conv_id, md5(CASE WHEN contains(x, '</think>') THEN substr(replace(x, '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || '<think>', '<think>' || chr(10)), 1,
              length(replace(x, '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || '<think>', '<think>' || chr(10))) - 11) ELSE x END) AS digest FROM m""",
)
def render_chat(t):
    doubled = (F.col("turn") == 1) & (F.col("conv_id") % 2 == 0)
    text = F.when(doubled, F.concat(F.lit(X.DOUBLE_THINK), "text")).otherwise(F.col("text"))
    convs = X.collapse_turns(t.conversations.withColumn("text", text))
    return convs.select("conv_id", F.md5(X.render_chat(F.col("messages"))).alias("digest"))


@query(
    "swap_direction", "SP11",
    f"""WITH p AS (SELECT conv_id * 1000 + turn AS pair_id, md5(text) AS src, role AS tgt, {S.uniform('conv_id * 1000 + turn', seed=8)} < 0.5 AS swapped FROM conversations)
        SELECT pair_id, CASE WHEN swapped THEN tgt ELSE src END AS src, CASE WHEN swapped THEN src ELSE tgt END AS tgt, swapped FROM p""",
)
def swap_direction(t):
    pairs = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), F.md5("text").alias("src"), F.col("role").alias("tgt"))
    return X.swap_direction(pairs, "pair_id", "src", "tgt", seed=8)


@query(
    "parallel_template", "SP11",
    """SELECT conv_id, md5(string_agg('- fr: ' || role || chr(10) || '- en: ' || text || chr(10) || chr(10), '' ORDER BY turn)) AS listing, (2 * count(*))::INT AS messages FROM conversations GROUP BY conv_id""",
)
def parallel_template(t):
    convs = X.collapse_turns(t.conversations)
    pairs = F.transform("messages", lambda m: F.struct(m["role"].alias("src"), m["content"].alias("tgt")))
    return convs.select("conv_id", pairs.alias("pairs")).select(
        "conv_id", F.md5(X.parallel_template(F.col("pairs"), F.lit("fr"), F.lit("en"))).alias("listing"),
        F.size(X.parallel_conversation(F.col("pairs"))).alias("messages"),
    )
