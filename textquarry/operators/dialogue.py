"""Conversations and chunked documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import pick, uniform
from textquarry.functions.text import chunks_of_min_size, split_thinking, strip


def collapse_turns(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """Turn rows to one conversation row. A conversation is one record, so its size is a record's size."""
    turns = F.array_sort(F.collect_list(F.struct(turn, F.col(role).alias("role"), F.col(content).alias("content"))))
    grouped = df.groupBy(key).agg(turns.alias("_t"))
    return grouped.select(
        key, F.transform("_t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )


def chunk_rows(
    df: DataFrame, text: str = "text", min_size: int = 200, sep: str = "\n\n", into: str = "chunk"
) -> DataFrame:
    """One row per chunk of at least ``min_size`` characters, with its number and the count."""
    listed = df.withColumn("_chunks", chunks_of_min_size(F.col(text), min_size, sep))
    return listed.select(
        *df.columns, F.size("_chunks").alias("num_chunks"), F.posexplode("_chunks").alias("chunk_id", into)
    )


def merge_chunks(
    df: DataFrame, key: str = "id", text: str = "text", sep: str = "\n\n"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Complete documents from chunk rows: ``(merged, rejected, incomplete)``.

    A document is complete when all ``num_chunks`` chunks are there; it is rejected
    if one of them did not finish with ``stop``.
    """
    grouped = df.groupBy(key).agg(
        F.count("*").alias("_have"),
        F.max("num_chunks").alias("num_chunks"),
        F.bool_and(F.coalesce(F.col("finish_reason") == "stop", F.lit(False))).alias("_stopped"),
        F.array_sort(F.collect_list(F.struct("chunk_id", F.col(text).alias("t")))).alias("_parts"),
    )
    whole = grouped.where(F.col("_have") == F.col("num_chunks"))
    joined = F.array_join(F.transform("_parts", lambda p: p["t"]), sep)
    merged = whole.select(key, joined.alias(text), "num_chunks", "_stopped")
    incomplete = grouped.where(F.col("_have") != F.col("num_chunks")).select(
        key, "num_chunks", F.col("_have").alias("arrived")
    )
    return merged.where("_stopped").drop("_stopped"), merged.where("NOT _stopped").drop("_stopped"), incomplete


# Localized labels of problem, reasoning and solution.
PROBLEM_LABELS = {
    "en": ["Problem:", "Question:", "Query:", "Prompt:", "user:", ""],
    "fr": ["Problème :", "Question :", "Requête :", "Demande :", "user:", ""],
    "es": ["Problema:", "Pregunta:", "Consulta:", "Solicitud:", "user:", ""],
    "it": ["Problema:", "Domanda:", "Richiesta:", "Prompt:", "user:", ""],
    "de": ["Problem:", "Frage:", "Anfrage:", "Aufforderung:", "user:", ""],
}
THOUGHT_LABELS = ["Thoughts:", "Reasoning:", "Thinking:"]
SOLUTION_LABELS = {
    "en": ["Answer:", "Solution:", "Final Answer:"],
    "fr": ["Réponse :", "Solution :", "Réponse finale :"],
    "es": ["Respuesta:", "Solución:", "Respuesta final:"],
    "it": ["Risposta:", "Soluzione:", "Risposta finale:"],
    "de": ["Antwort:", "Lösung:", "Endgültige Antwort:"],
}


def render_dialogue(
    df: DataFrame, key: str, lang: str = "en", keep_thinking: bool = False, message_length: int = 3, seed: int = 42
) -> DataFrame:
    """Conversation to running text with labels drawn by the row key.

    The last two messages are the question and the answer. A wrong number of
    messages is an error.
    """
    messages = F.col("messages")
    checked = F.when(F.size(messages) == message_length, messages).otherwise(
        F.raise_error(
            F.concat(F.lit(f"expected {message_length} messages, got "), F.size(messages).cast("string"))
        ).cast("array<struct<role:string,content:string>>")
    )
    split = split_thinking(F.element_at(checked, -1)["content"])
    thoughts = split["thoughts"] if keep_thinking else F.lit("")
    problem = pick(PROBLEM_LABELS[lang], key, seed=f"{seed}-problem")
    plain = (problem == "") | (problem == "user:")
    solution = F.when(problem == "", "").when(problem == "user:", "assistant:").otherwise(
        pick(SOLUTION_LABELS[lang], key, seed=f"{seed}-solution")
    )
    thinking = F.when(problem == "", "").when(plain, "think:").otherwise(
        pick(THOUGHT_LABELS, key, seed=f"{seed}-thoughts")
    )
    head = F.concat_ws("\n", problem, F.element_at(checked, -2)["content"])
    middle = F.when(thoughts != "", F.concat_ws("\n", thinking, thoughts))
    text = F.concat_ws("\n", head, middle, solution, split["answer"])
    return df.withColumn("text", strip(text))


def join_messages(messages: Column) -> Column:
    return strip(F.array_join(F.transform(messages, lambda m: m["content"]), "\n"))


# Role names of the older conversation format.
LEGACY_ROLES = {"human": "user", "gpt": "assistant"}


def normalize_messages(conversations: Column, system: Column | None = None) -> Column:
    """``{from, value}`` turns to ``{role, content}``; a non-empty system text becomes the first turn."""
    def turn(m: Column) -> Column:
        role = F.lower(m["from"])
        for old, new in LEGACY_ROLES.items():
            role = F.when(F.lower(m["from"]) == old, F.lit(new)).otherwise(role)
        return F.struct(role.alias("role"), m["value"].alias("content"))

    turns = F.transform(conversations, turn)
    if system is None:
        return turns
    first = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(first, turns)).otherwise(turns)


# Chat mark-up and the empty reasoning block it can produce.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
DOUBLE_THINK = "<think>\n\n</think>\n\n<think>"


def render_chat(messages: Column) -> Column:
    """Chat mark-up; where reasoning was left open, the empty block and the end mark go."""
    text = F.array_join(
        F.transform(
            messages, lambda m: F.concat(F.lit(TURN_START), m["role"], F.lit("\n"), m["content"], F.lit(TURN_END))
        ),
        "",
    )
    fixed = F.replace(text, F.lit(DOUBLE_THINK), F.lit("<think>\n"))
    return F.when(
        F.contains(text, F.lit(DOUBLE_THINK)), F.substr(fixed, F.lit(1), F.length(fixed) - len(TURN_END))
    ).otherwise(text)


def pair_by_position(a: DataFrame, b: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Pair the i-th rows of two lists of one source when the lists have the same length.

    Both sides are joined on (source, position), so a long list is spread over the
    cluster; only the two lengths are compared per source. With different lengths
    the right value is NULL.
    """
    lengths = (
        a.groupBy(key).agg(F.count("*").alias("_n"))
        .join(b.groupBy(key).agg(F.count("*").alias("_m")), key)
        .where("_n = _m")
        .select(key)
    )
    usable = b.join(lengths, key, "left_semi").select(key, pos, F.col(value).alias("right_value"))
    return a.select(key, pos, F.col(value).alias("left_value")).join(usable, [key, pos], "left")


def swap_direction(df: DataFrame, key: str, left: str, right: str, p: float = 0.5, seed: int = 42) -> DataFrame:
    """Exchange the two columns of about ``p`` of the rows, and say which."""
    swap = uniform(key, seed=seed) < p
    return df.select(
        *[c for c in df.columns if c not in (left, right)],
        F.when(swap, F.col(right)).otherwise(F.col(left)).alias(left),
        F.when(swap, F.col(left)).otherwise(F.col(right)).alias(right),
        swap.alias("swapped"),
    )


def parallel_template(turns: Column, source: Column, target: Column) -> Column:
    """Aligned chunks ``array<struct<src,tgt>>`` to a bilingual listing."""
    return F.array_join(
        F.transform(
            turns,
            lambda p: F.concat(
                F.lit("- "), source, F.lit(": "), p["src"], F.lit("\n- "), target, F.lit(": "), p["tgt"], F.lit("\n\n")
            ),
        ),
        "",
    )


def parallel_conversation(turns: Column) -> Column:
    """Aligned chunks to alternating user and assistant messages."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.flatten(F.transform(turns, lambda p: F.array(message("user", p["src"]), message("assistant", p["tgt"]))))
