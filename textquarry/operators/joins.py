"""Checked joins and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import let
from textquarry.operators.decontamination import BLOOM_WORDS, bloom_filter, may_contain
from textquarry.operators.skew import lookup_by_frequency


def join_1to1(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Equi-join that fails when a key repeats on either side.

    The check travels with the rows: each side is grouped by the key and its count
    asserted, so no extra job runs. The rows are unique per key afterwards.
    """
    keys = [on] if isinstance(on, str) else on

    def unique(df: DataFrame, side: str) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_none"))
        one = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(row).alias("_row"))
        message = F.concat(F.lit(f"duplicate key in {side}: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
        checked = one.select(
            *keys, F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message)).alias("_row")
        )
        return checked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])

    return unique(left, "left").join(unique(right, "right"), keys, how)


def outer_fill(
    left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str] = ("_1", "_2"), fill=0
) -> DataFrame:
    """Full outer join; shared column names get suffixes, missing values become ``fill``."""
    a = left.select(on, *[F.col(c).alias(c + suffixes[0]) for c in left.columns if c != on])
    b = right.select(on, *[F.col(c).alias(c + suffixes[1]) for c in right.columns if c != on])
    return a.join(b, on, "outer").fillna(fill)


def lookup(df: DataFrame, dimension: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join with a metadata table; adaptive execution broadcasts it when it is small."""
    return df.join(dimension, on, "left")


def task_base(task: Column) -> Column:
    """A task id without its last ``|`` part."""
    return F.regexp_replace(task, r"\|[^|]*$", "")


def join_task_info(scores: DataFrame, info: DataFrame) -> DataFrame:
    """Scores with the facts of their task; the info is keyed by the task id without shots."""
    keyed = info.withColumnsRenamed({"task": "task_base"})
    return scores.withColumn("task_base", task_base(F.col("task"))).join(keyed, ["task_base", "metric"]).drop("task_base")


def prefix_join(
    df: DataFrame, prefixes: DataFrame, key: str, text: str, prefix: str = "prefix", bloom_words: int = BLOOM_WORDS
) -> DataFrame:
    """``key``, ``prefix`` and the prefix's other columns for every listed prefix a text starts with.

    A text is cut at every length that some prefix has, and these starts meet the prefixes as
    equals, so a list of millions needs neither a regular expression nor a comparison of all with
    all. Starts are held against a Bloom filter of fixed size in their own task; only those that
    pass are shuffled, and a prefix that many texts start with is copied as often as it is asked for.
    NULL and empty texts and prefixes meet nothing; of a repeated prefix the least row counts.
    """
    rest = [c for c in prefixes.columns if c != prefix]
    listed = prefixes.where(F.length(prefix) > 0)
    # One row; at most as many lengths as the longest prefix has characters.
    lengths = listed.agg(F.array_sort(F.collect_set(F.length(prefix))).alias("_lengths"))

    def starts(s: Column) -> Column:
        fitting = F.filter("_lengths", lambda n: n <= F.length(s))
        return F.transform(fitting, lambda n: F.substr(s, F.lit(1), n))

    cut = df.select(F.col(key), F.col(text).alias("_text")).crossJoin(F.broadcast(lengths))
    cut = cut.select(key, F.explode(let(F.col("_text"), starts)).alias("_start")).withColumn("_h", F.xxhash64("_start"))
    bloom = bloom_filter(listed.select(F.xxhash64(prefix).alias("_h")), "_h", bloom_words)
    passed = may_contain(cut, bloom, "_h", bloom_words).select(key, "_start")

    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_none"))
    one = listed.groupBy(F.col(prefix).alias("_start")).agg(F.min(row).alias("_row"))
    asked = passed.groupBy("_start").agg(F.count("*").alias("_asked"))
    met = lookup_by_frequency(passed, one.join(asked, "_start"), "_start", "_asked", [key]).where("_asked IS NOT NULL")
    return met.select(key, F.col("_start").alias(prefix), *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def first_prefix(df: DataFrame, prefixes: DataFrame, key: str, text: str, prefix: str = "prefix", order: str = "ord", **options) -> DataFrame:
    """``key, prefix``: of the listed prefixes a text starts with, the one first in order."""
    met = prefix_join(df, prefixes, key, text, prefix, **options)
    return met.groupBy(key).agg(F.min_by(prefix, order).alias(prefix))


def parameter_grid(df: DataFrame, name: str, values: list, exceptions: list[tuple] | None = None, key: str | None = None) -> DataFrame:
    """Every row with every listed parameter value, except the named (row key, value) pairs.

    The values are configuration, so this is an ``explode`` of a literal array.
    """
    grid = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    for row_value, value in exceptions or []:
        grid = grid.where(~((F.col(key) == row_value) & (F.col(name) == value)))
    return grid


def compare_sets(reference: DataFrame, new: DataFrame, item: str, by: list[str]) -> DataFrame:
    """Items per group that are missing from, or extra in, the new set."""
    a = reference.select(*by, item).distinct()
    b = new.select(*by, item).distinct()
    missing = a.join(b, [*by, item], "left_anti").withColumn("status", F.lit("missing"))
    extra = b.join(a, [*by, item], "left_anti").withColumn("status", F.lit("extra"))
    return missing.unionByName(extra)


def require_same_sets(reference: DataFrame, new: DataFrame, item: str, by: list[str]) -> None:
    """Raise with up to ten examples when the two sets differ."""
    found = compare_sets(reference, new, item, by).limit(10).collect()
    if found:
        raise ValueError("sets differ: " + "; ".join(str(r.asDict()) for r in found))


def concat(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def explode_questions(df: DataFrame) -> DataFrame:
    """Table-and-text documents to one row per question.

    The context is the table followed by the paragraphs in order, as parallel
    title and sentence arrays. Supporting titles follow the answer's origin.
    ``df`` has ``table_uid``, ``table`` (cells), ``paragraphs`` (order, text) and
    ``questions``.
    """
    from textquarry.functions.text import table_to_markdown

    ordered = F.array_sort("paragraphs")
    titles = F.concat(
        F.array(F.lit("Table")), F.transform(ordered, lambda p: F.concat(F.lit("Paragraph "), p["order"].cast("string")))
    )
    sentences = F.concat(F.array(F.array(table_to_markdown(F.col("table")))), F.transform(ordered, lambda p: F.array(p["text"])))
    context = F.struct(titles.alias("title"), sentences.alias("sentences"))
    rows = df.select("table_uid", "questions", context.alias("context")).select(
        "table_uid", "context", F.explode("questions").alias("q")
    )
    origin = F.col("q.answer_from")
    nothing = F.array().cast("array<string>")
    cited = F.transform(
        F.coalesce(F.col("q.rel_paragraphs"), nothing), lambda o: F.concat(F.lit("Paragraph "), o)
    )
    supporting = F.array_distinct(
        F.concat(
            F.when(origin.isin("table", "table-text"), F.array(F.lit("Table"))).otherwise(nothing),
            F.when(origin.isin("text", "table-text"), cited).otherwise(nothing),
        )
    )
    return rows.select(
        F.concat_ws("_", "table_uid", "q.uid").alias("id"),
        F.col("q.question").alias("question"),
        answer_text(F.col("q.answer_type"), F.col("q.answer")).alias("answer"),
        F.col("q.answer").alias("answer_raw"),
        F.col("q.answer_type").alias("answer_type"),
        origin.alias("answer_from"),
        F.col("q.scale").alias("scale"),
        "context",
        F.struct(
            supporting.alias("title"), F.transform(supporting, lambda _: F.lit(0)).alias("sent_id")
        ).alias("supporting_facts"),
    )


def answer_text(answer_type: Column, answer_json: Column) -> Column:
    """The JSON answer (text, number or list) as one string.

    Several spans are joined by commas; otherwise the first list item counts, and
    whole numbers lose their decimal point.
    """
    listed = F.startswith(F.ltrim(answer_json), F.lit("["))
    items = F.when(listed, F.from_json(answer_json, "array<string>")).otherwise(
        F.array(F.coalesce(F.from_json(F.concat(F.lit('{"a":'), answer_json, F.lit("}")), "a string")["a"], answer_json))
    )
    first = F.coalesce(F.get(items, F.lit(0)), F.lit(""))
    whole = F.regexp_replace(first, r"^(-?\d+)\.0+$", "$1")
    return (
        F.when(answer_type == "multi-span", F.array_join(items, ", "))
        .when(answer_type.isin("arithmetic", "count"), whole)
        .otherwise(first)
    )
