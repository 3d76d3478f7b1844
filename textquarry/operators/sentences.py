"""Sentence boundaries that abbreviations and initials do not break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.functions.text import sentences
from textquarry.operators.skew import lookup_head_first
from textquarry.session import written

# How surely a period follows an abbreviation, and the score from which a word is one.
SURE = 0.99
LEAST_SCORE = 0.3
# Words seen with a period less often can't be judged.
LEAST_SEEN = 5


def _bare(token: Column) -> Column:
    """A token without the marks around it, its last period kept, in lower case."""
    return F.lower(F.regexp_replace(token, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}.]+$", ""))


def _kind(bare: Column) -> Column:
    return F.regexp_replace(bare, r"\.$", "")


def period_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``word, with_period, without_period, score`` of every word of letters and inner periods.

    The score is the log-likelihood ratio of Kiss and Strunk: how much better a period that
    nearly always follows explains the counts than the share of words with a period in all
    texts does, for short words more than for long ones, for inner periods, and against
    each time the word stands without one. Equal tokens are counted before they are
    taken apart, in each task first.
    """
    tokens = df.select(F.explode(F.split(text, r"\s+")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    bare = tokens.select(_bare(F.col("token")).alias("bare"), "n").where("bare != ''")
    seen = bare.select(_kind(F.col("bare")).alias("word"), F.endswith("bare", F.lit(".")).alias("dot"), "n")
    of = {"with_period": F.col("dot"), "without_period": ~F.col("dot")}
    counts = seen.groupBy("word").agg(*[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(name) for name, c in of.items()])
    counts = written(counts, "period-counts")
    # One row.
    totals = counts.agg(F.sum("with_period").alias("_dots"), F.sum(F.col("with_period") + F.col("without_period")).alias("_all"))
    k, rest = F.col("with_period"), F.col("without_period")
    usual = F.least(F.greatest(F.col("_dots") / F.col("_all"), F.lit(1e-9)), F.lit(SURE - 0.01))
    ratio = 2 * (k * (F.log(F.lit(SURE)) - F.log(usual)) + rest * (F.log(F.lit(1 - SURE)) - F.log(1 - usual)))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - letters
    score = ratio * F.exp(-letters) * (inner + 1) * F.exp(-rest * F.log(letters))
    judged = counts.where(F.col("word").rlike(r"^\p{L}[\p{L}.]*$")).crossJoin(F.broadcast(totals))
    return judged.select("word", "with_period", "without_period", score.alias("score"))


def abbreviations(counts: DataFrame, least_score: float = LEAST_SCORE, least_seen: int = LEAST_SEEN) -> DataFrame:
    """``word, n``: the words that a period belongs to, and how often they occur."""
    sure = counts.where((F.col("with_period") >= least_seen) & (F.col("score") >= least_score))
    return sure.select("word", (F.col("with_period") + F.col("without_period")).alias("n"))


def split_sentences(df: DataFrame, short: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, sentence_id, sentence``: texts split after ``.``, ``!`` or ``?`` and white space.

    A period after one of the abbreviations in ``short`` (see ``abbreviations``) or after a
    single letter ends no sentence, unless it ends the text; the parts are joined with one
    blank. The key must be unique. A NULL text has no sentences, an empty one an empty sentence.
    """
    parts = df.select(key, F.posexplode(sentences(F.col(text))).alias("_part", "_said"))
    # Read backwards, so that only the last word is looked at.
    last = F.reverse(F.regexp_extract(F.reverse("_said"), r"^\.(\S+)", 1))
    asked = parts.withColumn("_word", F.nullif(_kind(_bare(last)), F.lit("")))
    listed = written(short.select(F.col("word").alias("_word"), "n"), "abbreviations")
    marked = lookup_head_first(asked, listed, "_word", "n", [key, "_part"])
    goes_on = F.coalesce(F.col("n").isNotNull() | F.col("_word").rlike(r"^\p{L}$"), F.lit(False))
    # One text is one window.
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.withColumn("_goes_on", goes_on).withColumn(
        "sentence_id", F.coalesce(F.count_if(~F.col("_goes_on")).over(before), F.lit(0)).cast("int")
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_said"))), lambda p: p["_said"]), " ")
    return placed.groupBy(key, "sentence_id").agg(whole.alias("sentence"))
