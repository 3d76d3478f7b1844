"""Corpus counts, distributions and grouped reports.

All of them are built-in aggregates with a map-side partial step, so a hot group
costs one partial row per task.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.text import n_words


def _count_char(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("bigint")


def corpus_counts(df: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    c = F.col(text)
    return df.groupBy(*by).agg(
        F.count("*").alias("pages"), F.sum(n_words(c)).alias("words"), F.sum(F.length(c).cast("bigint")).alias("chars")
    )


def field_counts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Counts per text field of one table."""
    long = df.select(key, *fields).unpivot(key, fields, "field", "value").where("value IS NOT NULL")
    return corpus_counts(long, ["field"], "value")


def tokenizer_stats(df: DataFrame, tokens: Column, by: list[str] | None = None, text: str = "text") -> DataFrame:
    """Size of the corpus in pages, lines, words, characters, bytes and tokens, and their ratios."""
    c = F.col(text)

    def only(pattern: str) -> Column:
        return F.size(F.filter("_tokens", lambda t: t.rlike(pattern))).cast("bigint")

    per_doc = {
        "paragraphs": F.size(F.split(c, "\n\n")).cast("bigint"),
        "lines": F.size(F.split(c, "\n")).cast("bigint"),
        "words": n_words(c),
        "chars": F.length(c).cast("bigint"),
        "bytes": F.octet_length(c).cast("bigint"),
        "spaces": _count_char(c, " "),
        "linebreaks": _count_char(c, "\n"),
        "tabs": _count_char(c, "\t"),
        "digits": F.regexp_count(c, F.lit("[0-9]")).cast("bigint"),
        "tokens": F.size("_tokens").cast("bigint"),
        "tokens_space": only("^ +$"),
        "tokens_linebreak": only("^\n+$"),
        "tokens_tab": only("^\t+$"),
        "tokens_digit": only("^[0-9]+$"),
        "tokens_single_byte": F.size(F.filter("_tokens", lambda t: F.octet_length(t) == 1)).cast("bigint"),
    }
    sums = (
        df.withColumn("_tokens", tokens)
        .groupBy(*(by or []))
        .agg(F.count("*").alias("pages"), *[F.sum(e).alias(name) for name, e in per_doc.items()])
    )
    return sums.withColumns(
        {
            "fertility": F.round(F.col("tokens") / F.col("words"), 3),
            "chars_per_token": F.round(F.col("chars") / F.col("tokens"), 3),
        }
    )


def length_stats(df: DataFrame, by: list[str], length: Column) -> DataFrame:
    """Sum, number, extremes, mean and exact quartiles (linear interpolation) of token lengths.

    Equal lengths are counted first. What is shuffled is then at most one row per
    group and length, and the quartiles weigh lengths by their counts.
    """
    counts = df.groupBy(*by, length.cast("bigint").alias("_len")).agg(F.count("*").alias("_n"))
    quartiles = F.percentile("_len", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("_n"))
    out = counts.groupBy(*by).agg(
        F.sum(F.col("_len") * F.col("_n")).alias("total_tokens"),
        F.sum("_n").alias("total_sequences"),
        F.min("_len").alias("min_tokens"),
        F.max("_len").alias("max_tokens"),
        quartiles.alias("_q"),
    )
    return out.select(
        *by, "total_tokens", "total_sequences", "min_tokens", "max_tokens",
        (F.col("total_tokens") / F.col("total_sequences")).alias("mean_tokens"),
        F.col("_q")[0].alias("Q1_tokens"), F.col("_q")[1].alias("Q2_tokens"), F.col("_q")[2].alias("Q3_tokens"),
    )


def length_histogram(df: DataFrame, length: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or []), length.cast("bigint").alias("length")).agg(F.count("*").alias("n"))


def log_histogram(df: DataFrame, length: Column, bins_per_decade: int = 10, by: list[str] | None = None) -> DataFrame:
    slot = F.floor(F.log10(F.greatest(length, F.lit(1))) * bins_per_decade).cast("bigint")
    return df.groupBy(*(by or []), slot.alias("log_bin")).agg(F.count("*").alias("n"))


# Code point ranges of the script families, and the characters of program code.
SCRIPT_RANGES = [
    ("LATIN", [(0x41, 0x7A), (0xC0, 0xFF), (0x100, 0x17F), (0x180, 0x24F)]),
    ("GREEK", [(0x370, 0x3FF)]),
    ("ARABIC", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)]),
]
CODE_CHARS = "0123456789(){}[];,.:+-*/%=<>&|^!~#@?_\\'\"` \t\n"


@F.pandas_udf(T.StringType())
def _category(chars: pd.Series) -> pd.Series:
    return chars.map(unicodedata.category)


@F.pandas_udf(T.BooleanType())
def _is_nfc(chars: pd.Series) -> pd.Series:
    return chars.map(lambda c: unicodedata.normalize("NFC", c) == c)


def script_family(char: Column) -> Column:
    code = F.ascii(char)
    out = None
    for family, ranges in SCRIPT_RANGES:
        test = F.lit(False)
        for low, high in ranges:
            test = test | code.between(low, high)
        out = F.when(test, family) if out is None else out.when(test, family)
    return out.when(F.contains(F.lit(CODE_CHARS), char), "CODE").otherwise("OTHER")


def char_alphabet(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each character occurs, with code point, Unicode category and script family.

    Each task counts the code points of its batches in an array, so it sends one row per
    distinct character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0x110000, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                texts = batch.column(0).slice(start, 128).drop_null().to_pylist()
                codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                found = np.bincount(codes)
                counts[: len(found)] += found
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in met], pa.string()), pa.array(counts[met])], names=["char", "n"])

    chars = df.select(text).mapInArrow(run, "char string, n bigint")
    counts = chars.groupBy("char").agg(F.sum("n").alias("count"))
    return counts.select(
        "char", "count", F.ascii("char").alias("ord"), _category("char").alias("category"), script_family(F.col("char")).alias("family")
    )


def select_alphabet(alphabet: DataFrame, limit: int = 1000) -> DataFrame:
    """The most frequent characters a vocabulary starts from.

    Characters that composition changes are out, and so are letters and symbols of
    non-alphabetic scripts (except Arabic), format characters and combining marks.
    """
    cat = F.col("category")
    major, minor = F.substring(cat, 1, 1), F.substring(cat, 2, 1)
    oriental = (
        minor.isin("c", "o") & ~major.isin("N", "P") & ~cat.isin("Sc", "So") & (F.col("family") != "ARABIC")
    )
    kept = alphabet.where(~oriental & ~cat.isin("Cf", "Mn") & _is_nfc("char"))
    return kept.orderBy(F.desc("count"), "ord").limit(limit)


def word_stats(df: DataFrame, by: list[str], text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """Words per document, mean word length, type-token ratio and stop-word share, averaged per group."""
    w = F.regexp_extract_all(text, F.lit(r"[^ \t\n\r\f\x0B]+"), F.lit(0))
    n = F.size("_w")
    stops = F.array(*[F.lit(s) for s in stop_words or ["the", "of", "and", "de", "la", "der", "die", "que"]])
    per_doc = df.withColumn("_w", w).where(n > 0).select(
        *by,
        n.cast("bigint").alias("_n"),
        (F.length(F.array_join("_w", "")) / n).alias("_len"),
        (F.size(F.array_distinct("_w")) / n).alias("_ttr"),
        (F.size(F.filter("_w", lambda x: F.array_contains(stops, F.lower(x)))) / n).alias("_stop"),
    )
    return per_doc.groupBy(*by).agg(
        F.count("*").alias("docs"), F.sum("_n").alias("n_words"), F.avg("_len").alias("avg_word_length"),
        F.avg("_ttr").alias("type_token_ratio"), F.avg("_stop").alias("stop_word_ratio"),
    )


def grouped_stats(df: DataFrame, metrics: list[str], groups: list[str]) -> DataFrame:
    """Total, number and mean of each metric: over all rows, and per value of each group column.

    One pass with grouping sets; metrics become rows afterwards.
    """
    sets = [[], *[[g] for g in groups]]
    aggregates = [a for m in metrics for a in (F.sum(m).alias(f"{m}__total"), F.count(m).alias(f"{m}__n"))]
    one = df.groupingSets([[F.col(c) for c in s] for s in sets], *groups).agg(F.grouping_id().alias("_g"), *aggregates)
    n = len(groups)
    which = F.element_at(
        F.array(*[F.lit(g) for g in groups], F.lit("summary")),
        F.coalesce(
            *[F.when(F.col("_g") == (2**n - 1) ^ (1 << (n - 1 - i)), F.lit(i + 1)) for i in range(n)], F.lit(n + 1)
        ),
    )
    value = F.when(which == "summary", F.lit("summary"))
    for g in groups:
        value = value.when(which == g, F.col(g).cast("string"))
    points = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"{m}__total").cast("double").alias("total"), F.col(f"{m}__n").alias("n")) for m in metrics]
    )
    return one.select(which.alias("group"), value.alias("value"), F.explode(points).alias("p")).select(
        "group", "value", "p.*", (F.col("p.total") / F.col("p.n")).alias("mean")
    )


def metric_histogram(df: DataFrame, metric: str, digits: int = 3) -> DataFrame:
    return df.groupBy(F.round(metric, digits).alias("value")).agg(F.count("*").alias("n"))


def partial_stats(df: DataFrame, by: list[str], metric: str) -> DataFrame:
    """Mergeable statistics of one shard or run."""
    x = F.col(metric)
    return df.groupBy(*by).agg(
        F.count(x).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.min(x).alias("least"), F.max(x).alias("most")
    )


def merge_stats(partials: DataFrame, by: list[str]) -> DataFrame:
    """Statistics of the whole from the statistics of its parts."""
    merged = partials.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    )
    mean = F.col("total") / F.col("n")
    variance = F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))
    return merged.select(*by, "n", "total", "least", "most", mean.alias("mean"), F.sqrt(variance).alias("std"))


def crosstab(df: DataFrame, rows: str, columns: str, values: list | None = None) -> DataFrame:
    """Contingency table; give ``values`` to avoid a pass that finds them."""
    grouped = df.groupBy(rows).pivot(columns, values) if values else df.groupBy(rows).pivot(columns)
    counts = grouped.count()
    return counts.na.fill(0, [c for c in counts.columns if c != rows])


def classification_report(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per label; an empty denominator gives 0."""
    cells = df.groupBy(F.col(true).alias("_t"), F.col(pred).alias("_p")).agg(F.count("*").alias("_n"))
    # The confusion matrix has one row per label pair: each cell counts for its true and its predicted label.
    sides = F.array(
        F.struct(F.col("_t").alias("label"), F.col("_n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0).alias("hits")),
        F.struct(F.col("_p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("_n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hits")),
    )
    sums = cells.select(F.explode(sides).alias("s")).groupBy("s.label").agg(
        F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hits").alias("hits")
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    scored = sums.withColumns(
        {"precision": ratio(F.col("hits"), F.col("predicted")), "recall": ratio(F.col("hits"), F.col("support"))}
    )
    both = F.col("precision") + F.col("recall")
    return scored.select("label", "precision", "recall", ratio(2 * F.col("precision") * F.col("recall"), both).alias("f1"), "support")


def confusion_matrix(df: DataFrame, true: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def profile(df: DataFrame, columns: list[str], bins: int = 6, low: float = 0, high: float = 6) -> DataFrame:
    """Value counts of text and boolean columns, histograms of numeric ones, in one pass."""
    def shown(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        if kind in ("string", "boolean"):
            return F.col(name).cast("string")
        width = (high - low) / bins
        slot = F.least(F.floor((F.col(name) - low) / width), F.lit(bins - 1))
        return F.when(F.col(name).between(low, high), slot.cast("string"))

    cells = F.array(*[F.struct(F.lit(c).alias("column"), shown(c).alias("value")) for c in columns])
    long = df.select(F.explode(cells).alias("e")).where("e.value IS NOT NULL")
    return long.groupBy("e.column", "e.value").agg(F.count("*").alias("n"))


def totals_by(df: DataFrame, label: str, amount: str, unit: float = 1e9) -> DataFrame:
    sums = df.groupBy(label).agg(F.sum(amount).alias("total"))
    return sums.where("total > 0").withColumn("total", F.col("total") / unit)


def folder_sizes(df: DataFrame, path: str, size: str) -> DataFrame:
    """Size of every folder, each file counted in all its ancestors.

    Files are first added up per own folder. Only that smaller table is multiplied
    by its depth.
    """
    folder = F.regexp_replace(path, "/?[^/]*$", "")
    own = df.groupBy(folder.alias("_f")).agg(F.sum(size).alias("_s")).where("_f <> ''")
    parts = F.split("_f", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return own.select(F.explode(ancestors).alias("folder"), "_s").groupBy("folder").agg(F.sum("_s").alias("size"))


def score_distribution(df: DataFrame, score: str, low: int = 1, high: int = 5) -> DataFrame:
    """Counts and shares of judge scores; scores nobody gave appear with 0."""
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("int").alias("score")).agg(F.count("*").alias("n"))
    # One row: the counts on the fixed scale as a map, spread over the scale again.
    on_scale = F.when(F.col("score").between(low, high), F.struct("score", "n"))
    packed = counts.agg(
        F.map_from_entries(F.collect_list(on_scale)).alias("m"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    spread = packed.select("total", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("score"), "m")
    n = F.coalesce(F.try_element_at("m", F.col("score")), F.lit(0)).cast("bigint")
    return spread.select("score", n.alias("n"), F.when(F.col("total") > 0, n / F.col("total")).otherwise(0.0).alias("share"))


def most_frequent(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def pretoken_counts(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("pretoken")).groupBy("pretoken").agg(F.count("*").alias("n"))


def pair_counts(pretokens: DataFrame, token: str = "pretoken", n: str = "n") -> DataFrame:
    """Adjacent character pairs inside pre-tokens, weighted by how often each pre-token occurs."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    left = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0)))
    right = F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0)))
    pairs = F.zip_with(left, right, lambda a, b: F.struct(a.alias("left"), b.alias("right")))
    return pretokens.select(F.explode(pairs).alias("p"), n).groupBy("p.left", "p.right").agg(F.sum(n).alias("n"))


def check_tokens(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Number of documents, tokens and characters of a tokenized table."""
    chars = F.length(F.replace(F.array_join(tokens, ""), F.lit("\n"), F.lit("\\n")))
    return df.agg(
        F.count("*").alias("docs"), F.sum(F.size(tokens).cast("bigint")).alias("tokens"), F.sum(chars.cast("bigint")).alias("chars")
    )
