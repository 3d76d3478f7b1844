"""Quality rules: fixed rules first, then robust multivariate outliers.

Every text is reduced to a vector of transformed statistics. Per language and source, a
minimum-covariance-determinant estimate (the center and covariance of the ``SUPPORT``
of rows that lie closest together) is found by concentration steps from the medians,
and a row is rejected if its Mahalanobis distance is too large. All steps are built-in
functions: a concentration step sums the moments of rows by group and fine bins of the
distance, and one row per group carries the Cholesky factor to the next step.

Groups of fewer than ``MIN_ROWS`` rows are pooled by language, and languages whose pool
is still smaller are pooled together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.functions.hashing import let
from textquarry.llm.common import materialize, text_of

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SUPPORT = 0.75
STEPS = 3
MIN_ROWS = 200
# A clean row's chance to be rejected if the statistics were normal.
TAIL = 1e-9
BINS_PER_E = 32
BROADCAST_GROUPS = 100_000

# Statistic and least standard deviation: smaller differences are never unusual.
FEATURES = {
    "f_words": (lambda: F.log1p("n_words"), 0.5),
    "f_length": (lambda: F.log(F.col("word_chars") / F.col("n_words")), 0.06),
    "f_symbols": (lambda: F.sqrt(F.col("n_symbols") / F.col("n_words")), 0.04),
    "f_lines": (lambda: F.sqrt(F.col("n_dup_lines") / F.col("n_words")), 0.04),
    "f_repeats": (lambda: F.sqrt(F.col("n_repeat_words") / F.col("n_words")), 0.1),
}


def _repeat_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found at least twice in the list."""

    def covered(keys: Column) -> Column:
        placed = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def repeated(s: Column) -> Column:
            def twin(e: Column, i: Column) -> Column:
                same = [F.coalesce(F.get(s, i + d)["h"] == e["h"], F.lit(False)) for d in (-1, 1)]
                return same[0] | same[1]

            return F.sort_array(F.transform(F.filter(s, twin), lambda e: e["p"]))

        def total(starts: Column) -> Column:
            steps = F.transform(
                starts, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width)))
            )
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(placed, lambda s: let(repeated(s), total))

    last = F.size(words) - width
    keys = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(words, i + d) for d in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(
        keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(covered(k))
    )


def text_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the statistics of each text; a NULL text counts as empty."""
    text = text_of(text_col)
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counts = let(
        words, lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words"))
    )
    return docs.select(
        *keep,
        counts.alias("_counts"),
        F.length(F.translate(text, BLANKS, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
    )


def _chi2_quantile(p_tail: float, d: int) -> float:
    """Upper quantile of a chi-squared distribution (Wilson and Hilferty's cube)."""
    low, high = -10.0, 10.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 0.5 * math.erfc(mid / math.sqrt(2)) > p_tail else (low, mid)
    return d * (1 - 2 / (9 * d) + low * math.sqrt(2 / (9 * d))) ** 3


def _chi2_below(x: float, d: int) -> float:
    z = ((x / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _with_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a written table of one row per group; broadcast if it is known to be small."""
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    return rows.join(groups, keys, "left")


def _pooled(rows: DataFrame, min_rows: int) -> DataFrame:
    """Add ``g_lang, g_source``: the group whose estimate judges a row."""
    named = rows.withColumns(
        {k: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for k, c in (("_l", "lang"), ("_s", "source"))}
    )
    sizes = named.groupBy("_l", "_s").agg(F.count("*").alias("_n"))
    sizes = materialize(sizes, "group-sizes")
    pools = sizes.where(F.col("_n") < min_rows).groupBy("_l").agg(F.sum("_n").alias("_pool"))
    chosen = (
        sizes.join(pools, "_l", "left")
        .withColumn("_own", F.col("_n") >= min_rows)
        .withColumn("_by_lang", F.col("_pool") >= min_rows)
        .select(
            "_l",
            "_s",
            F.when(F.col("_own") | F.col("_by_lang"), F.col("_l")).otherwise(F.lit("*")).alias("g_lang"),
            F.when(F.col("_own"), F.col("_s")).otherwise(F.lit("*")).alias("g_source"),
        )
    )
    return _with_groups(named, materialize(chosen, "groups"), ["_l", "_s"]).drop("_l", "_s")


def _distance(names: list[str]) -> list[Column]:
    """The unknowns ``y_i`` of the Cholesky factor ``c_i_j`` times ``y`` equals the distance from the center ``m_i``."""
    solved: list[Column] = []
    for i, name in enumerate(names):
        rest = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"c_{i}_{j}") * F.col(f"y_{j}")
        solved.append(rest / F.col(f"c_{i}_{i}"))
    return solved


def _with_distance(rows: DataFrame, estimate: DataFrame, names: list[str]) -> DataFrame:
    joined = _with_groups(rows, estimate, ["g_lang", "g_source"])
    for i, y in enumerate(_distance(names)):  # forward substitution, one unknown at a time
        joined = joined.withColumn(f"y_{i}", y)
    squares = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(names))), F.col("y_0") * F.col("y_0"))
    return joined.withColumn("d2", squares).select(*rows.columns, "d2")


def _factored(moments: DataFrame, names: list[str], floors: list[float], factor: float) -> DataFrame:
    """Centers and Cholesky factors from the moment sums of one row per group."""
    d, out = len(names), moments
    for i in range(d):
        out = out.withColumn(f"m_{i}", F.col(f"s_{i}") / F.col("n"))
    for i in range(d):
        for j in range(i + 1):
            cov = (F.col(f"s_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}")) * factor
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + floors[i] ** 2
            for k in range(j):
                cov = cov - F.col(f"c_{i}_{k}") * F.col(f"c_{j}_{k}")
            if i == j:
                value = F.sqrt(F.greatest(cov, F.lit(floors[i] ** 2 / 4)))
            else:
                value = cov / F.col(f"c_{j}_{j}")
            out = out.withColumn(f"c_{i}_{j}", value)
    columns = [f"m_{i}" for i in range(d)] + [f"c_{i}_{j}" for i in range(d) for j in range(i + 1)]
    return out.select("g_lang", "g_source", *columns)


def _concentrate(rows: DataFrame, names: list[str], floors: list[float], support: float) -> DataFrame:
    """One concentration step: the moments of the ``support`` of rows with the least ``d2``."""
    d = len(names)
    sums = {"n": F.count("*")}
    for i in range(d):
        sums[f"s_{i}"] = F.sum(names[i])
        for j in range(i + 1):
            sums[f"s_{i}_{j}"] = F.sum(F.col(names[i]) * F.col(names[j]))
    binned = (
        rows.withColumn("_bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E))
        .groupBy("g_lang", "g_source", "_bin")
        .agg(*[v.alias(k) for k, v in sums.items()])
    )
    group = W.partitionBy("g_lang", "g_source")
    before = group.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    near = binned.withColumns(
        {"_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "_all": F.sum("n").over(group)}
    ).where(F.col("_before") < F.ceil(F.col("_all") * support))
    moments = near.groupBy("g_lang", "g_source").agg(*[F.sum(k).alias(k) for k in sums])
    within = _chi2_quantile(1 - support, d)
    factor = support / _chi2_below(within, d + 2)
    return materialize(_factored(moments, names, floors, factor), "estimates")


def _first_estimate(rows: DataFrame, names: list[str], floors: list[float]) -> DataFrame:
    """Medians and median deviations, without correlations."""
    keys = ["g_lang", "g_source"]
    medians = materialize(
        rows.groupBy(*keys).agg(*[F.percentile_approx(n, 0.5, 10_000).alias(f"m_{i}") for i, n in enumerate(names)]),
        "medians",
    )
    apart = _with_groups(rows, medians, keys)
    spread = apart.groupBy(*keys).agg(
        *[
            F.percentile_approx(F.abs(F.col(n) - F.col(f"m_{i}")), 0.5, 10_000).alias(f"mad_{i}")
            for i, n in enumerate(names)
        ]
    )
    estimate = medians.join(spread, keys).select(
        *keys,
        *[f"m_{i}" for i in range(len(names))],
        *[
            (F.greatest(F.col(f"mad_{i}") * 1.4826, F.lit(floors[i])) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}")
            for i in range(len(names))
            for j in range(i + 1)
        ],
    )
    return materialize(estimate, "first-estimate")


def robust_distances(
    rows: DataFrame, names: list[str], floors: list[float], support: float = SUPPORT, steps: int = STEPS
) -> DataFrame:
    """Add ``d2``: the squared robust distance of each row of a written table within its group."""
    estimate = _first_estimate(rows, names, floors)
    for _ in range(steps):
        estimate = _concentrate(_with_distance(rows, estimate, names), names, floors, support)
    return _with_distance(rows, estimate, names)


def judge_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    tail: float = TAIL,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Statistics, ``base_failed``, the squared distance ``d2`` and ``kept`` for every row.

    A NULL language or source is a group of its own. Rows that fail the fixed rules are
    rejected and don't take part in the estimates (their ``d2`` is NULL). Repeated rows
    get equal verdicts.
    """
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.col(text_col).alias("text"),
    )
    counted = materialize(text_statistics(source, ["doc_id", "lang", "source"]), "text-statistics")
    plain = [F.col(c).cast("bigint").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")]
    stats = counted.select(
        "doc_id",
        "lang",
        "source",
        F.col("_counts.n_words").cast("bigint").alias("n_words"),
        *plain,
        F.col("_counts.n_repeat_words").cast("bigint").alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    )
    names, floors = list(FEATURES), [f[1] for f in FEATURES.values()]
    passed = stats.where(~F.col("base_failed"))
    vectors = passed.withColumns({name: f[0]() for name, f in FEATURES.items()})
    grouped = materialize(_pooled(vectors, min_rows), "statistic-vectors")
    judged = robust_distances(grouped, names, floors)
    limit = _chi2_quantile(tail, len(names))
    columns = [c for c in stats.columns if c != "base_failed"]
    return judged.select(
        *columns, F.lit(False).alias("base_failed"), "d2", (F.col("d2") <= limit).alias("kept")
    ).unionByName(
        stats.where("base_failed").select(
            *columns,
            F.lit(True).alias("base_failed"),
            F.lit(None).cast("double").alias("d2"),
            F.lit(False).alias("kept"),
        )
    )
