"""Row filters, reject splits and per-key selections."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.labels import step_number
from textquarry.functions.text import n_words
from textquarry.operators.joins import prefix_join
from textquarry.operators.reference_lists import KNOWN_URL_PREFIXES, expand_prefixes
from textquarry.operators.skew import lookup_by_frequency
from textquarry.session import written


def tag_rejects(df: DataFrame, keep: Column, reason: Column | str, into: str = "drop_reason") -> DataFrame:
    """One pass: rows that fail get a reason, rows that pass get NULL. A NULL test fails."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumn(into, F.when(~F.coalesce(keep, F.lit(False)), why))


def split_keep_reject(df: DataFrame, keep: Column, reason: Column | str) -> tuple[DataFrame, DataFrame]:
    """Passing rows, and the rest with ``drop_reason``. Together they are the input."""
    tagged = tag_rejects(df, keep, reason)
    return tagged.where("drop_reason IS NULL").drop("drop_reason"), tagged.where("drop_reason IS NOT NULL")


def known_url_prefix(url: Column, prefixes: list[str], strip_scheme: bool = True) -> Column:
    """The first listed prefix the URL starts with, or NULL.

    The list is configuration of a few hundred entries, so it is one anchored
    alternation: no join, no shuffle, and alternatives are tried in list order.
    """
    target = F.regexp_replace(url, "^[a-z]+://", "") if strip_scheme else url
    pattern = "^(?:" + "|".join(re.sub(r"([.?+*()\[\]{}|^$\\])", r"\\\1", p) for p in prefixes) + ")"
    return F.nullif(F.regexp_extract(target, pattern, 0), F.lit(""))


def tag_known_urls(
    df: DataFrame, url: str = "url", prefixes: list[str] | None = None, strip_scheme: bool = True
) -> DataFrame:
    """Add ``drop_reason`` to pages that belong to a known source; a NULL url is kept."""
    hit = known_url_prefix(F.col(url), prefixes or expand_prefixes(KNOWN_URL_PREFIXES), strip_scheme)
    return df.withColumn("drop_reason", F.when(hit.isNotNull(), F.concat(F.lit("duplicate_url:"), hit)))


def filter_known_urls(
    df: DataFrame, url: str = "url", prefixes: list[str] | None = None, strip_scheme: bool = True
) -> DataFrame:
    return tag_known_urls(df, url, prefixes, strip_scheme).where("drop_reason IS NULL").drop("drop_reason")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/:?#]+)", 1)


def url_path(url: Column) -> Column:
    path = F.regexp_extract(url, "^[a-z]+://[^/?#]*(/[^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row with the greatest ``order`` per key.

    An aggregate, not a window: each task reduces its own rows first, so a hot
    key costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def url_target(url: Column) -> Column:
    """Path and query string of a URL, which crawl rules are matched against."""
    target = F.regexp_extract(url, "^[a-z]+://[^/?#]*([/?][^#]*)", 1)
    return F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.lit("/"), target))


def rule_pattern(path: Column) -> Column:
    """A crawl rule as a regular expression: ``*`` is any text, a last ``$`` is the end of the target."""
    quoted = F.regexp_replace(path, r"([.?+()\[\]{}|^\\])", r"\\$1")
    starred = F.replace(quoted, F.lit("*"), F.lit(".*"))
    ended = F.endswith(starred, F.lit("$"))
    inner = F.when(ended, F.substr(starred, F.lit(1), F.length(starred) - 1)).otherwise(starred)
    plain = F.replace(inner, F.lit("$"), F.lit("\\$"))
    return F.concat(F.lit("^"), plain, F.when(ended, F.lit("$")).otherwise(F.lit("")))


def tag_robots(
    df: DataFrame, rules: DataFrame, url: str = "url", agent: str = "*", must_allow: bool = False
) -> DataFrame:
    """Crawler opt-out: add ``drop_reason`` from the site's most recent rules.

    ``rules(host, path, allow, malformed[, agent])`` holds one row per rule. The rules
    for ``agent`` count if the host has any, otherwise those for ``*``. A malformed file
    allows everything, otherwise the longest rule that fits the page's path and query
    decides (allowing wins a tie), where ``*`` and a last ``$`` have their usual
    meaning. A page that no rule fits is allowed, or dropped with ``must_allow``; a
    host without rules is dropped. Targets meet rules as equals or by prefix, so neither the
    pages nor the rules of a host gather, however many they are.
    """
    target = url_target(F.col(url))
    asking = df.withColumn("_host", url_host(F.col(url))).withColumn("_ask", F.concat("_host", F.lit("\n"), target))
    asks = asking.where("_ask IS NOT NULL").groupBy("_ask").agg(F.first("_host").alias("_host"), F.count("*").alias("_n"))
    asks = written(asks.withColumn("_target", F.expr("substr(_ask, length(_host) + 2)")), "crawl-targets")

    named = rules.withColumn("agent", F.lower("agent") if "agent" in rules.columns else F.lit("*"))
    is_own = F.col("agent") == agent.lower()
    named = written(
        named.select(
            F.col("host").alias("_host"), "path", "allow", "malformed", is_own.alias("_own"), (F.col("agent") == "*").alias("_common")
        ),
        "crawl-rules",
    )
    sites = named.groupBy("_host").agg(
        F.bool_or("malformed").alias("_malformed"), F.bool_or("_own").alias("_has_own"), F.count("*").alias("_rules")
    )
    chosen = lookup_by_frequency(named.drop("malformed"), sites, "_host", "_rules", ["path"])
    chosen = chosen.where(F.when(F.col("_has_own"), F.col("_own")).otherwise(F.col("_common")))
    wild, ended = F.contains("path", F.lit("*")), F.endswith("path", F.lit("$"))
    rule = F.struct(F.length("path").alias("n"), "allow")
    ruled = chosen.select(
        "_host", "path", rule.alias("_rule"), wild.alias("_wild"), (ended & ~wild).alias("_exact"),
        F.concat("_host", F.lit("\n"), F.substring_index("path", "*", 1)).alias("_start"),
    )
    # A rule for one target is an equal of it; any other is found by what stands before its first ``*``.
    exact = ruled.where("_exact").groupBy(F.expr("substr(_start, 1, length(_start) - 1)").alias("_ask")).agg(F.max("_rule").alias("_rule"))
    pattern = F.when(F.col("_wild"), rule_pattern(F.col("path")))
    begun = ruled.where("NOT _exact").groupBy("_start").agg(F.collect_set(F.struct("_rule", pattern.alias("pattern"))).alias("_rules"))
    met = prefix_join(asks.select("_ask", "_target", F.struct("_ask", "_target").alias("_page")), begun, "_page", "_ask", "_start")
    fitting = met.select(F.col("_page._ask").alias("_ask"), F.col("_page._target").alias("_target"), F.explode("_rules").alias("_r"))
    fitting = fitting.where(F.col("_r.pattern").isNull() | F.rlike("_target", F.col("_r.pattern")))
    fits = exact.unionByName(fitting.select("_ask", F.col("_r._rule").alias("_rule")))
    decided = fits.groupBy("_ask").agg(F.max("_rule")["allow"].alias("_allow"))

    pages = asks.groupBy("_host").agg(F.count("*").alias("_pages"))
    known = sites.select("_host", "_malformed", F.lit(True).alias("_site")).join(pages, "_host")
    placed = lookup_by_frequency(asks, known, "_host", "_pages", ["_ask"]).join(decided, "_ask", "left")
    reason = (
        F.when(F.col("_site").isNull(), F.lit("robots:unknown_host"))
        .when(F.col("_malformed"), F.lit(None).cast("string"))
        .when(~F.coalesce("_allow", F.lit(not must_allow)), F.lit("robots:disallowed"))
    )
    answers = placed.select("_ask", "_n", reason.alias("_reason"), F.lit(True).alias("_answered"))
    joined = lookup_by_frequency(asking, answers, "_ask", "_n", [url])
    # A page without an address has no host.
    told = F.when(F.col("_answered"), F.col("_reason")).otherwise(F.lit("robots:unknown_host"))
    return joined.withColumn("drop_reason", told).drop("_host", "_ask", "_n", "_reason", "_answered")


def filter_quality(df: DataFrame, score: str, above: float = 0.5) -> DataFrame:
    """Rows with a score above ``above``; a missing score counts as 0."""
    return df.where(F.coalesce(F.col(score), F.lit(0.0)) > above)


def filter_robots(df: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    return tag_robots(df, rules, url).where("drop_reason IS NULL").drop("drop_reason")


def filter_in(df: DataFrame, column: str, allowed: list) -> DataFrame:
    return df.where(F.col(column).isin(*allowed))


def filter_not_in(df: DataFrame, column: str, banned: list) -> DataFrame:
    return df.where(~F.col(column).isin(*banned))


def filter_min_words(df: DataFrame, more_than: int = 50, text: str = "text") -> DataFrame:
    return df.where(n_words(F.col(text)) > more_than)


def filter_min_or_missing(df: DataFrame, column: str, minimum) -> DataFrame:
    """Keep rows at or above the minimum, and rows that lack the value."""
    return df.where(F.col(column).isNull() | (F.col(column) >= minimum))


def filter_path_contains(df: DataFrame, column: str, parts: list[str]) -> DataFrame:
    test = F.lit(False)
    for part in parts:
        test = test | F.contains(F.col(column), F.lit(part))
    return df.where(test)


def borrow_first_seen(df: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """Fill rows where all ``columns`` are missing from the key's first record.

    Rows without a key share one record. ``order`` must tell rows apart.
    """
    named = df.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("none")))
    first = named.groupBy("_key").agg(
        F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"), F.count("*").alias("_n")
    )
    all_missing = F.lit(True)
    for c in columns:
        all_missing = all_missing & F.col(c).isNull()
    joined = lookup_by_frequency(named, first, "_key", "_n", order)
    return joined.select(
        *[
            F.when(all_missing, F.col(f"_first.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def filter_public_domain(
    df: DataFrame,
    year: int = 2025,
    author: str = "author",
    order: tuple[str, ...] = ("book_id",),
) -> DataFrame:
    """Books whose author died long enough ago.

    Dead for 70 years (80 for French books); with an unknown death the author
    must be born 80 years earlier still; without any date the book passes.
    Books marked ``copyright`` never pass.
    """
    filled = borrow_first_seen(df, author, ["birth", "death"], list(order))
    limit = F.lit(year) - F.when(F.col("language") == "fr", 80).otherwise(70)
    birth, death = F.nullif(F.col("birth"), F.lit(0)), F.nullif(F.col("death"), F.lit(0))
    old = (
        F.when(death.isNotNull(), death <= limit)
        .when(birth.isNotNull(), birth <= limit - 80)
        .otherwise(F.lit(True))
    )
    return filled.where(old & ~F.coalesce(F.col("rights") == "copyright", F.lit(False)))


def select_checkpoints(
    df: DataFrame, name: str = "checkpoint", min_step: int = 0, multiple_of: int = 1, last_only: bool = False
) -> DataFrame:
    """Checkpoints at or after ``min_step`` whose step count is a multiple; ``-last`` copies are skipped."""
    step = step_number(F.col(name))["step"]
    chosen = df.withColumn("step", step).where(~F.col(name).endswith("-last"))
    if min_step:
        chosen = chosen.where(F.col("step") + 1 >= min_step)
    if multiple_of != 1:
        chosen = chosen.where((F.col("step") + 1) % multiple_of == 0)
    if last_only:
        chosen = chosen.agg(F.max_by(F.struct(*chosen.columns), "step").alias("r")).select("r.*")
    return chosen


def keep_complete(df: DataFrame, required: DataFrame, key: str) -> DataFrame:
    """Rows of the groups that have every required row (relational division)."""
    on = required.columns
    wanted = required.distinct()
    have = df.select(key, *on).distinct().join(wanted, on, "left_semi")
    complete = have.groupBy(key).agg(F.count("*").alias("_have"))
    need = wanted.agg(F.count("*").alias("_need"))
    # ``need`` is one row.
    full = complete.join(F.broadcast(need), F.col("_have") == F.col("_need")).select(key)
    return df.join(full, key, "left_semi")


def filter_rag(df: DataFrame) -> DataFrame:
    """Unanswerable rows, and rows that pass every score that was computed.

    A score counts only if its column exists; a NULL score then fails.
    """
    good = F.coalesce(F.col("eval_answer_correct"), F.lit(False))
    for column, wanted in (("eval_chunk_f1", 1.0), ("eval_factual_judge_score", 5)):
        if column in df.columns:
            good = good & F.coalesce(F.col(column) == wanted, F.lit(False))
    return df.where(F.coalesce(F.col("is_unanswerable"), F.lit(False)) | good)
