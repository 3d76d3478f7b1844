"""Deterministic samples and splits. Every draw is a hash of the key and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import pick_weighted, uniform
from textquarry.operators.ordering import ROWS_PER_RANGE, numbered


def sample_rate(df: DataFrame, rate: float, key: str = "id", seed: int = 42) -> DataFrame:
    """Keep each row with probability ``rate``; a larger rate keeps a superset."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must be between 0 and 1")
    return df if rate == 1 else df.where(uniform(key, seed=seed) < rate)


def sample_by(df: DataFrame, repeat: Column, rate: float, key: str = "id", seed: int = 42) -> DataFrame:
    """Keep each row with probability ``repeat * rate``; a NULL repeat keeps nothing.

    The largest repeat is 3, so the rate must stay below a third to keep its proportions.
    """
    if not 0 <= rate < 1 / 3:
        raise ValueError("rate must be at least 0 and below 1/3")
    return df.where(uniform(key, seed=seed) < F.coalesce(repeat, F.lit(0.0)) * rate)


# How often a source is repeated; a missing source is never drawn.
SOURCE_REPEATS = {
    1.0: ["GallicaPress", "Pile-FreeLaw", "RedPajama"],
    1.5: ["AmericanStories", "FineWebEdu"],
    2.0: [
        "AmendementsParlement", "Claire", "DiscoursPublics", "Europarl", "GallicaMonographies", "HAL",
        "InterventionsParlement", "OpenData", "LEGI", "OpenEdition", "QuestionsEcritesParlement", "Stac",
        "TheStack", "Theses", "YouTube",
    ],
    2.5: [
        "Pile-NIH_ExPorter", "Pile-PhilPapers", "Pile-StackExchange", "Pile-Ubuntu_IRC",
        "Pile-USPTO_Backgrounds", "PeS2o",
    ],
    3.0: ["Pile-DM_Mathematics", "Wikipedia", "Wikisource", "Wiktionary", "CroissantAligned", "EuroparlAligned"],
}
# Sources whose repeat depends on the language: (source, language, repeat there, repeat elsewhere).
LANGUAGE_REPEATS = [("Eurovoc", "en", 1.0, 2.0), ("Gutenberg", "fr", 2.0, 3.0)]


def source_repeat(source: Column, language: Column) -> Column:
    out = None
    for name, lang, here, elsewhere in LANGUAGE_REPEATS:
        value = F.when(language == lang, here).otherwise(elsewhere)
        out = F.when(source == name, value) if out is None else out.when(source == name, value)
    for repeat, sources in SOURCE_REPEATS.items():
        out = out.when(source.isin(*sources), F.lit(repeat))
    return out.otherwise(0.0)


def sample_n(
    df: DataFrame, n: int, key: str, seed: int = 42, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exactly ``n`` rows: the smallest hashes, or for ``seed <= 0`` the slice that starts at row ``-seed``.

    For the hash draw a histogram of the hashes tells the bin in which the n-th
    smallest lies. Only that bin is ranked, everything below it passes, so ``n``
    may be as large as the table.
    """
    if seed <= 0:
        ranked = numbered(df.select(key), [key], "_n", rows_per_range=rows_per_range)
        chosen = ranked.where((F.col("_n") > -seed) & (F.col("_n") <= n - seed)).select(key)
        return df.join(chosen, key, "left_semi")
    return smallest_hashes(df, n, key, seed)[0]


HASH_BINS = 65_536
# The hash has 32 bits, so a bin of a bin is a single value of it.
LEVELS = 2
RANKED_ROWS = 100_000


def smallest_hashes(df: DataFrame, n: int, key: str, seed: int | str = 42) -> tuple[DataFrame, DataFrame]:
    """The ``n`` rows with the smallest hash of the key, and the other rows."""
    u = uniform(key, seed=seed)
    low, width, below = 0.0, 1.0, 0
    for _ in range(LEVELS):
        inside = df.select(u.alias("u")).where((F.col("u") >= low) & (F.col("u") < low + width))
        step = width / HASH_BINS
        bins = inside.groupBy(F.floor((F.col("u") - low) / step).cast("int").alias("b")).count().orderBy("b")
        edge, held = None, 0
        # At most HASH_BINS counters.
        for row in bins.toLocalIterator():
            if below + row["count"] >= n:
                edge, held = row["b"], row["count"]
                break
            below += row["count"]
        if edge is None:
            return df, df.limit(0)
        low, width = low + edge * step, step
        if held <= RANKED_ROWS:
            break
    # Few rows are left in the edge bin; its first ones by (hash, key) complete the sample.
    border = df.select(u.alias("u"), F.col(key).alias("k")).where((F.col("u") >= low) & (F.col("u") < low + width))
    last = border.orderBy("u", "k").limit(n - below).agg(F.max(F.struct("u", "k")).alias("last"))
    position = F.struct(u.alias("u"), F.col(key).alias("k"))
    marked = df.join(F.broadcast(last), F.lit(True), "left").withColumn(
        "_in", F.coalesce((u < low) | (position <= F.col("last")), F.lit(False))
    )
    return marked.where("_in").drop("_in", "last"), marked.where("NOT _in").drop("_in", "last")


def rate_for_target(df: DataFrame, size: Column, target: float) -> float:
    """The rate that samples ``target`` out of the available volume; it must not exceed 1."""
    available = df.agg(F.sum(size)).first()[0]
    rate = target / available if available else float("inf")
    if rate > 1:
        raise ValueError(f"target {target} is more than the available {available}")
    return rate


def split_ratio(df: DataFrame, ratios: list[float], key: str = "id", seed: int = 42, into: str = "split") -> DataFrame:
    """Send each row to one of several splits; what the ratios leave is dropped."""
    u, running, label = uniform(key, seed=seed), 0.0, None
    for i, ratio in enumerate(ratios):
        running += ratio
        label = F.when(u < running, F.lit(i)) if label is None else label.when(u < running, F.lit(i))
    return df.withColumn(into, label).where(F.col(into).isNotNull())


def train_test(df: DataFrame, n_test: int, key: str = "id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A test set of fixed size, and everything else."""
    test, train = smallest_hashes(df, n_test, key, seed)
    return train, test


def choose_prompt(
    df: DataFrame, prompts: list[str], weights: list[float] | None = None, key: str = "id", seed: int = 42,
    into: str = "prompt",
) -> DataFrame:
    """One prompt per row, by weight."""
    return df.withColumn(into, pick_weighted(prompts, weights or [1.0] * len(prompts), key, seed=seed))
