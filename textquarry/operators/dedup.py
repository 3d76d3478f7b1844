"""Exact duplicate handling by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import content_hash
from textquarry.operators.filters import first_per_key
from textquarry.operators.skew import lookup_by_frequency


def dedup_normalized(
    df: DataFrame, order: list[str], text: str = "text", group: list[str] | None = None
) -> DataFrame:
    """One row per distinct text up to white space: the first in ``order`` wins.

    The survivors are chosen by a partial aggregate on the narrow
    (hash, order) pair; a text with a billion copies costs one row per task. The
    wide rows are then met by key, and each key occurs once.
    """
    group = group or []
    keyed = df.withColumn("_hash", content_hash(F.col(text)))
    if len(order) == 1:
        # A plain minimum stays in the hash aggregate; a struct would be sorted.
        winners = keyed.groupBy("_hash", *group).agg(F.min(order[0]).alias(order[0])).select(order[0])
    else:
        first = keyed.groupBy("_hash", *group).agg(F.min(F.struct(*order)).alias("_win"))
        winners = first.select(*[F.col(f"_win.{c}").alias(c) for c in order])
    return df.join(winners, order, "left_semi")


def first_of_copies(df: DataFrame, order: list[str], hash_column: str = "content_hash") -> DataFrame:
    """First row per content hash, for tables that are narrow by now: one pass, no join."""
    return first_per_key(df, [hash_column], order)


def dedup_report(df: DataFrame, text: str = "text", source: str = "source", group: list[str] | None = None) -> DataFrame:
    """Rows, distinct texts and number of sources per group."""
    group = group or []
    # First level collapses copies inside each task, so the distinct count below sees few rows.
    per_text = df.groupBy(*group, content_hash(F.col(text)).alias("_hash"), source).agg(F.count("*").alias("_n"))
    per_hash = per_text.groupBy(*group, "_hash").agg(F.sum("_n").alias("_n"))
    texts = per_hash.groupBy(*group).agg(F.sum("_n").alias("rows"), F.count("*").alias("unique_texts"))
    sources = per_text.groupBy(*group, source).count().groupBy(*group).agg(F.count("*").alias("sources"))
    return texts.join(sources, group) if group else texts.join(F.broadcast(sources), F.lit(True))


def with_cluster_size(
    df: DataFrame, name: str = "cluster_size", text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Add the number of exact copies of each text.

    Counts are partial aggregates over hashes. Only texts with copies are looked
    up; a missing match is a cluster of one. The most frequent texts come from a
    small broadcast list, so their copies do not gather; ``key`` tells rows apart.
    """
    keyed = df.withColumn("_hash", F.coalesce(content_hash(F.col(text)), F.lit("")))
    sizes = keyed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    joined = lookup_by_frequency(keyed, sizes, "_hash", "_n", [key], total=df.count())
    return joined.select(*df.columns, F.coalesce("_n", F.lit(1)).cast("bigint").alias(name))


def rehydration_weight(bucket: Column, weights: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(table, bucket), F.lit(1))


def rehydrate(df: DataFrame, weight: Column) -> DataFrame:
    """Repeat each row ``weight`` times, numbered by ``copy``."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), weight.cast("int")))).where("copy > 0")


def duplicate_names(df: DataFrame, key: str = "name") -> DataFrame:
    """Names that occur more than once; must be empty before publication."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
