"""Packing of token sequences into fixed-size training samples."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import let, uniform
from textquarry.operators.ordering import numbered
from textquarry.session import written


def pack_length_histogram(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Sequences per packed length; input and label are one token shorter than the sequence."""
    return df.groupBy((F.size(ids) - 1).alias("length")).agg(F.count("*").alias("n"))


def first_fit(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """First fit of lengths in the given order, all sequences of a length at once.

    Returns the bins in order, equal neighbours together: how many, and the uses of each
    length in one of them.
    """
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []  # how many, room, content
    for length, left in counts:
        out = []
        for many, room, content in bins:
            fit = room // length
            full = min(many, left // fit) if fit else 0
            rest = min(left - full * fit, fit - 1) if fit and full < many else 0
            if full:
                out.append((full, room - fit * length, [*content, (length, fit)]))
            if rest:
                out.append((1, room - rest * length, [*content, (length, rest)]))
            if many - full - bool(rest):
                out.append((many - full - bool(rest), room, content))
            left -= full * fit + rest
        fit = capacity // length
        if left // fit:
            out.append((left // fit, capacity - fit * length, [(length, fit)]))
        if left % fit:
            out.append((1, capacity - left % fit * length, [(length, left % fit)]))
        bins = out
    return [(many, content) for many, _, content in bins]


def assign_bins(
    df: DataFrame, key: str, ids: str = "input_ids", capacity: int = 2048, seed: int = 0,
    algorithm: str = "first_fit_shuffle",
) -> DataFrame:
    """``key, bin``: first fit over all sequences, with lengths in random or decreasing order.

    The packing follows from how many sequences of each length there are, at most
    ``capacity`` numbers, so it is one packing of the whole table whatever its size.
    Sequences then take the places of their length in the order of a hash.
    """
    length = F.size(ids) - 1
    too_long = F.when(length > capacity, F.raise_error(F.lit("a sequence is longer than the pack size")))
    lengths = df.select(
        key, F.coalesce(too_long.cast("int"), length).alias("length"), uniform(key, seed=f"{seed}-order").alias("_u")
    )
    lengths = written(lengths, "pack-lengths")
    counts = sorted(((r[0], r[1]) for r in lengths.groupBy("length").count().collect() if r[0] > 0), reverse=True)
    if algorithm == "first_fit_shuffle":
        random.Random(seed).shuffle(counts)
    # One row per length and group of equal bins; bounded by the capacity, not by the table.
    places, taken, first = [], {}, 0
    for many, content in first_fit(counts, capacity):
        for n, uses in content:
            start = taken.get(n, 0)
            places.append((n, start, start + many * uses, first, uses))
            taken[n] = start + many * uses
        first += many
    table = df.sparkSession.createDataFrame(places, "_length int, _from bigint, _to bigint, _first bigint, _uses bigint")
    rank = numbered(lengths.where("length > 0"), ["_u", key], "_rank", ["length"]).withColumn("_rank", F.col("_rank") - 1)
    inside = (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_from"), F.col("_to") - 1)
    place = F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_uses"))
    placed = rank.join(F.broadcast(table), inside).select(key, place.alias("bin"))
    # A single token has no successor and takes no room: any bin will do.
    return placed.unionByName(lengths.where("length <= 0").select(key, F.lit(0).cast("bigint").alias("bin")))


def pack(
    df: DataFrame, key: str, ids: str = "input_ids", mask: str = "loss_mask", capacity: int = 2048, seed: int = 0,
    algorithm: str = "first_fit_shuffle",
) -> DataFrame:
    """Packed samples: concatenated tokens and masks with the sequence boundaries.

    A pack holds at most ``capacity`` tokens, so gathering one is bounded. The mask
    of each sequence moves one place to the left, because a token is trained to
    give the next one. Packs whose mask counts exactly one token are dropped.
    """
    bins = assign_bins(df, key, ids, capacity, seed, algorithm)
    shifted = F.array_append(F.slice(mask, F.lit(2), F.greatest(F.size(mask) - 1, F.lit(0))), F.lit(0))
    placed = df.select(key, ids, shifted.alias(mask)).join(bins, key)
    members = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(ids).alias("ids"), F.col(mask).alias("mask"))))
    grouped = placed.groupBy("bin").agg(members.alias("_m"))
    lengths = F.transform("_m", lambda m: F.size(m["ids"]))
    packs = grouped.select(
        "bin",
        F.flatten(F.transform("_m", lambda m: m["ids"])).alias("input_ids"),
        F.flatten(F.transform("_m", lambda m: m["mask"])).alias("loss_mask"),
        boundaries(lengths).alias("seq_boundaries"),
    )
    return drop_degenerate(packs)


def drop_degenerate(packs: DataFrame, mask: str = "loss_mask") -> DataFrame:
    """Packs in which exactly one token is trained on are left out."""
    return packs.where(F.aggregate(mask, F.lit(0), lambda a, x: a + x) != 1)


def boundaries(lengths: Column) -> Column:
    """Cumulative lengths, starting at 0."""
    return F.aggregate(
        lengths, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n.cast("int"))
    )


def _sequences(ids: Column, edges: Column, skip_first: int, drop_last: int) -> Column:
    """The packed sequences without their first or last token."""
    def cut(both: Column) -> Column:
        starts = F.slice(both["edges"], F.lit(1), F.size(both["edges"]) - 1)
        return F.transform(
            starts,
            lambda start, i: F.slice(
                both["ids"], start + 1 + skip_first, F.get(both["edges"], i + 1) - start - skip_first - drop_last
            ),
        )

    return let(F.struct(ids.alias("ids"), edges.alias("edges")), cut)


def ceil_to_multiple(n: Column, multiple: int) -> Column:
    return (F.ceil(n / multiple) * multiple).cast("int")


def pack_columns(
    packs: DataFrame, pad_id: int, multiple: int = 16, max_length: int = 2048, pad_to_max_length: bool = False,
    cu_size: int | None = None,
) -> DataFrame:
    """Training arrays of packed samples, padded to a multiple.

    Tokens lose the last and labels the first token of every sequence. Adds the
    position inside the sequence, the cumulative lengths (closed at the padded
    length) and those without padding. ``pad_to_max_length`` gives all packs one length,
    and ``cu_size`` all lists of cumulative lengths one size, by repeating the last entry.
    """
    ids, edges = F.col("input_ids"), F.col("seq_boundaries")
    parts = packs.select(
        "*",
        F.flatten(_sequences(ids, edges, 0, 1)).alias("_tokens"),
        F.flatten(_sequences(ids, edges, 1, 0)).alias("_labels"),
        F.flatten(_sequences(F.col("loss_mask"), edges, 0, 1)).alias("_mask"),
        F.transform(_sequences(ids, edges, 0, 1), lambda s: F.size(s)).alias("_lengths"),
    )
    n = F.size("_tokens")
    padded = F.lit(max_length) if pad_to_max_length else F.least(ceil_to_multiple(n, multiple), F.lit(max_length))
    over = F.raise_error(F.lit("a pack is longer than max_length")).cast("int")
    parts = parts.withColumns({"_n": n, "_padded": F.when(n > max_length, over).otherwise(padded)})

    def pad(column: Column, value) -> Column:
        return F.concat(column, F.array_repeat(F.lit(value), F.col("_padded") - F.size(column)))

    positions = F.flatten(
        F.transform("_lengths", lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>")))
    )
    cu = boundaries(F.col("_lengths"))

    def sized(edges: Column) -> Column:
        if cu_size is None:
            return edges
        missing = F.lit(cu_size) - F.size(edges)
        over = F.raise_error(F.lit("a pack has more sequences than cu_size allows")).cast("int")
        return F.concat(edges, F.array_repeat(F.element_at(edges, -1), F.when(missing < 0, over).otherwise(missing)))

    closing = F.when(F.col("_n") != F.col("_padded"), F.array("_padded")).otherwise(F.array().cast("array<int>"))
    repeated = F.when(F.col("_n") != F.col("_padded"), F.array("_n")).otherwise(F.array().cast("array<int>"))
    return parts.select(
        *[c for c in packs.columns if c not in ("input_ids", "loss_mask")],
        pad(F.col("_tokens"), pad_id).alias("tokens"),
        pad(F.col("_labels"), pad_id).alias("labels"),
        pad(F.col("_mask"), 0).alias("loss_mask"),
        pad(positions, 0).alias("position_ids"),
        F.col("_n").alias("token_count"),
        sized(F.concat(cu, closing)).alias("cu_seqlens"),
        sized(F.concat(cu, repeated)).alias("cu_seqlens_unpadded"),
        F.array_max("_lengths").alias("max_seqlen"),
    )


def pack_report(packs: DataFrame, capacity: int) -> DataFrame:
    """Number of packs, sequences per pack, longest sequence and fill rate."""
    count = F.size("seq_boundaries") - 1
    tokens = F.element_at("seq_boundaries", -1) - count
    longest = F.array_max(
        F.zip_with(
            F.slice("seq_boundaries", F.lit(2), count), F.slice("seq_boundaries", F.lit(1), count), lambda b, a: b - a
        )
    )
    return packs.agg(
        F.count("*").alias("packs"),
        F.sum(count).alias("sequences"),
        F.max(count).alias("max_samples_per_bin"),
        F.max(longest).alias("dataset_max_seqlen"),
        (F.sum(tokens) / (F.count("*") * capacity)).alias("fill_rate"),
    )
