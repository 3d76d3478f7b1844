"""Packing of conversation turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.text import words
from textquarry.operators import packing as X
from textquarry.operators.tokens import answer_loss_mask
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import n_words

CAPACITY = 8192


def sequences(t):
    """Token lists of turns; a token id is a hash of the word."""
    ids = F.transform(words(F.col("text")), lambda w: F.pmod(F.hash(w), F.lit(32_000)) + 2)
    rows = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq_id"), ids.alias("input_ids"))
    rows = rows.where("size(input_ids) > 0")
    return rows.withColumn("loss_mask", answer_loss_mask(F.col("input_ids"), F.lit(3)))


_LENGTHS = f"WITH w AS (SELECT conv_id * 1000 + turn AS seq_id, {n_words('text')} AS n FROM conversations), s AS (SELECT * FROM w WHERE n > 0)"


@query("pack_length_histogram", "PK1 A4", f"{_LENGTHS} SELECT (n - 1)::INT AS length, count(*)::BIGINT AS n FROM s GROUP BY 1")
def pack_length_histogram(t):
    return X.pack_length_histogram(sequences(t))


@query(
    "pack_totals", "PK1 F18",
    f"{_LENGTHS} SELECT count(*)::BIGINT AS sequences, sum(n)::BIGINT AS tokens, sum(greatest(n - 3, 0))::BIGINT AS loss_tokens FROM s",
)
def pack_totals(t):
    packs = X.pack(sequences(t), "seq_id", capacity=CAPACITY)
    return packs.agg(
        F.sum(F.size("seq_boundaries") - 1).alias("sequences"), F.sum(F.size("input_ids")).alias("tokens"),
        F.sum(F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x)).alias("loss_tokens"),
    )


@query("pack_sequences", "PK1")
def pack_sequences(t):
    packs = X.pack(sequences(t), "seq_id", capacity=CAPACITY, algorithm="first_fit_decreasing")
    return packs.select("bin", F.size("input_ids").alias("n_tokens"), F.size("seq_boundaries").alias("n_boundaries"))


@query(
    "pack_columns", "PK2",
    f"{_LENGTHS} SELECT sum(n - 1)::BIGINT AS token_count, sum(((n - 1) * (n - 2)) // 2)::BIGINT AS positions FROM s",
)
def pack_columns(t):
    packs = X.pack(sequences(t), "seq_id", capacity=CAPACITY)
    out = X.pack_columns(packs, pad_id=1, max_length=CAPACITY)
    return out.agg(
        F.sum("token_count").alias("token_count"),
        F.sum(F.aggregate("position_ids", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("positions"),
    )


@query(
    "pack_report", "PK3",
    f"{_LENGTHS} SELECT count(*)::BIGINT AS sequences, max(n)::INT AS dataset_max_seqlen FROM s",
)
def pack_report(t):
    report = X.pack_report(X.pack(sequences(t), "seq_id", capacity=CAPACITY), CAPACITY)
    return report.select("sequences", "dataset_max_seqlen")


@query("pack_fill_rate", "PK3")
def pack_fill_rate(t):
    return X.pack_report(X.pack(sequences(t), "seq_id", capacity=CAPACITY), CAPACITY)
