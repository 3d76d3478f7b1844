"""Near-duplicates by SimHash with meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart have a common point at most half that
far from each. So every distinct fingerprint emits all its variants within
``radius / 2`` bits, rows meet on equal variants, and all fingerprints that meet at one
variant are within ``radius`` of each other: linking each to the smallest one loses no
connection, and a meeting never has more members than a ball has points (65 for 64
bits and radius 2), however many documents share a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import ASCII_LOWER, WORD, materialize, slices, text_of
from textquarry.llm.components import connected_components

BITS = 64
SEED = 42


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as an unsigned number."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 4096):  # a few hundred kB at a time, however long the text
        block = np.ascontiguousarray(hashes[start : start + 4096].astype(">u8")).view(np.uint8)
        ones += np.unpackbits(block.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles (repeats count) as an unsigned number."""
    words = WORD.findall(text.translate(ASCII_LOWER))
    if not words:
        return 0
    width = min(shingle, len(words))
    hashes = np.fromiter(
        (
            xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), SEED)
            for i in range(len(words) - width + 1)
        ),
        np.uint64,
        len(words) - width + 1,
    )
    return majority(hashes)


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fp``: each row's fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = np.fromiter(
                (fingerprint(t, shingle) for t in part.column(1).to_pylist()), np.uint64, part.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"]
            )

    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])
    return source.mapInArrow(run, schema)


def ball_masks(radius: int) -> list[int]:
    """All 64-bit patterns with at most ``radius`` ones, as signed numbers."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(distinct_fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all pairs within ``radius``."""
    if radius % 2 or radius < 0:
        raise ValueError("radius must be even")
    masks = F.array(*[F.lit(m).cast("bigint") for m in ball_masks(radius // 2)])
    variants = distinct_fps.select("fp", F.explode(masks).alias("_mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("_mask")).alias("_variant")
    )
    met = variants.withColumn("_least", F.min("fp").over(W.partitionBy("_variant")))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (
        met.where(F.col("fp") != F.col("_least"))
        .select(F.col("fp").alias("a"), F.col("_least").alias("b"))
        .distinct()
        .where(apart <= radius)
    )


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked, and
    ``component_id`` is the smallest id that links reach. NULL, empty and blank texts
    have fingerprint zero. Repeated rows come back as often as they came; a NULL id
    takes part, but names a group only if the group has no other id (then NULL).
    """
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct_fps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("_first")), "distinct-fingerprints")
    components = materialize(connected_components(near_links(distinct_fps, radius)), "components")
    labelled = distinct_fps.join(
        components.withColumnRenamed("node", "fp"), "fp", "left"
    ).withColumn("component", F.coalesce("component", "fp"))
    # Only linked fingerprints share a component; their smallest id is an aggregate.
    first = labelled.groupBy("component").agg(F.min("_first").alias("component_id"))
    by_fp = materialize(labelled.join(first, "component").select("fp", "component_id"), "groups")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` for each ``component`` of ``doc_id, h1, h2, component``.

    A row is known by its id and text (``h1`` and ``h2`` are ``xxhash64(text)`` and
    ``xxhash64(42, text)``): of a group the smallest stays, NULL ids last, and of rows equal in
    both any one.
    """
    row = ["_null", "doc_id", "h1", "h2"]
    least = groups.withColumn("_null", F.col("doc_id").isNull()).groupBy("component").agg(F.min(F.struct(*row)).alias("_row"))
    keep = materialize(least.select(*[F.col(f"_row.{c}").alias(f"_keep_{c}") for c in row[1:]]), "kept-rows")
    text = text_of("text")
    # The row stays in one column, whatever its columns are called.
    marked = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_whole"),
        docs["doc_id"].alias("_id"),
        F.xxhash64(text).alias("_1"),
        F.xxhash64(F.lit(SEED), text).alias("_2"),
    )
    same = (
        marked["_id"].eqNullSafe(keep["_keep_doc_id"])
        & (marked["_1"] == keep["_keep_h1"])
        & (marked["_2"] == keep["_keep_h2"])
    )
    kept = marked.join(keep, same, "left_semi").dropDuplicates(["_id", "_1", "_2"])
    return kept.select(*[F.col("_whole")[c].alias(c) for c in docs.columns])


def keep_one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each group of ``simhash_groups`` (see ``keep_one``)."""
    text = text_of("text")
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(SEED), text).alias("h2"))
    named = keyed.withColumn("_name", F.struct("doc_id", "h1", "h2"))
    fps = materialize(fingerprints(named, shingle, "_name"), "fingerprints")
    components = materialize(
        connected_components(near_links(materialize(fps.select("fp").distinct(), "distinct-fingerprints"), radius)),
        "components",
    )
    groups = fps.join(components.withColumnRenamed("node", "fp"), "fp", "left").select(
        "doc_id.*", F.coalesce("component", "fp").alias("component")
    )
    return keep_one(docs, groups)
