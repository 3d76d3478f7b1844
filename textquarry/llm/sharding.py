"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-partitioned by id. Each partition adds up its own sizes while it is
written, one total per partition gives every partition its starting byte, and a row
goes to the shard in whose equal share of all bytes its middle byte lies. No step
sees more than one partition's rows or one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import materialize, text_of
from textquarry.llm.global_order import global_order

ROW_BYTES = 8


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Return ``doc_id, size, text_crc32, shard, slot`` and, if asked, a struct ``doc``.

    Shards are contiguous in id order (NULL ids first; ties by size, checksum, then
    place in the input), so repeated rows each get a slot of their own. A NULL text
    has the size of an empty one. An empty table gives an empty result. ``carry``
    names columns that travel along inside ``doc``, where no name can clash.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = text_of(text_col)
    columns = [
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_tie"),
    ]
    if carry:
        columns.append(F.struct(*carry).alias("doc"))
    sized = materialize(docs.select(*columns), "shard-sizes")
    order = ["doc_id", "size", "text_crc32", "_tie"]
    twice_middle = (F.col("_before") * 2 + F.col("size")).cast("decimal(38,0)")
    placed = global_order(sized, order, "size", partitions).withColumn(
        "shard", F.floor(twice_middle * shards / (F.col("_total") * 2)).cast("int")
    )
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_row") - F.col("_first")).alias("slot"),
        *(["doc"] if carry else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, shard_col: str = "shard", **options) -> None:
    """Write the rows of ``docs`` to one folder ``shard_col=N`` per shard, in slot order.

    A column of ``docs`` named like ``shard_col`` is replaced by the folder's number.
    """
    placed = assign_shards(docs, shards, carry=docs.columns, **options)
    kept = [c for c in docs.columns if c.lower() != shard_col.lower()]
    (
        placed.select(
            F.col("shard").alias(shard_col), F.col("slot").alias("_slot"), *[F.col("doc")[c].alias(c) for c in kept]
        )
        .repartitionByRange(shard_col, "_slot")
        .sortWithinPartitions(shard_col, "_slot")
        .drop("_slot")
        .write.partitionBy(shard_col)
        .parquet(path)
    )
