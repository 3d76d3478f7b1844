"""Places and prefix sums in a global order, from one total per partition.

Rows are range-partitioned by the order, each partition adds up its own rows while it
is written, and one row per partition gives every partition its starting point. No step
sees more than one partition's rows or one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import materialize


def global_order(df: DataFrame, order: list[str], weight: str, partitions: int | None = None) -> DataFrame:
    """Add ``_row`` (from 0), ``_before`` (weight of the rows before) and ``_total`` (weight of all).

    ``df`` must be a table that reads back the same (written, not computed anew); the
    long column ``weight`` must have no NULL and ``order`` must not leave ties. Range
    partitioning splits any hot prefix of the order.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def add_running_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, weight_before, rows_before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            weights = batch.column(weight).to_numpy()
            ends = weight_before + np.cumsum(weights)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(weights), part, np.int32)),
                    pa.array(ends - weights),
                    pa.array(rows_before + np.arange(len(weights), dtype=np.int64)),
                ],
                names=[*batch.schema.names, "_part", "_start", "_index"],
            )
            rows_before += len(weights)
            weight_before = int(ends[-1]) if len(weights) else weight_before

    schema = T.StructType(
        df.schema.fields
        + [
            T.StructField("_part", T.IntegerType()),
            T.StructField("_start", T.LongType()),
            T.StructField("_index", T.LongType()),
        ]
    )
    ordered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # Written once: a partition's number and its running sums come from one attempt.
    summed = materialize(ordered.mapInArrow(add_running_sums, schema), "running-sums")

    # One row per partition.
    totals = summed.groupBy("_part").agg(F.sum(weight).alias("_weight"), F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_weight_offset"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_offset"),
        F.sum("_weight").over(W.partitionBy(F.lit(1))).alias("_total"),
    )
    return summed.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_row_offset") + F.col("_index")).alias("_row"),
        (F.col("_weight_offset") + F.col("_start")).alias("_before"),
        "_total",
    )
