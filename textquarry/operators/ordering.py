"""Global and per-group order at cluster scale.

A plain window over the whole table, or over one hot key, pulls every row into
one task. Here the rows are cut into ranges of the order key first. Each range
is a window of its own, and the few range totals are carried forward, so a
group that holds a third of the table is spread over many tasks. The bounds come
from a hash sample of the keys, hence they are the same when a lost task is
recomputed or when the two branches of the plan are evaluated separately.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 10_000
SAMPLES_PER_RANGE = 10


def _bounds(df: DataFrame, keys: list[str], rows: int, ranges: int) -> list[tuple]:
    """At most ``ranges - 1`` key tuples that split the table into even parts.

    About ``SAMPLES_PER_RANGE * ranges`` distinct keys reach the driver, however
    large the table is and however often one key repeats.
    """
    step = max(1, rows // (ranges * SAMPLES_PER_RANGE))
    chosen = (
        df.select(*keys)
        .where(F.pmod(F.xxhash64(*keys), F.lit(step)) == 0)
        .distinct()
        .orderBy(*keys)
    )
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    as_text = [
        F.col(k).cast("string").alias(k) if isinstance(df.schema[k].dataType, temporal) else F.col(k)
        for k in keys
    ]
    sample = [tuple(r) for r in chosen.select(*as_text).collect()]
    if len(sample) < 2:
        return []
    cuts = sorted({round(i * len(sample) / ranges) for i in range(1, ranges)} - {0, len(sample)})
    return [sample[c] for c in cuts]


def _literal(types: list[T.DataType], bounds: list[tuple]) -> Column | None:
    """The bounds as one constant instead of an expression for each value, where JSON holds the types as they are."""
    plain = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.StringType, T.BooleanType)
    if not all(isinstance(t, plain) for t in types):
        return None
    if any(isinstance(v, float) and not math.isfinite(v) for bound in bounds for v in bound):
        return None
    text = json.dumps([{f"k{i}": v for i, v in enumerate(bound)} for bound in bounds])
    schema = T.ArrayType(T.StructType([T.StructField(f"k{i}", t) for i, t in enumerate(types)]))
    return F.from_json(F.lit(text), schema)


def range_number(df: DataFrame, keys: list[str], bounds: list[tuple]) -> Column:
    """How many bounds lie below the row's key, by binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    types = [df.schema[k].dataType for k in keys]

    def packed(values: list[Column]) -> Column:
        return F.struct(*[v.cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))])

    edges = _literal(types, bounds)
    if edges is None:
        edges = F.array(*[packed([F.lit(v) for v in bound]) for bound in bounds])
    key = packed([F.col(k) for k in keys])
    steps = [2**p for p in range(int(math.log2(len(bounds))), -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.get(edges, low + step - 1) < key), low + step
        ).otherwise(low),
    )


def split_ranges(df: DataFrame, keys: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``_range``: consecutive numbers over consecutive slices of the key order.

    A table that was cut before, for the same keys, is returned as it is.
    """
    if "_range" in df.columns:
        return df
    rows = df.count()
    ranges = min(MAX_RANGES, math.ceil(rows / rows_per_range)) if rows else 1
    bounds = _bounds(df, keys, rows, ranges) if ranges > 1 else []
    return df.withColumn("_range", range_number(df, keys, bounds))


def running(
    df: DataFrame,
    order: list[str],
    sums: dict[str, Column],
    partition: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Inclusive running sums in ``order``, optionally restarting per ``partition``.

    ``order`` must end in a column that makes rows distinct. A running count
    (``F.lit(1)``) is a row number.
    """
    partition = partition or []
    values = {f"_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(sums.values())}
    cut = split_ranges(df, partition + order, rows_per_range).withColumns(values)
    inside = (
        W.partitionBy("_range", *partition)
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = cut.withColumns({f"_s{i}": F.sum(v).over(inside) for i, v in enumerate(values)})

    # One row per range and group. A group covers neighbouring ranges, so at most
    # MAX_RANGES rows have a predecessor and survive the filter: safe to broadcast.
    totals = cut.groupBy("_range", *partition).agg(*[F.sum(v).alias(v) for v in values])
    before = W.partitionBy(*partition).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carry = (
        totals.withColumns({f"_c{i}": F.sum(v).over(before) for i, v in enumerate(values)})
        .where(F.col("_c0").isNotNull())
        .select(
            F.col("_range").alias("_r"),
            *[F.col(p).alias(f"_p{i}") for i, p in enumerate(partition)],
            *[f"_c{i}" for i in range(len(values))],
        )
    )
    on = F.col("_range") == F.col("_r")
    for i, p in enumerate(partition):
        on = on & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return local.join(F.broadcast(carry), on, "left").select(
        *[F.col(c) for c in df.columns],
        *[
            (F.col(f"_s{i}") + F.coalesce(F.col(f"_c{i}"), F.lit(0))).alias(name)
            for i, name in enumerate(sums)
        ],
    )


def numbered(
    df: DataFrame,
    order: list[str],
    name: str = "row_number",
    partition: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Row numbers from 1 in ``order``, without a one-task window."""
    return running(df, order, {name: F.lit(1).cast("bigint")}, partition, rows_per_range)


def previous(
    df: DataFrame, order: list[str], columns: dict[str, str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """The value of the row before in the global order (NULL for the first row)."""
    cut = split_ranges(df, order, rows_per_range)
    inside = W.partitionBy("_range").orderBy(*order)
    local = cut.withColumns({new: F.lag(old).over(inside) for new, old in columns.items()})
    local = local.withColumn("_first", F.row_number().over(inside) == 1)
    # One row per range: its last values, handed to the next range that has rows.
    last = cut.groupBy("_range").agg(
        F.max_by(F.struct(*columns.values()), F.struct(*order)).alias("_last")
    )
    handed = last.select(
        F.lead("_range").over(W.orderBy("_range")).alias("_r"), F.col("_last").alias("_handed")
    ).where(F.col("_r").isNotNull())
    joined = local.join(
        F.broadcast(handed), (F.col("_range") == F.col("_r")) & F.col("_first"), "left"
    )
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(F.col("_first"), F.col(f"_handed.{old}")).otherwise(F.col(new)).alias(new)
            for new, old in columns.items()
        ],
    )
