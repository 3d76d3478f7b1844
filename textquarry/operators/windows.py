"""Order-dependent operators, built on range-split windows."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.hashing import uniform
from textquarry.functions.text import geometric_break
from textquarry.operators.ordering import (
    ROWS_PER_RANGE,
    numbered,
    previous,
    running,
    split_ranges,
)
from textquarry.session import written


def ordered_distinct(values: Column) -> Column:
    """Distinct items of a list, in order of first appearance."""
    return F.array_distinct(values)


def run_ids(
    df: DataFrame, order: list[str], key: str, name: str = "run_id", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Number the runs of adjacent rows with an equal key."""
    # Written twice, each time before the table is read for counts, bounds, totals and rows.
    cut = split_ranges(written(df, "ordered"), order, rows_per_range)
    seen = written(previous(cut, order, {"_before": key}, rows_per_range), "neighbours")
    start = (~F.col("_before").eqNullSafe(F.col(key))).cast("bigint")
    numbered_runs = running(seen, order, {name: start}, rows_per_range=rows_per_range)
    return numbered_runs.drop("_before", "_range")


def group_runs(
    df: DataFrame, order: list[str], key: str, values: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adjacent rows with an equal key become one row with their values as lists.

    One run is one output record; separate runs of a key stay separate, so a
    frequent key does not gather in one place.
    """
    runs = run_ids(df, order, key, rows_per_range=rows_per_range)
    listed = F.array_sort(F.collect_list(F.struct(*order, *[F.col(v).alias(f"_{v}") for v in values])))
    grouped = runs.groupBy("run_id").agg(F.any_value(key).alias(key), F.count("*").alias("n"), listed.alias("_l"))
    return grouped.select("run_id", key, "n", *[F.col(f"_l._{v}").alias(v) for v in values])


def budget_cutoff(
    df: DataFrame, order: list[str], size: Column, budget: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Rows of the narrow key table whose running size stays within ``budget``."""
    narrow = df.select(*order, size.alias("_size"))
    return running(narrow, order, {"running": F.col("_size")}, rows_per_range=rows_per_range).where(
        F.col("running") <= budget
    )


def take_until(
    df: DataFrame, order: list[str], size: Column, budget: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """The leading rows whose sizes together stay within ``budget``.

    The row that crosses the limit and all later rows are left out. Sizes must not
    be negative. Only keys and sizes are ordered; the wide rows are then filtered
    by one comparison with the last key that fits.
    """
    fits = budget_cutoff(df, order, size, budget, rows_per_range)
    last = fits.agg(F.max(F.struct(*order)).alias("_last"))
    # ``last`` is one row.
    return df.join(F.broadcast(last), F.struct(*order) <= F.col("_last"), "left_semi")


def every_kth(df: DataFrame, order: list[str], k: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows number k, 2k, 3k, ... in the order."""
    return numbered(df, order, "_n", rows_per_range=rows_per_range).where(F.col("_n") % k == 0).drop("_n")


def moving_average(
    df: DataFrame, order: str, value: str, window: int, partition: list[str], others: list[str] | None = None
) -> DataFrame:
    """Centered average over full windows only; other columns are those of the middle row.

    With fewer rows than the window the series is returned as it is. A series is
    the scores of one experiment, so a group is small by nature.
    """
    if window < 2:
        return df.select(*partition, order, *(others or []), F.col(value).alias("smoothed"))
    pad = window // 2
    series = W.partitionBy(*partition)
    middle = series.orderBy(order).rowsBetween(-pad, window - 1 - pad)
    out = df.select(
        *partition, order, *(others or []), F.col(value).alias("_v"),
        F.avg(value).over(middle).alias("smoothed"),
        F.count("*").over(middle).alias("_full"),
        F.count("*").over(series).alias("_all"),
    )
    return out.where((F.col("_full") == window) | (F.col("_all") < window)).select(
        *partition, order, *(others or []),
        F.when(F.col("_all") < window, F.col("_v")).otherwise(F.col("smoothed")).alias("smoothed"),
    )


def series_rows(df: DataFrame, by: list[str], order: str, values: list[str]) -> DataFrame:
    """One row per series with its points as parallel arrays in order. Non-positive orders are left out."""
    points = F.array_sort(F.collect_list(F.struct(order, *values)))
    grouped = df.where(F.col(order) > 0).groupBy(*by).agg(points.alias("_p"))
    return grouped.select(*by, *[F.col(f"_p.{c}").alias(c) for c in [order, *values]])


def pick_checkpoint(df: DataFrame, arrays: list[str], index: int) -> DataFrame:
    """The point at ``index`` of each series; negative counts from the end. Out of range is an error."""
    at = index + 1 if index >= 0 else index
    return df.withColumns({c: F.element_at(c, at) for c in arrays})


def truncate_series(df: DataFrame, order: str, arrays: list[str], most: float) -> DataFrame:
    """Cut each series after its last point at or below ``most``."""
    kept = F.size(F.filter(order, lambda x: x <= most))
    return df.withColumn("_k", kept).withColumns({c: F.slice(c, F.lit(1), F.col("_k")) for c in [order, *arrays]}).drop("_k")


class _Range:
    """The greedy bins of one range of rows, for any load with which a bin reaches into it."""

    def __init__(self, sizes: np.ndarray, cap: int):
        self.cap = cap
        self.upto = np.concatenate(([0], np.cumsum(sizes)))
        starts = np.arange(len(sizes))
        # The row that opens the next bin if this row opens one.
        self.next = np.maximum(np.searchsorted(self.upto, self.upto[:-1] + cap, "right") - 1, starts + 1)

    def first(self, load: int) -> int:
        """The first row that does not fit onto ``load``; the number of rows if all do."""
        return int(np.searchsorted(self.upto[1:], self.cap - load, "right"))

    def starts(self, load: int) -> np.ndarray:
        found, at = [], self.first(load)
        while at < len(self.next):
            found.append(at)
            at = int(self.next[at])
        return np.array(found, np.int64)

    def transfers(self) -> list[tuple[int, bool, int, int]]:
        """``least, adds, left, bins``: from an entering load of ``least`` on, the load that leaves and the bins opened.

        ``adds`` tells that no bin opens and the range's whole size adds to the load. Neighbouring
        loads with one result are one entry; bins soon fall into step, so a long range has few.
        """
        rows, last = len(self.next), self.first(0)
        table = [(0, True, int(self.upto[-1]), 0)] if last == rows else []
        known: dict[int, tuple[int, int]] = {}
        for at in range(min(last, rows - 1), -1, -1):
            way, here = [], at
            while here < rows and here not in known:
                way.append(here)
                here = int(self.next[here])
            for row in reversed(way):
                onward = int(self.next[row])
                if onward < rows:
                    left, bins = known[onward]
                    known[row] = left, bins + 1
                else:
                    known[row] = int(self.upto[-1] - self.upto[row]), 1
            left, bins = known[at]
            if not table or table[-1][1:] != (False, left, bins):
                table.append((max(int(self.cap - self.upto[at + 1]) + 1, 0), False, left, bins))
        return table


def _compose(batches: Iterator[pd.DataFrame], cap: int) -> Iterator[pd.DataFrame]:
    """From the ranges' transfer tables, in order, the load and the bins that reach each range."""
    load, bins, number, table = cap + 1, 0, None, []

    def passed() -> tuple[int, int]:
        least, adds, left, opened = table[bisect_right([t[0] for t in table], load) - 1]
        return (load + left if adds else left), bins + opened

    for pdf in batches:
        out = []
        for row in zip(*(pdf[c].tolist() for c in ("_range", "least", "adds", "left", "bins"))):
            if row[0] != number:
                if number is not None:
                    load, bins = passed()
                number, table = row[0], []
                out.append((number, load, bins))
            table.append(row[1:])
        yield pd.DataFrame(out, columns=["_range", "load", "before"])


def ordered_bins(
    df: DataFrame, order: list[str], size: str, cap: int, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Cut the ordered rows into bins whose sizes sum to at most ``cap``; adds ``bin`` from 0.

    A bin is filled until the next row would not fit, and a row larger than the cap
    is alone. Where bins start in a range of rows depends on the rows before only through
    the load of the bin that reaches into it. So each range first says, by itself, what
    it makes of any load: the load that leaves it and the bins it opens, a step function
    with few steps. One pass over these small tables gives the load that enters
    each range, and then every range cuts its own bins. Sizes are not negative; NULL counts as 0.
    """
    narrow = df.select(*order, F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("_size"))
    cut = written(split_ranges(written(narrow, "sizes"), order, rows_per_range), "ranges")

    def transfers(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.sort_values(order, na_position="first")["_size"].to_numpy()
        table = pd.DataFrame(_Range(sizes, cap).transfers(), columns=["least", "adds", "left", "bins"])
        return table.assign(_range=pdf["_range"].iloc[0])

    tables = cut.groupBy("_range").applyInPandas(
        transfers, "_range int, least bigint, adds boolean, left bigint, bins bigint"
    )
    # A few rows per range, read in order.
    steps = written(tables.repartition(1).sortWithinPartitions("_range", "least"), "transfers")
    entering = steps.coalesce(1).sortWithinPartitions("_range", "least").mapInPandas(
        lambda batches: _compose(batches, cap), "_range int, load bigint, before bigint"
    )
    placed = cut.join(F.broadcast(written(entering, "entering")), "_range")

    def bins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, na_position="first")
        opened = np.zeros(len(pdf), np.int64)
        opened[_Range(pdf["_size"].to_numpy(), cap).starts(int(pdf["load"].iloc[0]))] = 1
        return pdf[order].assign(bin=int(pdf["before"].iloc[0]) + np.cumsum(opened) - 1)

    schema = T.StructType([*[narrow.schema[c] for c in order], T.StructField("bin", T.LongType())])
    return df.join(placed.groupBy("_range").applyInPandas(bins, schema), order)


def epoch_order(df: DataFrame, key: str, n: int, seed: int = 42, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``n`` samples as a sequence of epochs, each a fresh shuffle of all rows.

    The last epoch is cut, so the table is up- or down-sampled to exactly ``n``.
    """
    size = df.count()
    if size == 0:
        return df.select(key, F.lit(0).alias("epoch"), F.lit(0).cast("bigint").alias("position")).limit(0)
    epochs = -(-n // size)
    drawn = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    drawn = written(drawn.withColumn("_u", uniform(key, "epoch", seed=seed)), "drawn")
    return numbered(drawn, ["epoch", "_u", key], "position", rows_per_range=rows_per_range).where(
        F.col("position") <= n
    ).drop("_u")


def geometric_chunks(
    df: DataFrame, group: str, order: str, values: list[str], p: float = 1 / 3, seed: int = 42,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Cut each group's rows into chunks of geometric random length and join the parallel texts."""
    ends = geometric_break(group, order, p=p, seed=seed).cast("bigint")
    counted = running(df, [order], {"_ended": ends}, partition=[group], rows_per_range=rows_per_range)
    chunk = F.col("_ended") - ends
    listed = F.array_sort(F.collect_list(F.struct(order, *values)))
    grouped = counted.groupBy(group, chunk.alias("chunk_id")).agg(F.count("*").alias("n"), listed.alias("_l"))
    return grouped.select(
        group, "chunk_id", "n", *[F.array_join(F.col(f"_l.{v}"), "\n").alias(v) for v in values]
    )


def with_offsets(df: DataFrame, order: list[str], size: Column, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Start offset of each document in the concatenated token stream, and its document number.

    Pass only the columns that are needed: the table is written once before it is ordered.
    """
    sized = written(df.withColumn("_size", size.cast("bigint")), "sizes")
    out = running(
        sized, order, {"_upto": F.col("_size"), "_n": F.lit(1).cast("bigint")}, rows_per_range=rows_per_range
    )
    return out.select(
        *df.columns, (F.col("_upto") - F.col("_size")).alias("offset"), (F.col("_n") - 1).alias("doc_index")
    )


def preview(df: DataFrame, order: list[str], head: int = 6, tail: int = 5) -> DataFrame:
    """The first and the last rows of the order, from two bounded top-n passes."""
    first = df.orderBy(*order).limit(head)
    last = df.orderBy(*[F.col(c).desc() for c in order]).limit(tail)
    return first.unionByName(last).distinct()
