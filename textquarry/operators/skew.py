"""A left join that does not depend on how evenly the keys are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 10_000


def _named(key: str) -> Column:
    return F.concat(F.lit("="), F.col(key).cast("string"))


def lookup_by_frequency(
    left: DataFrame,
    right: DataFrame,
    key: str,
    frequency: str,
    spread_by: list[str],
    total: int | None = None,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join with a table that is unique by ``key`` and knows how often each key occurs.

    A key is hot if it makes up more than one in ``hot_keys`` of all occurrences,
    so there are fewer than ``hot_keys`` of them, whatever the data. The row of a hot
    key is copied once for each such share it has, at most ``2 * hot_keys`` rows in
    all, and the rows that ask for it are dealt over the copies by ``spread_by``; only
    the hot keys with their number of copies are broadcast. Rows without a key meet
    nothing and are spread too. ``total`` is the number of occurrences if it is known.
    """
    columns = [c for c in right.columns if c != key]
    packed = F.struct(*columns)
    if total is None:
        # One row.
        sums = right.agg(F.sum(frequency).alias("_total"))
        marked = right.join(F.broadcast(sums), F.lit(True))
    else:
        marked = right.withColumn("_total", F.lit(total))
    share = F.ceil(F.col(frequency) * hot_keys / F.col("_total")).cast("int")
    # Never NULL, so no filter is inferred and both sides share one computation of ``right``.
    named = marked.withColumn("_rk", F.coalesce(_named(key), F.lit(""))).withColumn("_copies", F.greatest(share, F.lit(1)))
    hot = named.where("_copies > 1").select(F.col("_rk").alias("_hk"), F.col("_copies").alias("_hc"))
    copied = named.select("_rk", packed.alias("_v"), F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    copied = copied.select(F.concat("_rk", F.lit("#"), "_copy").alias("_ck"), "_v")

    first = left.withColumn("_lk", _named(key)).join(F.broadcast(hot), F.col("_lk") == F.col("_hk"), "left")
    dealt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_hc", F.lit(1)))
    own = F.concat(F.lit("#"), F.xxhash64(*spread_by).cast("string"))
    joined_on = F.coalesce(F.concat("_lk", F.lit("#"), dealt), own)
    second = first.withColumn("_jk", joined_on).join(copied, F.col("_jk") == F.col("_ck"), "left")
    return second.select(*left.columns, *[F.col(f"_v.{c}").alias(c) for c in columns])


HEAD_ROWS = 200_000


def split_by_frequency(table: DataFrame, frequency: str, head_rows: int = HEAD_ROWS) -> tuple[DataFrame, DataFrame]:
    """The most frequent rows of a table, at most ``head_rows`` of them, and the rest.

    The least frequency of the head is read from a histogram on a scale of quarter octaves, so a few
    hundred counts reach the driver. A key of the rest makes up less than one in ``head_rows`` of all.
    """
    step = F.floor(F.log2(F.col(frequency)) * 4)
    steps = table.where(F.col(frequency) > 0).groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min(frequency).alias("least"))
    taken, least = 0, None
    for row in sorted(steps.collect(), key=lambda r: -r.step):
        taken += row.n
        if taken > head_rows:
            break
        least = row.least
    inside = F.lit(False) if least is None else F.coalesce(F.col(frequency) >= least, F.lit(False))
    return table.where(inside), table.where(~inside)


def lookup_head_first(
    left: DataFrame, right: DataFrame, key: str, frequency: str, spread_by: list[str], head_rows: int = HEAD_ROWS
) -> DataFrame:
    """``lookup_by_frequency`` that shuffles only what the most frequent rows of ``right`` don't answer.

    At most ``head_rows`` rows of ``right`` are broadcast; where that is the whole table nothing is
    shuffled. ``left`` is read twice otherwise.
    """
    columns = [c for c in right.columns if c != key]
    head, tail = split_by_frequency(right, frequency, head_rows)
    packed = F.struct(*columns).alias("_hv")
    first = left.join(F.broadcast(head.select(F.col(key).alias("_hk"), packed)), F.col(key) == F.col("_hk"), "left")
    answered = [*left.columns, *[F.col(f"_hv.{c}").alias(c) for c in columns]]
    if tail.isEmpty():
        return first.select(*answered)
    rest = first.where("_hk IS NULL").select(*left.columns)
    return first.where("_hk IS NOT NULL").select(*answered).unionByName(lookup_by_frequency(rest, tail, key, frequency, spread_by))
