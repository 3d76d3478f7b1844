"""Data-mix arithmetic: weights, epochs, shares and split plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.operators.joins import join_1to1, outer_fill


def _with_total(df: DataFrame, amount: str, name: str) -> DataFrame:
    """Attach the sum over the whole table. The total is one row."""
    total = df.agg(F.sum(amount).alias(name))
    return df.join(F.broadcast(total), F.lit(True), "left")


def share(df: DataFrame, amount: str, name: str = "weight") -> DataFrame:
    """Each row's part of the total."""
    return _with_total(df, amount, "_total").withColumn(name, F.col(amount) / F.col("_total")).drop("_total")


def make_datamix(
    stats: DataFrame, repeats: DataFrame, seq_length: int = 4096, batch_size: int = 1024, suffix: str = "_text_document"
) -> DataFrame:
    """Number of sequences per data set after repetition, next to the totals of the whole mix.

    Names must be unique on both sides. Sets without a repeat, or too small for one
    sequence, are left out.
    """
    joined = join_1to1(stats.select("name", "total_tokens"), repeats.select("name", "repeat"), "name")
    weight = F.floor(F.col("total_tokens") * F.col("repeat") / seq_length).cast("bigint")
    mix = joined.select(F.concat("name", F.lit(suffix)).alias("name"), weight.alias("weight")).where("weight > 0")
    steps = F.floor(F.col("_total") / batch_size).cast("bigint")
    return _with_total(mix, "weight", "_total").select(
        "name", "weight", steps.alias("max_steps"), (steps * seq_length * batch_size).alias("total_tokens")
    )


def datamix_document(mix: DataFrame, data_path: str) -> DataFrame:
    """The mix as the one nested record a trainer reads; a mix names a few hundred data sets."""
    train = F.array_sort(F.collect_list(F.struct("name", "weight")))
    return mix.agg(F.lit(data_path).alias("data_path"), F.max("total_tokens").alias("total_tokens"), train.alias("train"))


# Repetition of each duplication cluster.
REHYDRATION = {"1": 1, "2": 2, "3": 3, "4": 3, "5-100": 5, "100-1000": 8, "1000+": 1}


def parse_tokens(text: str) -> int:
    """``35b`` -> 35 000 000 000; ``2m`` and plain numbers likewise."""
    units = {"b": 10**9, "m": 10**6}
    unit = units.get(text[-1:].lower())
    number = text[:-1] if unit else text
    try:
        return round(float(number) * (unit or 1))
    except ValueError as error:
        raise ValueError(f"not a number of tokens: {text}") from error


def make_ablation_mix(
    stats: DataFrame, upsampling: Column, target_tokens: str = "35b", weights: dict[str, int] | None = None
) -> DataFrame:
    """Shares of a mix whose clustered sets are repeated by cluster size.

    ``stats`` has ``name``, ``group_type``, ``group_name`` and ``total_tokens``. Adds
    the share of the mix, the epochs each set is seen for the target size, and a
    flag for more than one epoch.
    """
    table = F.create_map(*[F.lit(x) for pair in (weights or REHYDRATION).items() for x in pair])
    clustered = F.coalesce(F.col("group_type") == "cluster", F.lit(False))
    repeat = F.when(clustered, F.coalesce(F.try_element_at(table, F.col("group_name")), F.lit(1))).otherwise(1)
    amounts = stats.withColumn("rehydration", repeat.cast("bigint")).withColumn(
        "upsampled", F.col("total_tokens") * F.col("rehydration") * upsampling.cast("double")
    )
    mixed = share(amounts, "upsampled", "weight").where("weight > 0")
    epochs = F.col("weight") * parse_tokens(target_tokens) / F.col("total_tokens")
    return mixed.withColumn("epochs", epochs).withColumn("over_one_epoch", F.col("epochs") > 1)


def epochs(mix: DataFrame, stats: DataFrame, total_tokens: int | Column, suffix: str = "_text_document") -> DataFrame:
    """How often each data set is read: its tokens in the mix over its available tokens."""
    named = mix.withColumn("name", F.regexp_replace("name", f"{suffix}$", ""))
    total = total_tokens if isinstance(total_tokens, Column) else F.lit(total_tokens)
    sized = share(named, "weight", "_share").withColumn("tokens", F.col("_share") * total)
    joined = join_1to1(sized.select("name", "tokens"), stats.select("name", F.col("total_tokens").alias("available")), "name")
    return joined.withColumn("epochs", F.bround(F.col("tokens") / F.col("available"), 2))


def split_plan(first: DataFrame, second: DataFrame) -> DataFrame:
    """Which fraction of each data set goes to two phases that repeat it fractionally.

    Whole repeats need no split, so only the parts after the decimal point count;
    what neither phase takes is the remainder. Sets that need no split are left out.
    """
    def parts(df: DataFrame) -> DataFrame:
        return df.select("name", F.pmod(F.col("repeat"), F.lit(1.0)).alias("modulo"))

    plan = outer_fill(parts(first), parts(second), "name", ("_phase1", "_phase2"), 0.0)
    rest = F.pmod(1 - F.col("modulo_phase1") - F.col("modulo_phase2"), F.lit(1.0))
    out = plan.withColumn("remainder", rest)
    return out.where("modulo_phase1 > 0 OR modulo_phase2 > 0 OR remainder > 0")
