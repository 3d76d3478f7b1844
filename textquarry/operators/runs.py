"""Training-run logs, run costs and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textquarry.operators.ordering import ROWS_PER_RANGE, numbered


def step_stats(
    logs: DataFrame, run: str = "run", warmup: int = 5, order: tuple[str, ...] = ("iteration",),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per run: first time, iterations, and mean and population deviation of the step time after warm-up.

    A run with no more steps than the warm-up uses all of them. The total counts
    every step.
    """
    columns = dict.fromkeys([run, *order, "iteration", "step_seconds"])
    steps = logs.where("step_seconds IS NOT NULL").select(*columns)
    ranked = numbered(steps, list(order), "_n", partition=[run], rows_per_range=rows_per_range)
    late = F.when(F.col("_n") > warmup, F.col("step_seconds"))
    timing = ranked.groupBy(run).agg(
        F.min("iteration").alias("min_iteration"),
        F.max("iteration").alias("max_iteration"),
        F.coalesce(F.avg(late), F.avg("step_seconds")).alias("step_timings_mean"),
        F.coalesce(F.stddev_pop(late), F.stddev_pop("step_seconds")).alias("step_timings_std"),
        F.sum("step_seconds").alias("total_time"),
    )
    started = logs.groupBy(run).agg(F.min("logged_at").alias("start_time"))
    return timing.join(started, run)


def run_cost(df: DataFrame) -> DataFrame:
    """Cost columns from batch size, sequence length, nodes, devices and step time."""
    gpus = F.col("num_nodes") * F.col("devices")
    per_batch = F.col("global_batch_size") * F.col("seq_length")
    hours = F.col("step_timings_mean") / per_batch * 1e12 / 3600
    return df.withColumns(
        {
            "tokens_per_batch": per_batch,
            "estimated_time": hours,
            "estimated_days": hours / 24,
            "estimated_gpu_hours": hours * gpus,
            "job_gpu_hours": F.col("total_time") * gpus / 3600,
        }
    )


def cost_rollup(df: DataFrame, by: str, amounts: list[str]) -> DataFrame:
    """Sums per job type and one ``TOTAL`` row."""
    rolled = df.rollup(by).agg(F.grouping(by).alias("_all"), *[F.sum(a).alias(a) for a in amounts])
    return rolled.select(F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col(by)).alias(by), *amounts)


def observed_counts(df: DataFrame, tests: dict[str, Column], name: str = "counts") -> tuple[DataFrame, Observation]:
    """Count rows by outcome while they pass, without a job of its own.

    Use a session apart from ML work: a session that has observed cannot ship ML
    transformers any more.
    """
    observation = Observation(name)
    counts = [F.count_if(test).alias(k) for k, test in tests.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *counts), observation
