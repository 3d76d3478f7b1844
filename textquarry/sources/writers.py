"""Sinks. All of them write in parallel; none gathers rows on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.operators.filters import tag_rejects
from textquarry.operators.projections import PUBLISHED


def _gathered(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Bring the rows of an output folder together; adaptive execution splits large folders.

    A small folder gets one file and not one from every task. A large one is written
    by as many tasks as its bytes need.
    """
    return df.hint("rebalance", *columns) if columns else df


def write_jsonl(
    df: DataFrame, path: str, partition_cols: tuple[str, ...] = (), compression: str = "gzip"
) -> None:
    writer = _gathered(df, partition_cols).write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_cols) if partition_cols else writer).json(path)


def write_published(
    df: DataFrame, path: str, extra: tuple[str, ...] = (), max_records: int = 250_000
) -> None:
    """The canonical record as Parquet, one folder per language and extra value (such as a score)."""
    columns = ("language", *extra)
    out = df.select(*[c for c in PUBLISHED.fieldNames()], *extra)
    (
        _gathered(out, columns)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*columns)
        .parquet(path)
    )


def write_keep_reject(df: DataFrame, keep: Column, reason: Column | str, path: str) -> None:
    """Both sides of a filter from one pass: folders ``kept=true`` and ``kept=false``."""
    tagged = tag_rejects(df, keep, reason).withColumn("kept", F.col("drop_reason").isNull())
    tagged.write.mode("overwrite").partitionBy("kept").parquet(path)


def write_summary(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A report of a few rows as one file; the work before it stays parallel."""
    writer = df.repartition(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def write_tokens(df: DataFrame, path: str, tokens: str = "tokens") -> None:
    out = df.select("doc_id", tokens, F.size(tokens).alias("n_tokens"))
    out.write.mode("overwrite").parquet(path)


def write_by_bucket(df: DataFrame, path: str, columns: tuple[str, ...] = ("dataset", "length_bucket")) -> None:
    write_jsonl(df, path, columns)


def resume(df: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is not among the finished ones."""
    keys = [key] if isinstance(key, str) else key
    return df.join(done.select(*keys), keys, "left_anti")
