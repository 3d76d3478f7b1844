"""The query registry: name -> Spark callable, optional SQL twin, inventory ids."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from textquarry.sources.readers import spread

# Tables whose rows take long to work on.
TEXT_TABLES = {"documents", "pages", "conversations"}

PLAN_MODULES = [
    "source_plans",
    "sink_plans",
    "projection_plans",
    "filter_plans",
    "text_plans",
    "join_plans",
    "stats_plans",
    "mixing_plans",
    "evaluation_plans",
    "window_plans",
    "sampling_plans",
    "dedup_plans",
    "dialogue_plans",
    "rag_plans",
    "quality_plans",
    "packing_plans",
    "streaming_plans",
    "web_plans",
]


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


class Tables:
    """The given parquet tables of one scale folder, as DataFrames by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return spread(df) if table in TEXT_TABLES else df


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        _QUERIES[name] = Query(name, tuple(ids.split()), run, sql)
        return fn

    return wrap


def all_queries() -> dict[str, Query]:
    for module in PLAN_MODULES:
        importlib.import_module(f"textquarry.plans.{module}")
    return _QUERIES
