"""Scans. Schemas are declared, so a missing key is NULL and no file is read twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "id string, text string"
STATS = (
    "name string, total_tokens bigint, total_sequences bigint, min_tokens bigint, max_tokens bigint, "
    "mean_tokens double, Q1_tokens double, Q2_tokens double, Q3_tokens double, "
    "dataset string, subset string, language string"
)
REPEATS = "name string, repeat double"


def _keyed(df: DataFrame, text_key: str, id_key: str) -> DataFrame:
    return df.withColumnsRenamed({text_key: "text", id_key: "id"})


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    glob: str | None = None,
    text_key: str = "text",
    id_key: str = "id",
    mode: str = "PERMISSIVE",
    limit: int | None = None,
) -> DataFrame:
    """JSON lines below ``path`` (plain, ``.gz``, ``.zst`` and so on), with chosen text and id keys.

    Compressed files are decoded as streams.

    Put ``_corrupt_record string`` into the schema to keep lines that do not parse.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("mode", mode)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = _keyed(reader.json(path), text_key, id_key)
    return df.limit(limit) if limit else df


def corrupt_counts(df: DataFrame) -> DataFrame:
    """Parsable and broken lines of a scan that kept ``_corrupt_record``."""
    bad = F.col("_corrupt_record").isNotNull()
    return df.agg(F.count_if(~bad).alias("parsed"), F.count_if(bad).alias("corrupt"))


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    text_key: str = "text",
    id_key: str = "id",
    split: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    df = _keyed(spark.read.parquet(*paths), text_key, id_key)
    df = df.withColumn("split", F.lit(split)) if split else df
    return df.limit(limit) if limit else df


def spread(df: DataFrame) -> DataFrame:
    """On one machine, use every core for a scan that comes in fewer splits than cores.

    A test file with one row group is one split. A cluster reads many files: there a
    shuffle of the texts would cost more than it gives, and nothing is done.
    """
    context = df.sparkSession.sparkContext
    alone = context.master.startswith("local[") and df.rdd.getNumPartitions() < context.defaultParallelism
    return df.repartition(context.defaultParallelism) if alone else df


def read_json(
    spark: SparkSession, path: str, schema: str, text_key: str = "text", defaults: dict[str, str] | None = None
) -> DataFrame:
    """Whole-file JSON documents, with constant metadata added."""
    df = spark.read.schema(schema).option("multiLine", True).json(path).withColumnRenamed(text_key, "text")
    return df.withColumns({k: F.lit(v) for k, v in (defaults or {}).items()})


def read_stats_csv(spark: SparkSession, path: str, schema: str = STATS) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_markdown_table(spark: SparkSession, path: str, schema: list[tuple[str, str]]) -> DataFrame:
    """A pipe table: rule rows are dropped, backticks and thousands commas stripped, cells cast.

    The header row is recognized by its first cell, so no line order is needed.
    """
    cells = F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|")
    rows = (
        spark.read.text(path)
        .where(F.contains("value", F.lit("|")))
        .where(~F.col("value").rlike(r"^[\s|:-]+$"))
        .select(F.transform(cells, lambda c: F.regexp_replace(F.trim(c), "`", "")).alias("c"))
        .where(F.get("c", F.lit(0)) != schema[0][0])
    )
    out = []
    for i, (name, kind) in enumerate(schema):
        cell = F.get("c", F.lit(i))
        if kind != "string":
            cell = F.regexp_replace(cell, ",", "").try_cast(kind)
        out.append(cell.alias(name))
    return rows.select(*out)


def read_jsonl_comments(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines in which lines starting with ``//`` are comments."""
    return (
        spark.read.text(path)
        .where(~F.startswith(F.ltrim("value"), F.lit("//")) & (F.trim("value") != ""))
        .select(F.from_json("value", schema).alias("r"))
        .select("r.*")
    )


EVAL_FILE = "results map<string, map<string, double>>, config_general struct<max_samples: string>"


def read_eval_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Evaluation files to one row per task and metric, with the time from the file name."""
    files = (
        spark.read.schema(EVAL_FILE)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("path", F.col("_metadata.file_path"))
        .where(~F.contains("path", F.lit("deprecated")))
    )
    stamp = F.regexp_extract("path", r"results_(\d{4}-\d\d-\d\dT\d\d-\d\d-\d\d\.\d+)", 1)
    tasks = files.select("path", stamp.alias("stamp"), "config_general", F.explode("results").alias("task", "metrics"))
    return tasks.select(
        "path",
        F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd'T'HH-mm-ss.SSSSSS")).alias("timestamp"),
        F.coalesce("config_general.max_samples", F.lit("None")).alias("max_samples"),
        "task",
        F.explode("metrics").alias("metric", "score"),
    )


LOG_TIME = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
LOG_STEP = r"iteration (\d+)/\d+.*?train_step_timing in s: ([\d.]+)"


def parse_log_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Add the time, iteration and step time found in a log line (NULL where absent)."""
    def found(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))

    return df.withColumns(
        {
            "logged_at": F.try_to_timestamp(found(LOG_TIME, 1), F.lit("yyyy-MM-dd HH:mm:ss")),
            "iteration": found(LOG_STEP, 1).cast("bigint"),
            "step_seconds": found(LOG_STEP, 2).try_cast("double"),
        }
    )


def read_run_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Training logs, one row per line that carries a time or a step."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    located = lines.select("value", F.col("_metadata.file_path").alias("run"))
    return parse_log_lines(located).where("logged_at IS NOT NULL OR iteration IS NOT NULL").drop("value")


def path_part(path: Column, position: int) -> Column:
    """The path component at ``position``; negative counts from the end."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def with_path_parts(df: DataFrame, parts: dict[str, int], path: Column | None = None) -> DataFrame:
    """Columns taken from path components, of the row's own file by default."""
    where = F.col("_metadata.file_path") if path is None else path
    return df.withColumns({name: path_part(where, at) for name, at in parts.items()})


def filter_path_rlike(df: DataFrame, pattern: str, path: Column | None = None) -> DataFrame:
    return df.where((F.col("_metadata.file_path") if path is None else path).rlike(pattern))


def read_shuffled(
    spark: SparkSession, paths: list[str], key: str = "id", seed: int = 42
) -> DataFrame:
    """Several parquet files in one pseudo-random order.

    The order is a range-partitioned sort on a hash of the key: it is global, the
    same on every run, and needs no single-task step.
    """
    df = spark.read.parquet(*paths)
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def concat_sources(sources: dict[str, DataFrame], into: str = "dataset") -> DataFrame:
    """All sources under one another, each marked with its name; missing columns are NULL."""
    marked = [df.withColumn(into, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
