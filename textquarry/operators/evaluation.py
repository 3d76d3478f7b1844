"""Benchmark results: reshaping, normalization, aggregation and curve fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.labels import step_number
from textquarry.operators.filters import keep_complete
from textquarry.operators.joins import join_task_info


def rescale_percent_metrics(df: DataFrame) -> DataFrame:
    """``comet`` scores are percentages; bring them to 0..1."""
    scaled = F.when(F.col("metric").isin("comet", "comet_stderr"), F.col("score") / 100).otherwise(F.col("score"))
    return df.withColumn("score", scaled)


def pivot_stderr(df: DataFrame, keys: list[str]) -> DataFrame:
    """``metric`` and ``metric_stderr`` rows to one row with ``score`` and ``stderr``."""
    is_error = F.col("metric").endswith("_stderr")
    base = df.withColumns({"_error": is_error, "metric": F.regexp_replace("metric", "_stderr$", "")})
    wide = base.groupBy(*keys, "metric").pivot("_error", [False, True]).agg(F.min("score"))
    return wide.withColumnsRenamed({"false": "score", "true": "stderr"})


# Training steps per phase (small models, models from 23 B), and tokens per step.
PHASE_STEPS = {"phase1": 715_787, "phase2": 358_930}
ANNEALING_STEPS = (118_238, 71_526)
EXTENSION_STEPS = (5_960, 11_920)
TOKENS_PER_STEP = 4096 * 1024

# Parameters in billions, by a mark in the checkpoint path.
MODEL_SIZES = [("llama1b", 1.235290112), ("1b", 1.319309312), ("8b", 8.075686912), ("23b", 23.216467968)]


# Families of published models, in the order they are looked for: a mark in the path,
# parameters in billions (None: the number that follows the mark), training tokens in billions where
# the path does not tell (None: unknown), the pattern of what it tells, and billions of tokens a unit.
EXTERNAL_MODELS = [
    ("OLMo-2-0425-1B", 1.279395840, None, "-tokens([0-9.]+)B", 1.0),
    ("OLMo-2-1124-7B", 7.0, None, "-tokens([0-9.]+)B", 1.0),
    ("OLMo-2-1124-13B", 13.0, None, "-tokens([0-9.]+)B", 1.0),
    ("OLMo-2-0325-32B", 32.234279936, None, "-tokens([0-9.]+)B", 1.0),
    ("Apertus-8B", 8.0, 15000.0, "-tokens([0-9.]+)B", 1.0),
    ("EuroLLM-1.7B", 1.394706432, 4000.0, None, 1.0),
    ("EuroLLM-9B", 9.0, 4000.0, None, 1.0),
    ("EuroLLM-22B", 22.0, 4000.0, None, 1.0),
    ("salamandra-2b", 2.0, 12875.0, None, 1.0),
    ("salamandra-7b", 7.768117248, 12875.0, None, 1.0),
    ("Teuken-7B", 7.0, 6000.0, None, 1.0),
    ("SmolLM2-1.7B", 1.711376384, 11000.0, "step-([0-9.]+)", 0.002),
    ("SmolLM3-3B", 3.075098624, 11200.0, None, 1.0),
    ("Llama-2-7b", 6.9, 2000.0, None, 1.0),
    ("Llama-3.2-1B", 1.23, 9000.0, None, 1.0),
    ("Llama-3.1-8B", 8.0, 15000.0, None, 1.0),
    ("Mistral-7B", 7.0, 8000.0, None, 1.0),
    ("Ministral-3-", None, 8000.0, None, 1.0),
    ("Qwen3-", None, 36000.0, None, 1.0),
    ("Qwen2.5-", None, 18000.0, None, 1.0),
    ("Qwen2-", None, 7000.0, None, 1.0),
]


def external_model(path: Column, families: list[tuple] | None = None) -> Column:
    """``struct<model_size, tokens>`` of a published model's path, in billions; NULL for any other path.

    ``families`` are rows like those of ``EXTERNAL_MODELS``; the first whose mark the path holds decides.
    """
    found = F.lit(None)
    for mark, size, tokens, pattern, unit in reversed(EXTERNAL_MODELS if families is None else families):
        named = F.regexp_extract(path, mark.replace(".", r"\.") + "([0-9]+(?:\\.[0-9]+)?)B", 1)
        parameters = F.nullif(named, F.lit("")).cast("double") if size is None else F.lit(size)
        known = F.lit(tokens).cast("double")
        if pattern:
            # A last point belongs to the file's name.
            told = F.nullif(F.regexp_replace(F.regexp_extract(path, pattern, 1), r"\.$", ""), F.lit(""))
            known = F.coalesce(told.try_cast("double") * unit, known)
        row = F.struct(parameters.alias("model_size"), known.alias("tokens"))
        found = F.when(F.contains(path, F.lit(mark)), row).otherwise(found)
    return found


def model_size(path: Column) -> Column:
    """Parameters in billions of an own checkpoint or a published model; other paths are an error."""
    out = F.raise_error(F.concat(F.lit("unknown model size: "), path)).cast("double")
    for mark, size in reversed(MODEL_SIZES):
        out = F.when(F.contains(F.lower(path), F.lit(mark)), F.lit(size)).otherwise(out)
    return F.coalesce(external_model(path)["model_size"], out)


def checkpoint_tokens(df: DataFrame, path: str = "path") -> DataFrame:
    """Billions of training tokens seen by a checkpoint, model size and training FLOPs.

    A step count that is not global starts at the sum of the earlier phases. Published models
    have the tokens of ``EXTERNAL_MODELS``, NULL where these are unknown.
    """
    p = F.col(path)
    two = sum(PHASE_STEPS.values())
    big = F.col("model_size") >= 23
    annealed = two + F.when(big, ANNEALING_STEPS[1]).otherwise(ANNEALING_STEPS[0])
    extended = annealed + F.when(big, EXTENSION_STEPS[1]).otherwise(EXTENSION_STEPS[0])

    def has(mark: str) -> Column:
        return F.contains(p, F.lit(mark))

    context = F.when(has("_32k_") | has("_131k_v4_"), annealed).when(has("_65k_") | has("_131k_"), extended).otherwise(two)
    before = F.when(has("phase2"), PHASE_STEPS["phase1"]).otherwise(0) + context
    external = external_model(p)
    # A published model's path needs no step.
    step = step_number(F.when(external.isNull(), p).otherwise("step0"))
    steps = step["step"] + F.when(step["is_global"], 0).otherwise(before)
    tokens = F.when(external.isNull(), steps * TOKENS_PER_STEP / F.lit(1e9)).otherwise(external["tokens"])
    out = df.withColumn("model_size", model_size(p)).withColumn("tokens", tokens)
    return out.withColumn("FLOPs", F.col("model_size") * F.col("tokens") * 6 * 1e18)


def normalized(score: Column, random: Column) -> Column:
    """Score above the random baseline, in percent; below it 0. Scores outside the bounds are an error."""
    inside = (random < 1) & (score <= 1) & (score >= F.least(F.lit(0.0), random))
    message = F.concat(F.lit("score out of bounds: "), score.cast("string"))
    return (
        F.when(~inside, F.raise_error(message).cast("double"))
        .when(score < random, 0.0)
        .otherwise((score - random) / (1 - random) * 100)
    )


def agg_score(scores: DataFrame, info: DataFrame, by: tuple[str, ...] = ("expe_name", "tokens")) -> DataFrame:
    """Mean normalized score per language and task type, and per language over its types.

    A language with a single type has no overall score. Both levels come from one
    pass with grouping sets over the small first level.
    """
    random = F.coalesce(1.0 / F.col("num_classes"), F.lit(0.0))
    joined = join_task_info(scores.dropna(subset=["score"]), info)
    per_type = joined.groupBy(*by, "language", "task_type").agg(F.avg(normalized(F.col("score"), random)).alias("score"))
    keys = [*by, "language", "task_type"]
    sets = [[F.col(k) for k in keys], [F.col(k) for k in keys[:-1]]]
    both = per_type.groupingSets(sets, *keys).agg(
        F.grouping("task_type").alias("_overall"), F.avg("score").alias("score"), F.count("*").alias("_types")
    )
    overall = F.col("_overall") == 1
    task = F.concat(F.when(overall, "All together").otherwise(F.col("task_type")), F.lit(" ("), F.col("language"), F.lit(")"))
    score = F.when(~overall | (F.col("_types") > 1), F.col("score"))
    return both.select(*by, task.alias("task"), F.lit("agg").alias("metric"), score.alias("score"))


# Metrics that are not on a 0..1 scale.
UNBOUNDED_METRICS = ["bleu", "bleu_4", "metricx"]


def avg_curve(scores: DataFrame, required: DataFrame, info: DataFrame) -> DataFrame:
    """Mean normalized score per experiment and checkpoint, over experiments that have every task."""
    pairs = required.where(~F.col("metric").isin(*UNBOUNDED_METRICS)).select("task", "metric").distinct()
    wanted = scores.join(pairs, ["task", "metric"], "left_semi")
    complete = keep_complete(wanted, pairs, "expe_name")
    random = F.coalesce(1.0 / F.col("num_classes"), F.lit(0.0))
    joined = join_task_info(complete, info)
    return joined.groupBy("expe_name", "tokens").agg(
        F.avg(normalized(F.col("score"), random)).alias("score"), F.count("*").alias("n")
    )


def fit_curves(df: DataFrame, by: list[str], x: str = "tokens", y: str = "score") -> DataFrame:
    """Least-squares fit of the score on ln(tokens); with fewer than two points all NULL."""
    lnx, usable = F.log(F.col(x)), df.where(F.col(x) > 0)
    enough = F.col("n") > 1
    fitted = usable.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.regr_slope(F.col(y), lnx).alias("slope"),
        F.regr_intercept(F.col(y), lnx).alias("intercept"),
        F.regr_r2(F.col(y), lnx).alias("r2"),
    )
    return fitted.withColumns({c: F.when(enough, F.col(c)) for c in ("slope", "intercept", "r2")})


def by_context_length(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Long-context scores, one column per context length, from tasks like ``custom|ruler_4096:qa|0``."""
    pattern = r"ruler_(\d+):([^|]+)"
    parsed = df.withColumns(
        {
            "context_length": F.regexp_extract("task", pattern, 1).try_cast("int"),
            "subtask": F.regexp_replace(F.regexp_extract("task", pattern, 2), "^_average$", "average"),
        }
    ).where("context_length IS NOT NULL")
    return parsed.groupBy("expe_name", "subtask").pivot("context_length", lengths).agg(F.avg("score"))
