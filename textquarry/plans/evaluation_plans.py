"""Result tables derived from line items, and run logs derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.operators import evaluation as X
from textquarry.operators import runs as R
from textquarry.plans.registry import query

# Line numbers are experiments, shipping years checkpoints, return flags tasks, line status the metric.
_SCORES_SQL = """SELECT 'expe' || l_linenumber AS expe_name, (year(l_shipdate) - 1990)::DOUBLE AS tokens, 'suite|' || l_returnflag || '|5' AS task,
    l_linestatus AS metric, sum(round(l_discount * 100)::BIGINT)::BIGINT * 8 / (100.0::DOUBLE * count(*)) AS score FROM lineitem GROUP BY ALL"""
_INFO_SQL = """SELECT DISTINCT 'suite|' || l_returnflag AS task, l_linestatus AS metric, CASE WHEN l_returnflag = 'A' THEN 'Reading' ELSE 'Reasoning' END AS task_type,
    CASE WHEN l_linestatus = 'O' THEN 'fr' ELSE 'en' END AS language, CASE WHEN l_returnflag = 'R' THEN NULL ELSE 4 END AS num_classes FROM lineitem
    WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'F')"""
_NORM = "CASE WHEN s.score < coalesce(1.0 / i.num_classes, 0) THEN 0 ELSE (s.score - coalesce(1.0 / i.num_classes, 0)) / (1 - coalesce(1.0 / i.num_classes, 0)) * 100 END"


def scores(t):
    return t.lineitem.groupBy(
        F.concat(F.lit("expe"), "l_linenumber").alias("expe_name"),
        (F.year("l_shipdate") - 1990).cast("double").alias("tokens"),
        F.concat(F.lit("suite|"), "l_returnflag", F.lit("|5")).alias("task"),
        F.col("l_linestatus").alias("metric"),
    ).agg((F.sum(F.round(F.col("l_discount") * 100).cast("bigint")) * 8 / (F.lit(100.0) * F.count("*"))).alias("score"))


def task_info(t):
    return t.lineitem.where("NOT (l_returnflag = 'A' AND l_linestatus = 'F')").select(
        F.concat(F.lit("suite|"), "l_returnflag").alias("task"), F.col("l_linestatus").alias("metric"),
        F.when(F.col("l_returnflag") == "A", "Reading").otherwise("Reasoning").alias("task_type"),
        F.when(F.col("l_linestatus") == "O", "fr").otherwise("en").alias("language"),
        F.when(F.col("l_returnflag") != "R", 4).alias("num_classes"),
    ).distinct()


@query(
    "agg_score", "A17",
    f"""WITH s AS ({_SCORES_SQL}), i AS ({_INFO_SQL}),
        p AS (SELECT expe_name, tokens, language, task_type, avg({_NORM}) AS score FROM s JOIN i ON regexp_replace(s.task, '\\|[^|]*$', '') = i.task AND s.metric = i.metric GROUP BY ALL)
        SELECT expe_name, tokens, task_type || ' (' || language || ')' AS task, 'agg' AS metric, round(score, 4) AS score FROM p
        UNION ALL SELECT expe_name, tokens, 'All together (' || language || ')', 'agg', CASE WHEN count(*) > 1 THEN round(avg(score), 4) END FROM p GROUP BY expe_name, tokens, language""",
)
def agg_score(t):
    return X.agg_score(scores(t), task_info(t)).withColumn("score", F.round("score", 4))


@query(
    "avg_curve", "A18",
    f"""WITH s0 AS ({_SCORES_SQL}), s AS (SELECT * FROM s0 WHERE NOT (expe_name = 'expe3' AND task = 'suite|R|5')), i AS ({_INFO_SQL}),
        pairs AS (SELECT DISTINCT task, metric FROM s0 WHERE regexp_replace(task, '\\|[^|]*$', '') || metric IN (SELECT task || metric FROM i)),
        w AS (SELECT s.* FROM s JOIN pairs USING (task, metric)),
        good AS (SELECT expe_name FROM (SELECT DISTINCT expe_name, task, metric FROM w) GROUP BY expe_name HAVING count(*) = (SELECT count(*) FROM pairs))
        SELECT expe_name, tokens, round(avg({_NORM}), 4) AS score, count(*)::BIGINT AS n FROM w s JOIN i ON regexp_replace(s.task, '\\|[^|]*$', '') = i.task AND s.metric = i.metric
        WHERE expe_name IN (SELECT expe_name FROM good) GROUP BY expe_name, tokens""",
)
def avg_curve(t):
    all_scores, info = scores(t), task_info(t)
    partial = all_scores.where("NOT (expe_name = 'expe3' AND task = 'suite|R|5')")
    required = info.select(F.concat("task", F.lit("|5")).alias("task"), "metric")
    return X.avg_curve(partial, required, info).withColumn("score", F.round("score", 4))


@query(
    "fit_curves", "A19",
    f"""WITH s AS ({_SCORES_SQL}), f AS (SELECT expe_name, task, metric, count(*)::BIGINT AS n, regr_slope(score, ln(tokens)) AS slope,
            regr_intercept(score, ln(tokens)) AS intercept, regr_r2(score, ln(tokens)) AS r2 FROM s WHERE tokens > 0 GROUP BY ALL)
        SELECT expe_name, task, metric, n, CASE WHEN n > 1 THEN round(slope, 6) END AS slope, CASE WHEN n > 1 THEN round(intercept, 6) END AS intercept, CASE WHEN n > 1 THEN round(r2, 6) END AS r2 FROM f""",
)
def fit_curves(t):
    out = X.fit_curves(scores(t), ["expe_name", "task", "metric"])
    return out.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r2")})


def event_logs(t):
    return t.events.select(
        F.col("event_type").alias("run"), F.col("event_id").alias("iteration"), F.col("value").alias("step_seconds"), F.col("ts").alias("logged_at")
    )


_STEPS_SQL = """WITH n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY event_type) AS c FROM events),
    st AS (SELECT event_type AS run, min(event_id) AS min_iteration, max(event_id) AS max_iteration, avg(CASE WHEN rn > 5 OR c <= 5 THEN value END) AS m,
           stddev_pop(CASE WHEN rn > 5 OR c <= 5 THEN value END) AS sd, sum(value) AS total, min(ts) AS t0 FROM n GROUP BY event_type)"""


@query(
    "step_stats", "A20 W13",
    f"""{_STEPS_SQL} SELECT run, min_iteration, max_iteration, round(m, 6) AS step_timings_mean, round(sd, 6) AS step_timings_std, round(total, 4) AS total_time, t0::VARCHAR AS start_time FROM st""",
)
def step_stats(t):
    out = R.step_stats(event_logs(t), rows_per_range=50_000)
    return out.select(
        "run", "min_iteration", "max_iteration", F.round("step_timings_mean", 6).alias("step_timings_mean"),
        F.round("step_timings_std", 6).alias("step_timings_std"), F.round("total_time", 4).alias("total_time"),
        F.col("start_time").cast("string").alias("start_time"),
    )


@query(
    "run_cost", "A21",
    f"""{_STEPS_SQL} SELECT run, 2048 * 512 AS tokens_per_batch, round(m / (2048 * 512) * 1e12 / 3600, 3) AS estimated_time,
        round(m / (2048 * 512) * 1e12 / 3600 * 8, 3) AS estimated_gpu_hours, round(total * 8 / 3600, 5) AS job_gpu_hours FROM st""",
)
def run_cost(t):
    configured = R.step_stats(event_logs(t)).select(
        "*", F.lit(512).alias("global_batch_size"), F.lit(2048).alias("seq_length"), F.lit(2).alias("num_nodes"), F.lit(4).alias("devices")
    )
    return R.run_cost(configured).select(
        "run", "tokens_per_batch", F.round("estimated_time", 3).alias("estimated_time"),
        F.round("estimated_gpu_hours", 3).alias("estimated_gpu_hours"), F.round("job_gpu_hours", 5).alias("job_gpu_hours"),
    )


@query(
    "cost_rollup", "A22",
    """SELECT CASE WHEN grouping(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS job_type, round(sum(value), 3) AS walltime_h, count(*)::BIGINT AS jobs
       FROM events GROUP BY ROLLUP (event_type)""",
)
def cost_rollup(t):
    jobs = t.events.select(F.col("event_type").alias("job_type"), F.col("value").alias("walltime_h"), F.lit(1).cast("bigint").alias("jobs"))
    return R.cost_rollup(jobs, "job_type", ["walltime_h", "jobs"]).withColumn("walltime_h", F.round("walltime_h", 3))


@query(
    "context_length_report", "A27",
    """WITH r AS (SELECT 'expe' || l_linenumber AS expe_name, CASE l_returnflag WHEN 'A' THEN 'average' ELSE 'qa_' || l_returnflag END AS subtask,
              CASE WHEN l_linestatus = 'O' THEN 4096 ELSE 8192 END AS len, l_discount FROM lineitem)
       SELECT expe_name, subtask, round(avg(CASE WHEN len = 4096 THEN l_discount END), 6) AS "4096", round(avg(CASE WHEN len = 8192 THEN l_discount END), 6) AS "8192" FROM r GROUP BY ALL""",
)
def context_length_report(t):
    length = F.when(F.col("l_linestatus") == "O", "4096").otherwise("8192")
    subtask = F.when(F.col("l_returnflag") == "A", "_average").otherwise(F.concat(F.lit("qa_"), "l_returnflag"))
    results = t.lineitem.select(
        F.concat(F.lit("expe"), "l_linenumber").alias("expe_name"),
        F.concat(F.lit("custom|ruler_"), length, F.lit(":"), subtask, F.lit("|0")).alias("task"), F.col("l_discount").alias("score"),
    )
    out = X.by_context_length(results, [4096, 8192])
    return out.select("expe_name", "subtask", F.round("4096", 6).alias("4096"), F.round("8192", 6).alias("8192"))


@query(
    "pivot_stderr", "A31",
    """SELECT l_returnflag AS task, CASE WHEN l_linestatus = 'O' THEN 'comet' ELSE 'acc' END AS metric,
              round(avg(l_tax) / CASE WHEN l_linestatus = 'O' THEN 100 ELSE 1 END, 8) AS score, round(stddev_pop(l_tax) / CASE WHEN l_linestatus = 'O' THEN 100 ELSE 1 END, 8) AS stderr
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def pivot_stderr(t):
    metric = F.when(F.col("l_linestatus") == "O", "comet").otherwise("acc")
    stats = t.lineitem.groupBy(F.col("l_returnflag").alias("task"), metric.alias("m")).agg(
        F.avg("l_tax").alias("a"), F.stddev_pop("l_tax").alias("s")
    )
    pairs = F.array(
        F.struct(F.col("m").alias("metric"), F.col("a").alias("score")),
        F.struct(F.concat("m", F.lit("_stderr")).alias("metric"), F.col("s").alias("score")),
    )
    long = stats.select("task", F.explode(pairs).alias("p")).select("task", "p.metric", "p.score")
    wide = X.pivot_stderr(X.rescale_percent_metrics(long), ["task"])
    return wide.select("task", "metric", F.round("score", 8).alias("score"), F.round("stderr", 8).alias("stderr"))


@query(
    "checkpoint_tokens", "A32",
    """WITH c AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderkey + 715787 + 715787 + 358930 WHEN 'O' THEN o_orderkey + 715787 + 358930 + 71526 ELSE o_orderkey END AS steps,
              CASE o_orderstatus WHEN 'F' THEN 8.075686912 WHEN 'O' THEN 23.216467968 ELSE 1.319309312 END::DOUBLE AS model_size FROM orders)
       SELECT o_orderkey, model_size, round(steps * 4096 * 1024 / 1e9::DOUBLE, 4) AS tokens, round(model_size * (steps * 4096 * 1024 / 1e9::DOUBLE) * 6, 2) AS eflops FROM c""",
)
def checkpoint_tokens(t):
    path = F.concat(
        F.when(F.col("o_orderstatus") == "F", "8b/phase2/step=").when(F.col("o_orderstatus") == "O", "23b_32k_x/step=").otherwise("1b/totalstep="),
        "o_orderkey",
    )
    out = X.checkpoint_tokens(t.orders.select("o_orderkey", path.alias("path")))
    return out.select("o_orderkey", "model_size", F.round("tokens", 4).alias("tokens"), F.round(F.col("FLOPs") / 1e18, 2).alias("eflops"))
