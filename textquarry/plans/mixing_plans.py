"""Data-mix arithmetic over statistics of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.operators import mixing as X
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import squeeze

# Suppliers stand for data sets, quantities (in thousands) for token counts.
_STATS_SQL = """WITH stats AS (SELECT 'set' || l_suppkey AS name, (sum(l_quantity) * 1000)::BIGINT AS total_tokens FROM lineitem GROUP BY l_suppkey),
    repeats AS (SELECT 'set' || s_suppkey AS name, floor(s_acctbal / 2500) / 2 AS repeat FROM supplier),
    mix AS (SELECT name || '_text_document' AS name, floor(total_tokens * repeat / 4096)::BIGINT AS weight, total_tokens AS available, name AS plain FROM stats JOIN repeats USING (name)),
    kept AS (SELECT *, floor(sum(weight) OVER () / 1024)::BIGINT AS max_steps FROM mix WHERE weight > 0)"""


def dataset_stats(t):
    return t.lineitem.groupBy(F.concat(F.lit("set"), "l_suppkey").alias("name")).agg(
        (F.sum("l_quantity") * 1000).cast("bigint").alias("total_tokens")
    )


def dataset_repeats(t):
    return t.supplier.select(
        F.concat(F.lit("set"), "s_suppkey").alias("name"), (F.floor(F.col("s_acctbal") / 2500) / 2).alias("repeat")
    )


@query(
    "datamix", "A15",
    f"{_STATS_SQL} SELECT name, weight, max_steps, max_steps * 4096 * 1024 AS total_tokens FROM kept",
)
def datamix(t):
    return X.make_datamix(dataset_stats(t), dataset_repeats(t))


@query(
    "datamix_document", "A15",
    f"""{_STATS_SQL} SELECT 'tokens' AS data_path, max(max_steps * 4096 * 1024) AS total_tokens, count(*)::INT AS datasets,
        md5(string_agg(name || '=' || weight, ',' ORDER BY name)) AS digest FROM kept""",
)
def datamix_document(t):
    doc = X.datamix_document(X.make_datamix(dataset_stats(t), dataset_repeats(t)), "tokens")
    listed = F.transform("train", lambda e: F.concat(e["name"], F.lit("="), e["weight"].cast("string")))
    return doc.select("data_path", "total_tokens", F.size("train").alias("datasets"), F.md5(F.array_join(listed, ",")).alias("digest"))


@query(
    "ablation_mix", "A16 W15",
    f"""WITH c AS (SELECT lang, n_chars, count(*) OVER (PARTITION BY md5({squeeze('text')})) AS n FROM documents),
        s AS (SELECT lang, CASE WHEN n <= 4 THEN n::VARCHAR WHEN n < 100 THEN '5-100' WHEN n < 1000 THEN '100-1000' ELSE '1000+' END AS group_name, sum(n_chars)::BIGINT AS total_tokens FROM c GROUP BY ALL),
        u AS (SELECT *, CASE group_name WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 3 WHEN '5-100' THEN 5 WHEN '100-1000' THEN 8 ELSE 1 END::BIGINT AS rehydration,
              CASE lang WHEN 'en' THEN 0.5 WHEN 'es' THEN 0.0 ELSE 2.0 END::DOUBLE AS up FROM s),
        w AS (SELECT *, total_tokens * rehydration * up / sum(total_tokens * rehydration * up) OVER () AS weight FROM u)
        SELECT lang, group_name, rehydration, round(weight, 6) AS weight, round(weight * 2000000 / total_tokens, 4) AS epochs,
               weight * 2000000 / total_tokens > 1 AS over_one_epoch FROM w WHERE weight > 0""",
)
def ablation_mix(t):
    from textquarry.functions.labels import cluster_bucket
    from textquarry.operators.dedup import with_cluster_size

    sized = with_cluster_size(t.documents.select("doc_id", "lang", "text", "n_chars"), "n")
    group = F.regexp_replace(cluster_bucket(F.col("n")), "^cluster_size-", "")
    stats = sized.groupBy("lang", group.alias("group_name")).agg(F.sum("n_chars").alias("total_tokens"))
    up = F.when(F.col("lang") == "en", 0.5).when(F.col("lang") == "es", 0.0).otherwise(2.0)
    mix = X.make_ablation_mix(stats.withColumn("group_type", F.lit("cluster")), up, "2m")
    return mix.select(
        "lang", "group_name", "rehydration", F.round("weight", 6).alias("weight"), F.round("epochs", 4).alias("epochs"), "over_one_epoch"
    )


@query(
    "dataset_epochs", "A33",
    f"""{_STATS_SQL} SELECT plain AS name, available, round_even(weight::DOUBLE / sum(weight) OVER () * 500000000 / available, 2) AS epochs FROM kept""",
)
def dataset_epochs(t):
    mix = X.make_datamix(dataset_stats(t), dataset_repeats(t))
    return X.epochs(mix, dataset_stats(t), 500_000_000).select("name", "available", "epochs")


@query(
    "split_plan", "SP6",
    """WITH a AS (SELECT o_custkey AS name, (count(*) / 4.0)::DOUBLE AS repeat FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
            b AS (SELECT o_custkey AS name, (count(*) / 8.0)::DOUBLE AS repeat FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
            m AS (SELECT name, coalesce(a.repeat % 1, 0) AS modulo_phase1, coalesce(b.repeat % 1, 0) AS modulo_phase2 FROM a FULL JOIN b USING (name)),
            r AS (SELECT *, ((1 - modulo_phase1 - modulo_phase2) % 1 + 1) % 1 AS remainder FROM m)
       SELECT * FROM r WHERE modulo_phase1 > 0 OR modulo_phase2 > 0 OR remainder > 0""",
)
def split_plan(t):
    def phase(status, part):
        rows = t.orders.where(F.col("o_orderstatus") == status)
        return rows.groupBy(F.col("o_custkey").alias("name")).agg((F.count("*") / part).alias("repeat"))

    return X.split_plan(phase("F", 4), phase("O", 8))
