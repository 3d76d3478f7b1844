"""The processing of web documents as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.functions.labels import cluster_bucket
from textquarry.functions.pii import mask_phone, mask_pii
from textquarry.operators.decontamination import build_ngram_index, contaminated_ids
from textquarry.operators.dedup import with_cluster_size
from textquarry.operators.filters import tag_known_urls, tag_robots
from textquarry.session import written


def process_web(
    df: DataFrame, rules: DataFrame, benchmark: DataFrame, prefixes: list[str] | None = None,
    key: str = "doc_id", score: str = "score", min_score: float = 1.0, must_allow: bool = False,
) -> DataFrame:
    """Tag and mask web documents ``key, url, text, lang, score`` in nine steps.

    Cluster size, its bucket, known URLs, crawl rules, score, e-mail and address masks,
    phone masks, contamination, and the split by ``drop_reason``: the first step that
    rejects a row names the reason, NULL means kept. A missing score passes. Texts are
    masked before they are held against the benchmark.
    """
    sized = with_cluster_size(df, "minhash_cluster_size", key=key)
    sized = sized.withColumn("cluster_size_group", cluster_bucket(F.col("minhash_cluster_size")))
    known = tag_known_urls(sized, prefixes=prefixes).withColumnRenamed("drop_reason", "_known")
    ruled = tag_robots(known, rules, must_allow=must_allow).withColumnRenamed("drop_reason", "_robots")
    low = F.when(F.col(score) < min_score, F.lit("low_score"))
    scored = ruled.withColumn("drop_reason", F.coalesce("_known", "_robots", low)).drop("_known", "_robots")
    masked = written(mask_phone(mask_pii(scored)), "web-masked")
    open_rows = masked.where("drop_reason IS NULL")
    bad = contaminated_ids(open_rows, build_ngram_index(benchmark), key)
    found = masked.join(bad.withColumn("_bad", F.lit("contaminated")), key, "left")
    return found.withColumn("drop_reason", F.coalesce("drop_reason", "_bad")).drop("_bad")
