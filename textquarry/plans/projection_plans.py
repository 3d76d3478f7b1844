"""Canonical mapping, renames, names and report columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.labels import cluster_name_parts, name_parts
from textquarry.functions.text import camel_to_words, language_pair, slugify, strip_prefix
from textquarry.operators import projections as P
from textquarry.operators.filters import url_host
from textquarry.operators.reference_lists import language_map
from textquarry.plans.registry import query


@query(
    "published_record", "P1",
    """SELECT source, doc_id::VARCHAR AS id, lang AS language, md5(text) AS digest, (messages IS NULL) AS no_messages
       FROM (SELECT *, NULL AS messages FROM documents)""",
)
def published_record(t):
    out = P.to_published(t.documents, source_key="source", language_key="lang", id_key="doc_id")
    return out.select("source", "id", "language", F.md5("text").alias("digest"), F.col("messages").isNull().alias("no_messages"))


@query(
    "published_vectors", "P1",
    "SELECT 'vectors' AS source, md5(vec_id::VARCHAR) AS id, 'en' AS language, label::VARCHAR AS text, '{}' AS metadata FROM embeddings",
)
def published_vectors(t):
    df = t.embeddings.withColumn("text", F.col("label").cast("string"))
    out = P.to_published(df, source="vectors", language="en", id_key="vec_id", remove_keys=("embedding", "label"), reset_id=True)
    return out.drop("messages")


@query(
    "prefix_strip", "P2",
    "SELECT doc_id, md5(text) AS digest FROM documents",
)
def prefix_strip(t):
    prefixed = P.add_prefix(t.documents, [("Source", F.col("source")), ("Language", F.col("lang"))])
    return prefixed.select("doc_id", F.md5(strip_prefix(F.col("text"), F.col("prefix"))).alias("digest"))


@query(
    "rename_and_cast", "P3",
    "SELECT doc_id::VARCHAR AS id, lang AS language, 'docs/' || source AS source, n_chars::INT AS length FROM documents",
)
def rename_and_cast(t):
    return t.documents.withColumnsRenamed({"doc_id": "id", "lang": "language", "n_chars": "length"}).select(
        F.col("id").cast("string").alias("id"), "language", F.concat(F.lit("docs/"), "source").alias("source"),
        F.col("length").cast("int").alias("length"),
    )


@query("keep_columns", "P4", "SELECT doc_id, n_chars FROM documents")
def keep_columns(t):
    return t.documents.select("doc_id", "n_chars")


_ISO3 = ", ".join(f"('{a}', '{b}')" for a, b in language_map("iso1", "iso3").items())


@query(
    "map_language", "P5",
    f"""SELECT doc_id, coalesce(m.iso3, d.lang) AS iso3, r.iso1 AS back FROM documents d
        LEFT JOIN (VALUES {_ISO3}) m(iso1, iso3) ON m.iso1 = d.lang
        LEFT JOIN (VALUES {_ISO3}) r(iso1, iso3) ON r.iso3 = m.iso3""",
)
def map_language(t):
    coded = t.documents.withColumn("iso3", P.map_language(F.col("lang")))
    return coded.select("doc_id", "iso3", P.map_language(F.col("iso3"), "iso3", "iso1", fallback=False).alias("back"))


@query(
    "slugify", "P6",
    r"""SELECT doc_id, regexp_replace(regexp_replace(translate(lower(text),
              'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug
       FROM documents""",
)
def slugs(t):
    return t.documents.select("doc_id", slugify(F.col("text")).alias("slug"))


@query(
    "camel_case_words", "P6",
    r"""SELECT c_custkey, regexp_replace('Open' || c_name, '([a-z#0-9])([A-Z])', '\1 \2', 'g') AS words FROM customer""",
)
def camel_case_words(t):
    return t.customer.select("c_custkey", camel_to_words(F.concat(F.lit("Open"), "c_name")).alias("words"))


@query(
    "language_pairs", "P7",
    r"""WITH p AS (SELECT doc_id, lang AS a, CASE WHEN contains(source, '1') THEN 'en' ELSE 'it' END AS b FROM documents)
       SELECT doc_id, CASE WHEN b = 'en' THEN 'en-' || a ELSE a || '-' || b END AS pair FROM p""",
)
def language_pairs(t):
    other = F.when(F.contains("source", F.lit("1")), F.lit("en")).otherwise("it")
    name = F.concat(F.lit("europarl_"), "lang", F.lit("-"), other, F.lit("_v8"))
    return t.documents.select("doc_id", language_pair(name).alias("pair"))


@query(
    "drop_constant_columns", "P8",
    "SELECT l_orderkey, l_linenumber, l_quantity, 'kept' AS arch FROM lineitem",
)
def drop_constant_columns(t):
    runs = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.lit("x").alias("version"), F.lit("kept").alias("arch"),
        F.when(F.col("l_orderkey") < 0, 1).alias("always_null"),
    )
    return P.drop_constant_columns(runs, keep=("arch",))


@query(
    "flatten_config", "P9",
    """SELECT o_orderkey AS seed, o_totalprice AS lr, o_orderstatus AS arch, o_orderpriority AS name FROM orders""",
)
def flatten_config(t):
    nested = t.orders.select(
        F.col("o_orderkey").alias("seed"),
        F.struct(F.struct(F.col("o_totalprice").alias("lr")).alias("optim"), F.col("o_orderpriority").alias("name")).alias("trainer"),
        F.struct(F.col("o_orderstatus").alias("arch")).alias("args"),
    )
    return P.short_names(P.flatten(nested))


@query(
    "dataset_name_parts", "P10",
    """SELECT doc_id, source AS dataset, CASE WHEN n_chars > 1000 THEN 'long' END AS subset, lang AS language FROM documents""",
)
def dataset_name_parts(t):
    name = F.concat_ws("_", "source", F.when(F.col("n_chars") > 1000, "long"), "lang")
    return t.documents.select("doc_id", name_parts(name).alias("p")).select("doc_id", "p.*")


@query(
    "cluster_name_parts", "P11",
    """SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'fineweb2_' || lang || '_cluster' ELSE source END AS dataset,
              CASE WHEN n_chars > 1000 THEN 'cluster' END AS group_type,
              CASE WHEN n_chars > 1000 THEN '5-100' END AS group_name FROM documents""",
)
def cluster_names(t):
    name = F.when(F.col("n_chars") > 1000, F.concat(F.lit("fineweb2_"), "lang", F.lit("_cluster_5-100"))).otherwise(F.col("source"))
    return t.documents.select("doc_id", cluster_name_parts(name).alias("p")).select("doc_id", "p.*")


@query(
    "dataset_catalog", "P12 O3",
    r"""WITH f AS (SELECT replace(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '.', '-') || '/' || split_part(url, '/', 4) AS folder FROM pages),
            p AS (SELECT folder, string_split_regex(split_part(folder, '/', 1), '[_-]+') AS parts FROM f)
       SELECT list_aggregate(list_transform(parts, lambda x: CASE WHEN lower(x) IN ('hq','insee','hal','hplt2') THEN upper(x)
                ELSE upper(x[1]) || lower(x[2:]) END), 'string_agg', '') || '-' || split_part(folder, '/', 2) AS name,
              'data/' || folder || '/**/*.parquet' AS glob, count(*)::BIGINT AS files
       FROM p GROUP BY ALL""",
)
def dataset_catalog(t):
    host = F.translate(url_host(F.col("url")), ".", "-")
    path = F.concat_ws("/", F.lit("data"), host, F.get(F.split("url", "/"), F.lit(3)), F.lit("part.parquet"))
    catalog = P.build_catalog(t.pages.select(path.alias("path")), depth=2)
    return catalog.orderBy(*P.plain_first("name"))
