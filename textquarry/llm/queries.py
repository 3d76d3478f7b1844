"""One query per operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm.licenses import LEAST, LEAST_WIDTH, PHRASES, TEMPLATES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.sharding import assign_shards

    return assign_shards(_table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.simhash import simhash_groups

    return simhash_groups(_table(spark, folder, "documents"))


@_query
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.secrets import find_secrets

    return find_secrets(_table(spark, folder, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


@_query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.language_id import identify

    return identify(_table(spark, folder, "documents"))


@_query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.packing import pack_documents

    return pack_documents(_table(spark, folder, "documents"))


@_query
def op3_outliers(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.outliers import judge_quality

    return judge_quality(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "d2",
    )


@_query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.toxicity import rate_toxicity

    return rate_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.repeats import remove_repeats

    return remove_repeats(_table(spark, folder, "documents")).withColumnRenamed("kept", "kept_sha256")


@_query
def op5_contamination(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.contamination import find_leaks

    return find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.html_paths import extract_pages

    return extract_pages(_table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@_query
def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.common import id_crc, text_of
    from textquarry.llm.periodic_runs import find_runs, loop_tail

    docs = _table(spark, folder, "documents")
    looped = docs.select("doc_id", loop_tail(text_of("text"), id_crc("doc_id")).alias("text"))
    listed = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.col("strongest")
    return find_runs(looped).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", listed), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query
def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm import conversation_repair as repair
    from textquarry.llm.common import materialize

    original = _table(spark, folder, "conversations")
    damaged = repair.damage(original)
    audits = materialize(repair.audit_conversations(damaged), "audits")
    digests = repair.digest_conversations(repair.repair_conversations(damaged, audits))
    ids = original.groupBy("conv_id").agg(F.count("*").alias("_rows"))
    found = [
        df.select(F.col("conv_id").alias(f"_{k}"), F.lit(True).alias(f"_in{k}"), *[c for c in df.columns if c != "conv_id"])
        for k, df in enumerate((audits, digests))
    ]
    joined = ids
    for k, df in enumerate(found):
        joined = joined.join(df, joined["conv_id"].eqNullSafe(df[f"_{k}"]), "left")
    nothing = F.sha2(F.lit(""), 256)
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


@_query
def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    from textquarry.llm.licenses import scan_licenses

    starts = F.col("places.word")
    return scan_licenses(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text that isn't empty, in DuckDB's SQL."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    bits = "list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, b: {bits}), 4294967295)"


SQL["op10_repeats"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
     windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS g
                 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)),
     later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
     gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) t(k)),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


# Equal words at a distance q, in unbroken stretches, are runs of period q unless a smaller period covers them.
SQL["op11_runs"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
     g AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
     a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM g),
     p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
     words AS (SELECT doc_id, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
               FROM (SELECT *, unnest(range(n)) AS i FROM p)),
     n AS (SELECT doc_id, n FROM p),
     same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
              JOIN n ON n.doc_id = x.doc_id WHERE (y.i - x.i) * 4 <= n.n),
     stretches AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k, i FROM same),
     long AS (SELECT doc_id, min(i) AS s, count(*) + q AS l, q FROM stretches GROUP BY doc_id, q, k
              HAVING count(*) + q >= greatest(6, 4 * q)),
     runs AS (SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long o WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.l >= r.s + r.l)),
     listed AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS text FROM runs GROUP BY doc_id),
     best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l::DOUBLE / q DESC, s, q) = 1),
     gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(listed.n, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
       (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM n LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# Left to right instead of by spans: the least (cost, audit) of each state after each turn.
SQL["op12_conversations"] = rf"""
WITH RECURSIVE
     moves(role, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
     inserts(p, q, c, a, lines) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']),
         (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])),
     crc AS (SELECT *, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
     damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                        CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
                        unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM crc WHERE k <> 0),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS r FROM damaged),
     judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                               WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                               WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
                       lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM placed),
     counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                       count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                       count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
     best(conv_id, i, q, c, a, lines) AS (
         SELECT conv_id, 0::BIGINT, q, c, a, lines FROM (SELECT DISTINCT conv_id FROM judged), inserts WHERE p = 0
         UNION ALL
         SELECT conv_id, i, q, c, a, lines FROM (
             SELECT b.conv_id, j.i, e.q, b.c + m.c + e.c AS c, b.a || m.a || e.a AS a, b.lines || m.lines || e.lines AS lines
             FROM best b JOIN judged j ON j.conv_id = b.conv_id AND j.i = b.i + 1,
                  LATERAL (SELECT b.q, 4 AS c, 'D' AS a, []::VARCHAR[] AS lines
                           UNION ALL
                           SELECT v.q, CASE WHEN j.fault = 3 THEN 3 ELSE 0 END, 'K', [j.role || ':' || j.text] FROM moves v
                           WHERE v.p = b.q AND v.role = j.r AND j.fault IN (0, 3)
                           UNION ALL
                           SELECT v.q, CASE WHEN j.fault = 3 THEN 6 ELSE 3 END, 'R', [CASE v.q WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || j.text]
                           FROM moves v WHERE v.p = b.q AND v.role <> 's' AND j.fault IN (0, 3)) m(q, c, a, lines)
             JOIN inserts e ON e.p = m.q)
         QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY c, a) = 1),
     ended AS (SELECT b.* FROM best b JOIN counts n ON n.conv_id = b.conv_id AND n.n = b.i WHERE q IN (0, 3)
               QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY c, a) = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c, 0)::BIGINT AS cost,
       coalesce(a, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts n ON n.conv_id = o.conv_id LEFT JOIN ended e ON e.conv_id = o.conv_id"""

_LICENSE_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Every block against every template.
SQL["op13_licenses"] = f"""
WITH t(template, label, w) AS (SELECT k, label, {_LICENSE_WORDS.format("x")} FROM (VALUES {", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(TEMPLATES))}) v(k, label, x)),
     templates AS (SELECT template, label, list_distinct(w) AS words, greatest({LEAST_WIDTH}, (2 ** ceil(log2(len(w))))::BIGINT) AS width,
                          ceil({LEAST} * len(list_distinct(w)) - 1e-9) AS alpha FROM t),
     d AS (SELECT doc_id, {_LICENSE_WORDS.format("coalesce(text, '')")} AS w FROM documents),
     phrases(label, p) AS (VALUES {", ".join(f"('{label}', {text.split()})" for label, text in PHRASES)}),
     places AS (SELECT doc_id, label, i FROM (SELECT *, unnest(range(len(w))) AS i FROM d), phrases WHERE w[i + 1:i + len(p)] = p),
     base AS (SELECT doc_id, count(*) AS n, min(i) AS f, max(i) AS l FROM places GROUP BY doc_id),
     blocks AS (SELECT doc_id, width, w[block * width + 1:(block + 2) * width] AS b
                FROM (SELECT doc_id, w, width, unnest(range(greatest(1, ceil(len(w) / width)::BIGINT - 1))) AS block FROM d, (SELECT DISTINCT width FROM templates))),
     pairs AS (SELECT doc_id, label, len(list_intersect(words, b)) AS shared, len(words) AS n, alpha FROM blocks JOIN templates USING (width)),
     matches AS (SELECT doc_id, label, max(shared / n) AS c FROM pairs WHERE shared >= alpha GROUP BY doc_id, label),
     best AS (SELECT doc_id, max(c) AS c FROM matches GROUP BY doc_id),
     base_labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS x FROM (SELECT DISTINCT doc_id, label FROM places) GROUP BY doc_id),
     labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS x
                FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM matches) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
       coalesce(base_labels.x, '') AS base_labels, coalesce(labels.x, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.c, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN base_labels USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN best USING (doc_id)"""
