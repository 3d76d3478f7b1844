"""Samples and splits; the SQL twins repeat the same hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from textquarry.functions.text import n_words
from textquarry.operators import sampling as X
from textquarry.plans.registry import query
from textquarry.plans.sqlbits import n_words as sql_words
from textquarry.plans.sqlbits import uniform


@query("sample_rate", "SP1", f"SELECT doc_id FROM documents WHERE {uniform('doc_id')} < 0.3")
def sample_rate(t):
    return X.sample_rate(t.documents, 0.3, "doc_id").select("doc_id")


@query(
    "sample_by_source", "SP2",
    f"""WITH s AS (SELECT doc_id, CASE WHEN source IN ('src0', 'src1') THEN CASE WHEN lang = 'en' THEN 1 ELSE 2 END WHEN source = 'src2' THEN 1 WHEN source = 'src3' THEN 1.5
              WHEN source = 'src4' THEN 2 WHEN source = 'src5' THEN 2.5 WHEN source = 'src6' THEN 3 ELSE 0 END AS repeat FROM documents)
        SELECT doc_id FROM s WHERE {uniform('doc_id', seed=5)} < repeat * 0.3""",
)
def sample_by_source(t):
    names = {"src0": "Eurovoc", "src1": "Eurovoc", "src2": "RedPajama", "src3": "FineWebEdu", "src4": "TheStack", "src5": "PeS2o", "src6": "Wikipedia"}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    source = F.coalesce(F.try_element_at(table, F.col("source")), F.col("source"))
    return X.sample_by(t.documents, X.source_repeat(source, F.col("lang")), 0.3, "doc_id", seed=5).select("doc_id")


@query(
    "sample_exact", "SP3",
    f"SELECT doc_id FROM documents ORDER BY {uniform('doc_id', seed=9)}, doc_id LIMIT 123",
)
def sample_exact(t):
    return X.sample_n(t.documents, 123, "doc_id", seed=9).select("doc_id")


@query("sample_slice", "SP3", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100 OFFSET 40")
def sample_slice(t):
    return X.sample_n(t.documents, 100, "doc_id", seed=-40, rows_per_range=20_000).select("doc_id")


@query(
    "sample_to_target", "SP4",
    f"SELECT doc_id FROM documents WHERE {uniform('doc_id')} < 50000.0 / (SELECT sum({sql_words('text')}) FROM documents)",
)
def sample_to_target(t):
    rate = X.rate_for_target(t.documents, n_words(F.col("text")), 50_000)
    return X.sample_rate(t.documents, rate, "doc_id").select("doc_id")


@query(
    "split_ratio", "SP5",
    f"""WITH u AS (SELECT doc_id, {uniform('doc_id', seed=3)} AS u FROM documents)
        SELECT doc_id, CASE WHEN u < 0.5 THEN 0 WHEN u < 0.8 THEN 1 ELSE 2 END AS split FROM u WHERE u < 0.9""",
)
def split_ratio(t):
    return X.split_ratio(t.documents, [0.5, 0.3, 0.1], "doc_id", seed=3).select("doc_id", "split")


@query(
    "train_test", "SP7",
    f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {uniform('doc_id')}, doc_id) <= 100 THEN 'test' ELSE 'train' END AS part FROM labels""",
)
def train_test(t):
    train, test = X.train_test(t.labels, 100, "doc_id")
    return train.select("doc_id", F.lit("train").alias("part")).unionByName(test.select("doc_id", F.lit("test").alias("part")))


@query(
    "choose_prompt", "SP10",
    f"""WITH u AS (SELECT doc_id, text, {uniform('doc_id', seed=11)} AS u FROM documents)
        SELECT doc_id, CASE WHEN u < 0.25 THEN 'easy: ' WHEN u < 0.75 THEN 'medium: ' ELSE 'hard: ' END || substr(text, 1, 2000) AS instruction FROM u""",
)
def choose_prompt(t):
    from textquarry.functions.text import fill_prompt

    chosen = X.choose_prompt(t.documents, ["easy: <text>", "medium: <text>", "hard: <text>"], [1, 2, 1], "doc_id", seed=11)
    return chosen.select("doc_id", fill_prompt(F.col("prompt"), F.col("text")).alias("instruction"))
