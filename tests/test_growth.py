"""Steps whose cost must grow with the table only."""

import collections
import random

from pyspark.sql import functions as F

from textquarry.operators import filters, ordering, sentences
from textquarry.operators.aggregates import char_alphabet
from textquarry.operators.quality import char_ngrams, word_ngrams
from textquarry.plans import streaming_plans


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rules_of_a_host_do_not_gather(spark):
    pages = [(i, f"http://h/p{i % 7}/x{i}") for i in range(200)] + [(900, None), (901, "http://other/p1/x1")]
    df = spark.createDataFrame(pages, "id int, url string")
    rules = [("h", f"/p{i % 7}/x{i}$", i % 3 > 0) for i in range(150)] + [("h", "/p3", False), ("h", "/p4*9", False), ("h", None, False)]
    named = spark.createDataFrame([(*r, False) for r in rules], "host string, path string, allow boolean, malformed boolean")
    tagged = filters.tag_robots(df, named)
    # No row holds the rules of a host: what is collected is keyed by a rule's start.
    assert "_start" in plan(tagged) and "collect_list" not in plan(tagged)

    def want(url):
        if url is None or "//h/" not in url:
            return "robots:unknown_host"
        target = url[len("http://h"):]
        fits = [(len(p), a) for _, p, a in rules if p and (
            target == p[:-1] if p.endswith("$") else target.startswith("/p4") and "9" in target[3:] if "*" in p else target.startswith(p))]
        return None if not fits or max(fits)[1] else "robots:disallowed"

    assert {r["id"]: r["drop_reason"] for r in tagged.collect()} == {i: want(u) for i, u in pages}


def test_bounds_are_one_constant(spark):
    df = spark.createDataFrame([(i, f"n'{i}\"é") for i in range(300)], "a bigint, b string")
    bounds = [(i * 10, f"n'{i}\"é") for i in range(29)]
    number = ordering.range_number(df, ["a", "b"], bounds)
    assert number._jc.toString().count("named_struct") + number._jc.toString().count("struct(") < 10
    got = {r["a"]: r["n"] for r in df.withColumn("n", number).collect()}
    assert got == {a: sum(x < (a, b) for x in bounds) for a, b in ((i, f"n'{i}\"é") for i in range(300))}
    assert "from_json" not in plan(df.withColumn("n", number)).lower()


def test_equal_tokens_are_counted_before_they_are_taken_apart(spark):
    df = spark.createDataFrame([(0, "(Dr. x etc. etc, ETC."), (1, None), (2, "")], "doc_id int, text string")
    found = sentences.period_counts(df)
    got = {r["word"]: (r["with_period"], r["without_period"]) for r in found.collect()}
    assert got == {"dr": (1, 0), "x": (0, 1), "etc": (2, 1)}
    assert "regexp" not in plan(found).lower()  # the tokens were settled before, in a written table


def test_characters_are_counted_in_arrays(spark):
    texts = ["aé😀a", None, "", "́ a\n"]
    counted = char_alphabet(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = collections.Counter("".join(t or "" for t in texts))
    assert {r["char"]: r["count"] for r in counted.collect()} == dict(want)
    assert "Generate" not in plan(counted)


def test_ngrams_of_words_and_characters(spark):
    rng = random.Random(5)
    texts = ["", " ", "a", "Ab c", "x😀é yz"] + [" ".join("abc"[: rng.randint(1, 3)] for _ in range(9)) for _ in range(5)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    chars, words = char_ngrams(F.col("text")), word_ngrams(F.col("text"), 3)
    for r in df.select("text", chars.alias("c"), words.alias("w")).collect():
        own = r["text"].lower().split()
        want = [f"_{w}_"[i : i + n] for w in own for n in (2, 3) for i in range(len(w) + 3 - n)]
        assert sorted(r["c"]) == sorted(want)
        assert sorted(r["w"]) == sorted(" ".join(own[i : i + n]) for n in (1, 2, 3) for i in range(len(own) - n + 1))
    assert "transform" not in plan(df.select(chars.alias("c"))).lower()


def test_streamed_files_grow_with_the_table(spark, monkeypatch, tmp_path):
    numbers = iter(range(9))
    monkeypatch.setattr(streaming_plans, "scratch_path", lambda s, label: str(tmp_path / f"{label}{next(numbers)}"))
    rows = [(i, "en", " ".join(f"w{k}" for k in range(60))) for i in range(200)]
    tables = type("Tables", (), {"spark": spark, "documents": spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(9)})
    assert streaming_plans.stream_documents(tables).count() == 200
    assert len(list(tmp_path.glob("arriving0/*.json"))) == 9


def test_components_of_few_edges_run_in_few_tasks(spark):
    """A table of few edges doesn't cost as many tasks a step as the session shuffles to."""
    from textquarry.llm.components import connected_components

    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    group = "few-edges"
    spark.sparkContext.setJobGroup(group, group)
    try:
        chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 102), (None, 3)]
        found = connected_components(spark.createDataFrame(chain, "a bigint, b bigint"))
        got = {r["node"]: r["component"] for r in found.collect()}
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert tasks < 1500, tasks
