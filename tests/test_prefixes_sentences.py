"""Prefix joins and sentence boundaries against plain loops and known texts."""

import random

from pyspark.sql import functions as F

from textquarry.operators import joins
from textquarry.operators import sentences as S


def brute(rows, prefixes):
    listed = set(prefixes)
    return sorted((k, t[:n]) for k, t in rows if t for n in range(1, len(t) + 1) if t[:n] in listed)


def test_prefix_join_equals_a_loop(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab/") for _ in range(n))
    rows = [(i, word(rng.randint(0, 12))) for i in range(300)] + [(300, None), (301, "a"), (302, "\u00e9\u00e8x")]
    prefixes = [word(rng.randint(1, 6)) for _ in range(60)] + ["\u00e9", "", None]
    df = spark.createDataFrame(rows, "id bigint, t string")
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(prefixes)], "prefix string, ord int")
    # A filter of one word lets nearly all through and must change nothing.
    for words in (1, 1 << 12):
        got = joins.prefix_join(df, listed, "id", "t", bloom_words=words).collect()
        assert sorted((r.id, r.prefix) for r in got) == brute(rows, [p for p in prefixes if p])
        assert all(r.ord == prefixes.index(r.prefix) for r in got)
    first = {r.id: r.prefix for r in joins.first_prefix(df, listed, "id", "t").collect()}
    for i, t in rows:
        assert first.get(i) == next((p for p in prefixes if p and t and t.startswith(p)), None)
    assert joins.prefix_join(df, listed.limit(0), "id", "t").count() == 0
    assert joins.prefix_join(df.limit(0), listed, "id", "t").count() == 0


def test_a_hundred_thousand_prefixes_one_of_them_hot(spark):
    prefixes = spark.range(100_000).select(F.concat(F.lit("www.site"), "id", F.lit("/")).alias("prefix"))
    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") * 11)
    df = spark.range(20_000).select("id", F.concat(F.lit("www.site"), hot, F.lit("/page"), "id").alias("url"))
    met = joins.prefix_join(df, prefixes, "id", "url")
    want = df.where("id % 2 = 0 OR id * 11 < 100000").count()
    assert met.count() == want and met.where("prefix = 'www.site7/'").count() == 10_000
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "startswith" not in plan.lower() and "rlike" not in plan.lower()


TEXTS = ["We met Dr. Smith and J. R. Jones at noon. It was late.", "See fig. 3 for more. Is it so? Yes! Done", "No period", "", None]


def test_abbreviations_are_learnt_from_counts(spark):
    filler = [f"Then Dr. No{i} saw fig. {i} and the house. Again the noon sun was late over the house again." for i in range(40)]
    rows = list(enumerate(TEXTS + filler))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = S.period_counts(df)
    known = {r.word: r for r in counts.collect()}
    assert (known["dr"].with_period, known["dr"].without_period) == (41, 0)
    assert (known["house"].with_period, known["house"].without_period) == (40, 40)
    short = S.abbreviations(counts)
    assert {r.word for r in short.collect()} == {"dr", "fig"}
    got = {}
    for r in S.split_sentences(df, short).orderBy("doc_id", "sentence_id").collect():
        got.setdefault(r.doc_id, []).append((r.sentence_id, r.sentence))
    assert got[0] == [(0, "We met Dr. Smith and J. R. Jones at noon."), (1, "It was late.")]
    assert got[1] == [(0, "See fig. 3 for more."), (1, "Is it so?"), (2, "Yes!"), (3, "Done")]
    assert got[2] == [(0, "No period")] and got[3] == [(0, "")] and 4 not in got
    assert all(len(v) == 2 for k, v in got.items() if k > 4)


def test_sentences_without_anything_learnt(spark):
    df = spark.createDataFrame([(1, "A. b. Cd. E")], "doc_id bigint, text string")
    short = S.abbreviations(S.period_counts(df))
    assert short.count() == 0
    got = S.split_sentences(df, short).orderBy("sentence_id").collect()
    assert [r.sentence for r in got] == ["A. b. Cd.", "E"]
    assert S.period_counts(df.limit(0)).count() == 0
