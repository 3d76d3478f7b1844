"""Table operators on small frames: quirks, checks, invariants and known values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry.functions.hashing import uniform
from textquarry.operators import aggregates as G
from textquarry.operators import decontamination as C
from textquarry.operators import dedup as D
from textquarry.operators import dialogue as T
from textquarry.operators import evaluation as E
from textquarry.operators import filters as X
from textquarry.operators import joins as J
from textquarry.operators import mixing as M
from textquarry.operators import packing as P
from textquarry.operators import projections as R
from textquarry.operators import quality as Q
from textquarry.operators import rag as A
from textquarry.operators import runs as U
from textquarry.operators import sampling as S
from textquarry.operators.skew import lookup_by_frequency


def test_known_urls_and_schemes(spark):
    urls = ["https://fr.wikipedia.org/x", "github.com/a", "https://github.com/a", "https://mygithub.com", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id int, url string")
    assert [r.id for r in X.filter_known_urls(df).orderBy("id").collect()] == [3, 4]
    # Raw matching: only a URL without a scheme can start with a prefix.
    assert [r.id for r in X.filter_known_urls(df, strip_scheme=False).orderBy("id").collect()] == [0, 2, 3, 4]
    reasons = {r.id: r.drop_reason for r in X.tag_known_urls(df).collect()}
    assert reasons[0] == "duplicate_url:fr.wikipedia"


def test_robots(spark):
    rules = spark.createDataFrame(
        [("a.org", "/", True, False), ("a.org", "/private/", False, False), ("a.org", "/private/open/", True, False),
         ("b.org", "/", False, True), ("c.org", "/", False, False)],
        "host string, path string, allow boolean, malformed boolean",
    )
    urls = ["http://a.org/x", "http://a.org/private/x", "http://a.org/private/open/x", "http://b.org/x", "http://c.org", "http://d.org/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url for r in X.filter_robots(df, rules).collect()} == {urls[0], urls[2], urls[3]}


def test_keep_and_reject_are_the_input(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    keep, reject = X.split_keep_reject(df, F.col("ok"), "no")
    assert [r.id for r in keep.collect()] == [1]
    assert sorted((r.id, r.drop_reason) for r in reject.collect()) == [(2, "no"), (3, "no")]


def test_public_domain_boundaries(spark):
    rows = [
        (1, "x", None, 1955, "en", None), (2, "x2", None, 1956, "en", None), (3, "x3", None, 1946, "fr", None),
        (4, "x4", 1875, None, "en", None), (5, "x5", 1876, None, "en", None), (6, "x6", None, None, "en", None),
        (7, "x6", None, None, "en", "copyright"), (8, "y", 1900, 1990, "en", None), (9, "y", None, None, "en", None),
    ]
    df = spark.createDataFrame(rows, "book_id int, author string, birth int, death int, language string, rights string")
    assert sorted(r.book_id for r in X.filter_public_domain(df, 2025).collect()) == [1, 4, 6]


def test_rag_filter_null_score_fails(spark):
    rows = [(1, False, True, 1.0), (2, False, True, None), (3, True, None, None), (4, False, False, 1.0)]
    df = spark.createDataFrame(rows, "id int, is_unanswerable boolean, eval_answer_correct boolean, eval_chunk_f1 double")
    assert [r.id for r in X.filter_rag(df).orderBy("id").collect()] == [1, 3]
    assert [r.id for r in X.filter_rag(df.drop("eval_chunk_f1")).orderBy("id").collect()] == [1, 2, 3]


def test_checkpoints(spark):
    names = ["m--step=99", "m--step=199", "m--step=199-last", "m--totalstep_299", "m--step=150"]
    df = spark.createDataFrame([(n,) for n in names], "checkpoint string")
    got = X.select_checkpoints(df, min_step=150, multiple_of=100).orderBy("step").collect()
    assert [r.checkpoint for r in got] == ["m--step=199", "m--totalstep_299"]
    assert X.select_checkpoints(df, last_only=True).first().step == 299


def test_published_needs_language(spark):
    df = spark.createDataFrame([("1", "pre: body", "pre: ", None)], "id string, text string, prefix string, lang string")
    out = R.to_published(df, source="s", language="fr", remove_prefix=True, remove_keys=("prefix",))
    assert out.schema.fieldNames() == R.PUBLISHED.fieldNames()
    # What is missing stays visible in the metadata.
    assert out.first().text == "body" and out.first().metadata == '{"lang":null}'
    bare = R.to_published(df, source="s", language="fr", remove_keys=("prefix", "lang"))
    assert bare.first().metadata == "{}"
    with pytest.raises(Exception, match="language must be given"):
        R.to_published(df, source="s", language_key="lang").collect()


def test_join_1to1_fails_on_duplicates(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "name string, n int")
    b = spark.createDataFrame([("x", 3)], "name string, m int")
    assert sorted((r.name, r.n, r.m) for r in J.join_1to1(a, b, "name").collect()) == [("x", 1, 3), ("y", 2, None)]
    with pytest.raises(Exception, match="duplicate key in right: x"):
        J.join_1to1(a, b.union(b), "name").collect()


def test_require_same_sets(spark):
    a = spark.createDataFrame([("fr", "t1"), ("fr", "t2")], "language string, task string")
    J.require_same_sets(a, a, "task", ["language"])
    with pytest.raises(ValueError, match="t2"):
        J.require_same_sets(a, a.limit(1), "task", ["language"])


def test_lookup_by_frequency_with_a_hot_key(spark):
    left = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 0")
    for hot in (1, 50, 10_000):
        got = lookup_by_frequency(left, right, "k", "n", ["id"], hot_keys=hot)
        want = left.join(right, "k", "left").select("id", "k", "n")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_dedup_is_idempotent_and_first_wins(spark):
    df = spark.createDataFrame([(2, "a  b"), (1, "a b\n"), (3, "c")], "id int, text string")
    once = D.dedup_normalized(df, ["id"])
    assert sorted(r.id for r in once.collect()) == [1, 3]
    assert sorted(r.id for r in D.dedup_normalized(once, ["id"]).collect()) == [1, 3]


@pytest.mark.parametrize("tokens, repeat, want", [(118_797_157, 1.0, 29_003), (188_680_376, 2.0, 92_129), (14_752_419_752, 1.0, 3_601_664)])
def test_datamix_known_weights(spark, tokens, repeat, want):
    stats = spark.createDataFrame([("a", tokens), ("tiny", 10)], "name string, total_tokens bigint")
    repeats = spark.createDataFrame([("a", repeat), ("tiny", 1.0)], "name string, repeat double")
    row = M.make_datamix(stats, repeats).collect()
    assert [(r.name, r.weight) for r in row] == [("a_text_document", want)]
    assert row[0].total_tokens == 4096 * 1024 * (want // 1024)


def test_token_sizes():
    assert M.parse_tokens("35b") == 35 * 10**9 and M.parse_tokens("2m") == 2_000_000 and M.parse_tokens("7") == 7
    with pytest.raises(ValueError):
        M.parse_tokens("many")


def test_split_plan(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.25), ("z", 0.0)], "name string, repeat double")
    b = spark.createDataFrame([("x", 3.0), ("y", 0.5)], "name string, repeat double")
    got = M.split_plan(a, b).collect()
    assert [(r.name, r.modulo_phase1, r.modulo_phase2, r.remainder) for r in got] == [("y", 0.25, 0.5, 0.25)]


def test_energy_total(spark):
    hours = [1185.1, 870.1, 253.0, 213.5, 178.9, 259.3, 294.9, 28.8]
    df = spark.createDataFrame([(f"j{i}", h) for i, h in enumerate(hours)], "job_type string, walltime_h double")
    total = U.cost_rollup(df, "job_type", ["walltime_h"]).where("job_type = 'TOTAL'").first()
    assert round(total.walltime_h, 1) == 3283.6


def test_step_stats_short_and_long_runs(spark):
    rows = [("a", i, float(i)) for i in range(4)] + [("b", i, 1.0 if i < 5 else 3.0) for i in range(7)]
    df = spark.createDataFrame(rows, "run string, iteration bigint, step_seconds double").withColumn("logged_at", F.current_timestamp())
    got = {r.run: r for r in U.step_stats(df, rows_per_range=4).collect()}
    assert got["a"].step_timings_mean == 1.5 and got["b"].step_timings_mean == 3.0
    assert got["b"].total_time == 11.0 and got["b"].step_timings_std == 0.0


def test_fertility(spark):
    df = spark.createDataFrame([("deux  mots 12\tx\n\nfin é",)], "text string")
    tokens = F.split("text", "(?<=\\s)|(?=\\s)")
    row = G.tokenizer_stats(df, tokens).first()
    assert (row.paragraphs, row.lines, row.words, row.digits, row.tabs) == (2, 3, 6, 2, 1)
    assert row.bytes == row.chars + 1
    assert round(477639952 / 273803280, 3) == 1.744 and round(1655638539 / 477639952, 3) == 3.466


def test_length_stats_equal_numpy(spark):
    rng = random.Random(3)
    values = [rng.randrange(1, 90) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    row = G.length_stats(df, [], F.col("n")).first()
    assert (row.total_tokens, row.total_sequences) == (sum(values), 501)
    assert [row.Q1_tokens, row.Q2_tokens, row.Q3_tokens] == list(np.percentile(values, [25, 50, 75]))


def test_partials_merge_to_the_whole(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("shard"), F.col("id").cast("double").alias("x"))
    whole = G.merge_stats(G.partial_stats(df, ["g"], "x"), ["g"]).orderBy("g").collect()
    merged = G.merge_stats(G.partial_stats(df, ["g", "shard"], "x"), ["g"]).orderBy("g").collect()
    assert [(r.n, r.total, round(r.std, 9)) for r in whole] == [(r.n, r.total, round(r.std, 9)) for r in merged]


def test_alphabet_rules(spark):
    text = "aaa ééé ́́ 汉汉 αα م م 1"
    alphabet = {r.char: r for r in G.char_alphabet(spark.createDataFrame([(text,)], "text string")).collect()}
    assert alphabet["a"]["count"] == 3 and alphabet["α"].family == "GREEK" and alphabet["م"].family == "ARABIC"
    kept = {r.char for r in G.select_alphabet(spark.createDataFrame(list(alphabet.values()))).collect()}
    assert "汉" not in kept and "́" not in kept and {"a", "é", "م", "1"} <= kept


def test_normalized_scores(spark):
    def f(score, random):
        return spark.range(1).select(E.normalized(F.lit(score), F.lit(random)).alias("x")).first().x

    assert f(0.625, 0.25) == 50 and f(0.1, 0.25) == 0 and f(1.0, 0.0) == 100
    with pytest.raises(Exception, match="out of bounds"):
        f(1.5, 0.0)
    with pytest.raises(Exception, match="out of bounds"):
        f(-0.1, 0.0)


def test_fit_needs_two_points(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("a", np.e, 2.0), ("b", 5.0, 1.0), ("b", 0.0, 9.0)], "e string, tokens double, score double")
    got = {r.e: r for r in E.fit_curves(df, ["e"]).collect()}
    assert got["a"].slope == pytest.approx(2.0) and got["a"].r2 == pytest.approx(1.0)
    assert got["b"].slope is None and got["b"].n == 1


def test_sampling_is_monotone_and_exact(spark):
    df = spark.range(2000)
    small = {r.id for r in S.sample_rate(df, 0.1).collect()}
    large = {r.id for r in S.sample_rate(df, 0.4).collect()}
    assert small < large and 600 < len(large) < 1000
    for n in (0, 1, 777, 2000, 3000):
        taken, rest = S.smallest_hashes(df, n, "id")
        assert taken.count() == min(n, 2000) and rest.count() == 2000 - min(n, 2000)
    assert [r.id for r in S.sample_n(df, 3, "id", seed=-5).orderBy("id").collect()] == [5, 6, 7]
    with pytest.raises(ValueError):
        S.rate_for_target(df, F.lit(1), 5000)
    assert S.split_ratio(df, [0.2, 0.2]).count() < 1000


def test_decontamination_with_any_filter(spark):
    words = [f"w{i}" for i in range(40)]
    bench = spark.createDataFrame([(" ".join(words[:20]), "q1 q2")], "text string, query string")
    docs = spark.createDataFrame(
        [(1, "x " + " ".join(words[3:16]) + " y"), (2, " ".join(words[3:15])), (3, " ".join(reversed(words))), (4, "W3, " + " ".join(words[4:16]))],
        "doc_id int, text string",
    )
    index = C.build_ngram_index(bench, query="query")
    assert {r.doc_id for r in C.contaminated_ids(docs, index).collect()} == {1, 4}
    clean, removed = C.decontaminate(docs, index, bloom_words=1)
    assert {r.doc_id for r in clean.collect()} == {2, 3} and {r.doc_id for r in removed.collect()} == {1, 4}


def test_bloom_filter_passes_all_members_and_few_others(spark):
    members = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    others = spark.range(50_000, 150_000).select(F.xxhash64("id").alias("h"))
    words = 4096  # 13 bits a member
    bloom = C.bloom_filter(members, words=words).cache()
    assert bloom.count() <= words
    assert C.may_contain(members, bloom, words=words).count() == 20_000
    assert C.may_contain(others, bloom, words=words).count() < 2_500
    assert C.may_contain(others, C.bloom_filter(members.limit(0), words=words), words=words).count() == 0


def test_merge_chunks_outcomes(spark):
    rows = [(1, "b", 1, 2, "stop"), (1, "a", 0, 2, "stop"), (2, "x", 0, 1, "length"), (3, "y", 0, 2, "stop")]
    df = spark.createDataFrame(rows, "id int, text string, chunk_id int, num_chunks int, finish_reason string")
    merged, rejected, incomplete = T.merge_chunks(df)
    assert [(r.id, r.text) for r in merged.collect()] == [(1, "a\n\nb")]
    assert [r.id for r in rejected.collect()] == [2] and [r.id for r in incomplete.collect()] == [3]


def test_dialogue_needs_three_messages(spark):
    df = spark.sql("SELECT 1 AS id, array(struct('user' AS role, 'hi' AS content)) AS messages")
    with pytest.raises(Exception, match="expected 3 messages, got 1"):
        T.render_dialogue(df, "id").collect()


def qa(spark, n=60):
    rows = [
        (f"r{i}", "q", "a", (["T1", "T2", "T3", "T4", "T5"], [["s1 "], ["s2", "s3"], ["s4"], ["s5"], ["s6"]]), (["T1", "T3"],), "t", False)
        for i in range(n)
    ]
    schema = (
        "id string, question string, answer string, context struct<title:array<string>,sentences:array<array<string>>>, "
        "supporting_facts struct<title:array<string>>, reasoning_trace string, is_unanswerable boolean"
    )
    return spark.createDataFrame(rows, schema)


def test_context_keeps_relevant_and_minimum(spark):
    rows = A.assemble_context(qa(spark), max_remove=1.0, min_chunks=4, protected=("T2",)).collect()
    assert {r.chunks_total for r in rows} == {4, 5}
    for r in rows:
        assert r.chunks_relevant == 2 and r.chunks_total == 5 - r.chunks_background_removed
        for title in ("[T1]\ns1", "[T2]\ns2 s3", "[T3]\ns4"):
            assert title in r.context_text
    assert len({r.context_text for r in rows}) > 5


def test_unanswerable_rows_lose_support(spark):
    out = A.add_unanswerable(qa(spark), 0.25).where("is_unanswerable").collect()
    assert len(out) == 15
    assert all(r.answer == "" and list(r.context.title) == ["T2", "T4", "T5"] and r.id.endswith("_unanswerable") for r in out)
    assert A.add_unanswerable(qa(spark), 0.25, min_passages=4).count() == 60


def test_reformat_context(spark):
    raw = "intro\n[A]\nbody one\n----------\n\n[B]\n\n[C]\nlast "
    got = spark.range(1).select(A.reformat_context(F.lit(raw)).alias("x")).first().x
    assert got == A.CONTEXT_SEPARATOR.join(["intro", "[A]\nbody one", "[B]", "[C]\nlast"])
    assert spark.range(1).select(A.reformat_context(F.lit(" plain ")).alias("x")).first().x == "plain"


def test_first_fit_order():
    assert P.first_fit([(5, 1), (6, 1), (4, 1), (3, 1), (2, 1)], 10) == [
        (1, [(5, 1), (4, 1)]), (1, [(6, 1), (3, 1)]), (1, [(2, 1)])
    ]


def test_first_fit_of_many_equal_lengths_equals_one_by_one():
    rng = random.Random(3)
    for _ in range(50):
        counts = [(n, rng.randint(1, 9)) for n in rng.sample(range(1, 40), 6)]
        free = []
        for length, many in counts:
            for _ in range(many):
                at = next((i for i, room in enumerate(free) if room >= length), len(free))
                if at == len(free):
                    free.append(50)
                free[at] -= length
        got = P.first_fit(counts, 50)
        assert [50 - sum(n * u for n, u in parts) for many, parts in got for _ in range(many)] == free


def test_pack_columns_known_batch(spark):
    # Two sequences of 70 tokens: 69 inputs each, padded to a multiple of 16.
    ids = list(range(100, 170)) + list(range(200, 270))
    mask = [0] * 24 + [1] * 45 + [0] + [0] * 24 + [1] * 45 + [0]
    df = spark.createDataFrame([(ids, mask, [0, 70, 140])], "input_ids array<int>, loss_mask array<int>, seq_boundaries array<int>")
    row = P.pack_columns(df, pad_id=1).first()
    assert row.cu_seqlens == [0, 69, 138, 144] and row.cu_seqlens_unpadded == [0, 69, 138, 138]
    assert row.token_count == 138 and row.max_seqlen == 69 and len(row.tokens) == 144
    assert row.tokens[:69] == ids[:69] and row.labels[:69] == ids[1:70] and row.tokens[138:] == [1] * 6
    assert row.position_ids == [*range(69), *range(69), *[0] * 6]
    assert sum(row.loss_mask) == 90 and row.loss_mask[69 + 24] == 1
    fixed = P.pack_columns(df, pad_id=1, max_length=160, pad_to_max_length=True, cu_size=6).first()
    assert len(fixed.tokens) == len(fixed.labels) == len(fixed.loss_mask) == 160
    assert fixed.cu_seqlens == [0, 69, 138, 160, 160, 160] and fixed.cu_seqlens_unpadded == [0, 69, 138, 138, 138, 138]
    for wrong in ({"max_length": 100}, {"cu_size": 3}):
        with pytest.raises(Exception, match="longer than max_length|more sequences"):
            P.pack_columns(df, pad_id=1, **wrong).collect()


@pytest.mark.parametrize("algorithm", ["first_fit_shuffle", "first_fit_decreasing"])
def test_packing_keeps_tokens(spark, algorithm):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(9) for _ in range(rng.randrange(5, 40))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>").withColumn("loss_mask", F.transform("input_ids", lambda x: F.lit(1)))
    packs = P.pack(df, "id", capacity=64, algorithm=algorithm).collect()
    assert sum(len(p.input_ids) for p in packs) == sum(len(r[1]) for r in rows)
    assert all(len(p.input_ids) - (len(p.seq_boundaries) - 1) <= 64 for p in packs)
    assert sum(len(p.seq_boundaries) - 1 for p in packs) == 300
    report = P.pack_report(P.pack(df, "id", capacity=64, algorithm=algorithm), 64).first()
    assert report.fill_rate > 0.8


def test_degenerate_packs_are_dropped(spark):
    df = spark.createDataFrame([([0, 1, 0],), ([0, 1, 1],), ([0, 0, 0],)], "loss_mask array<int>")
    assert P.drop_degenerate(df).count() == 2


def test_classifier_learns_a_word(spark):
    rows = [(i, "good fine nice text" if i % 2 else "bad poor ugly text", "High Quality" if i % 2 else "0") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, label string")
    model = Q.train_classifier(df, "label", features=1 << 10, iterations=5)
    scored = Q.score_classifier(df, model)
    assert set(scored.first().label_probs) == {"__label__0", "__label__high_quality"}
    assert {r.id for r in Q.drop_zero_class(scored).collect()} == {i for i, _, _ in rows if i % 2}


def test_language_model(spark):
    rows = [(i, "the cat and the dog are here" if i % 2 else "le chat et le chien sont ici", "en" if i % 2 else "fr") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, lang string")
    found = Q.identify_language(df, Q.train_language_model(df, features=1 << 10))
    assert found.where("lang <> language_id").count() == 0
    assert Q.filter_language(found, ["fr"], 0.65).count() == 20


@pytest.mark.parametrize("head_rows", [0, 3, 1000])
def test_perplexity_by_hand(spark, head_rows):
    from math import exp, log

    df = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "x"), (3, "a c", "x")], "doc_id int, text string, lang string")
    model = Q.train_bigrams(df)
    # Five kinds of pairs: <s> a, a b, a c, b </s>, c </s>.
    pair = {"<s> a": 2.25 / 3 + 0.25 / 5, "a b": 1.25 / 3 + 0.5 / 5, "a c": 0.25 / 3 + 0.5 / 5, "b </s>": 1.25 / 2 + 0.375 * 2 / 5, "c </s>": 0.25 + 0.75 * 2 / 5}
    new = spark.createDataFrame([(4, "b a", "x"), (5, "z b", "x"), (6, "a b", "y"), (7, "", "x")], df.schema)
    # Pairs not seen back off: to the second word after the first, after no known word, to an unseen word.
    pair |= {"<s> b": 0.25 / 5, "b a": 0.375 / 5, "a </s>": 0.5 * 2 / 5, "<s> z": 0.25 * 0.5 / 5, "z b": 1 / 5, "<s> </s>": 0.25 * 2 / 5}
    texts = {1: "a b", 2: "a b", 3: "a c", 4: "b a", 5: "z b", 7: ""}
    got = {r.doc_id: r.perplexity for r in Q.perplexity(df.union(new), model, head_rows=head_rows).collect()}
    assert got.pop(6) == pytest.approx(1e6)
    for doc_id, text in texts.items():
        w = ["<s>", *text.split(), "</s>"]
        logs = [log(pair[f"{x} {y}"]) for x, y in zip(w, w[1:])]
        assert got[doc_id] == pytest.approx(exp(-sum(logs) / len(logs))), doc_id


def test_uniform_is_uniform(spark):
    row = spark.range(4000).select(uniform("id").alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(row[0] - 0.5) < 0.02 and row[1] >= 0 and row[2] < 1


@pytest.mark.parametrize("ranked_rows", [100_000, 0])
def test_smallest_hashes_refine_the_edge_bin(spark, monkeypatch, ranked_rows):
    from textquarry.operators import sampling as Y

    monkeypatch.setattr(Y, "HASH_BINS", 4)
    monkeypatch.setattr(Y, "RANKED_ROWS", ranked_rows)
    df = spark.range(500).withColumn("u", uniform("id", seed=42))
    ordered = [r["id"] for r in df.orderBy("u", "id").collect()]
    for n in (0, 1, 137, 500, 900):
        chosen, rest = Y.smallest_hashes(df, n, "id")
        assert {r["id"] for r in chosen.collect()} == set(ordered[:n])
        assert {r["id"] for r in rest.collect()} == set(ordered[n:])


def test_published_models_have_sizes_and_tokens(spark):
    from textquarry.operators.evaluation import checkpoint_tokens

    want = {
        "runs/OLMo-2-1124-7B/stage1-step1000-tokens5.5B": (7.0, 5.5),
        "runs/OLMo-2-1124-7B": (7.0, None),
        "runs/Apertus-8B": (8.0, 15000.0),
        "runs/Apertus-8B-tokens210B": (8.0, 210.0),
        "runs/SmolLM2-1.7B/step-125000": (1.711376384, 250.0),
        "runs/SmolLM2-1.7B": (1.711376384, 11000.0),
        "runs/Qwen3-0.6B-Base": (0.6, 36000.0),
        "runs/Qwen2.5-14B": (14.0, 18000.0),
        "runs/Ministral-3-8B": (8.0, 8000.0),
        "runs/1b_phase1/step=10": (1.319309312, 10 * 4096 * 1024 / 1e9),
    }
    df = spark.createDataFrame([(p,) for p in want], "path string")
    got = {r.path: r for r in checkpoint_tokens(df).collect()}
    for path, (size, tokens) in want.items():
        assert got[path].model_size == size, path
        if path.startswith("runs/1b"):
            assert got[path].tokens >= tokens
        else:
            assert got[path].tokens == tokens, path
            assert got[path].FLOPs == (None if tokens is None else size * tokens * 6 * 1e18), path
    with pytest.raises(Exception, match="unknown model size"):
        checkpoint_tokens(spark.createDataFrame([("runs/other/step=1",)], "path string")).collect()
