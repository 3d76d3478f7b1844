"""Perplexity (M3) on packed pairs: cost by the table only, and the same numbers as its SQL twin."""

import collections
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from textquarry.operators import packed_pairs as PP
from textquarry.operators import quality as Q
from textquarry.plans.registry import all_queries

ROWS = "doc_id int, text string, lang string"


def made(n=60):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the of", "the of", f"w{rng.randint(0, 90)}", "X\ty"]) for _ in range(rng.randint(0, 60))), rng.choice("xy")) for i in range(n)]
    return [*rows, (900, None, "x"), (901, "the of", None), (902, "the the the", "y"), (902, "again", "y")]


def twin(rows, name="perplexity"):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id INT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return con.execute(all_queries()[name].sql).fetchall()


@pytest.mark.parametrize("buckets", [0, 6])
def test_packed_pairs_agree_with_sql(spark, monkeypatch, buckets):
    if buckets:
        monkeypatch.setattr(PP, "bits_for", lambda *_: buckets)
    df = spark.createDataFrame(made(), ROWS)
    model = Q.train_bigrams(df)
    # A row holds many pairs, and no row is made for each pair of a text.
    assert model.pairs.count() <= 2 << buckets and "n" in model.pairs.columns
    scored = Q.perplexity(df, model)
    assert "Generate" not in scored._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: r.perplexity for r in scored.collect()}
    want = dict(twin(made()))
    assert got.keys() == want.keys() and 900 in got and 901 not in got
    assert all(got[i] == pytest.approx(want[i], abs=6e-4) for i in want)


def test_filter_perplexity_agrees_with_sql(spark, tmp_path):
    spark.createDataFrame(made(), ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(r.doc_id for r in all_queries()["filter_perplexity"].run(spark, str(tmp_path)).collect())
    want = {i for i, in twin(made(), "filter_perplexity")}
    assert got == sorted(i for i, _, _ in made() if i in want) and got


def test_a_model_is_dealt_anew_for_a_larger_table(spark, monkeypatch):
    small, more = spark.createDataFrame(made(20), ROWS), spark.createDataFrame(made(60), ROWS)
    model = Q.train_bigrams(small)
    plain = {r.doc_id: r.perplexity for r in Q.perplexity(more, model).collect()}
    monkeypatch.setattr(PP, "bits_for", lambda *_: 5)
    assert model.bits == 0 and {r.doc_id: r.perplexity for r in Q.perplexity(more, model).collect()} == pytest.approx(plain)


def test_long_documents_are_cut_with_a_word_in_common(monkeypatch):
    monkeypatch.setattr(PP, "CHUNK_WORDS", 7)
    texts = [list(range(i, i + n)) for i, n in ((0, 2), (100, 20), (200, 7), (300, 8), (400, 3))]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3, 4]), pa.array(["x", "x", "y", "x", "y"]), pa.array(texts)], ["key", "lang", "words"])
    got = collections.Counter()
    for _, keys, sizes, words in PP.by_language(batch):
        assert len(words) == sum(sizes) and (len(words) <= 7)
        parts = np.split(words, np.cumsum(sizes)[:-1])
        got.update((k, int(a), int(b)) for k, part in zip(keys.to_pylist(), parts) for a, b in zip(part, part[1:]))
        mix, first = PP.pairs_of(words, sizes)
        assert list(mix - first * PP.ODD) == [w for part in parts for w in part[1:]]
    assert got == collections.Counter((k, a, b) for k, t in enumerate(texts) for a, b in zip(t, t[1:]))


def test_pairs_with_one_mix_stay_apart():
    first = np.array([5, 9, 5, 9, 5, 7], np.uint64)
    mix = np.array([3, 3, 3, 3, 3, 1 << 63], np.uint64)
    table = pa.Table.from_batches([PP.summed("x", mix, first, None, 1)])
    known = PP.merged(pa.concat_tables([table, table]), 1)
    rows = [(int(m), int(f), int(n)) for cells in zip(*(PP.unpacked(known.column(c)) for c in ("mix", "first", "n"))) for m, f, n in zip(*cells)]
    assert sorted(rows) == [(3, 5, 6), (3, 9, 4), (1 << 63, 7, 2)]
    assert known.column("bucket").to_pylist() == [0, 1]
    asked = [pa.array([np.array(x, np.uint64).tobytes()]) for x in ([3, 3, 3, 4], [9, 4, 5, 5])]
    asked = pa.table([pa.array(["c"]), pa.array([0]), *asked], ["chunk", "bucket", "mix", "first"])
    found = PP.pair_counts(asked, known.slice(0, 1)).column("answer")
    assert PP.unpacked(found, np.int64)[0].tolist() == [4, 0, 6, 0]
