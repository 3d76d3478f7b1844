"""Perplexity (M3) of a table under its own model: little written, and the same numbers as its SQL twin."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from test_packed_pairs import ROWS, made, twin
from textquarry.operators import own_pairs as OP
from textquarry.operators import packed_pairs as PP
from textquarry.operators import quality as Q
from textquarry.plans.registry import all_queries


@pytest.mark.parametrize("buckets", [0, 6])
def test_own_model_agrees_with_sql(spark, monkeypatch, buckets):
    monkeypatch.setattr(PP, "bits_for", lambda *_: buckets)
    # A word that is written like a mark, a text of spaces only and one of one long line.
    rows = [*made(), (903, "</s> <s> </s>", "y"), (904, " \t\n", "y"), (905, "a " * 5000 + "b", "z")]
    got = {r.doc_id: r.perplexity for r in Q.own_perplexity(spark.createDataFrame(rows, ROWS)).collect()}
    want = dict(twin(rows))
    assert got.keys() == want.keys() and {900, 903, 904, 905} <= got.keys() and 901 not in got
    assert all(got[i] == pytest.approx(want[i], abs=6e-4) for i in want)


def test_own_model_of_no_rows(spark):
    rows = [(1, "a", None), (2, None, None)]
    for df in (spark.createDataFrame(rows, ROWS), spark.createDataFrame([], ROWS)):
        assert Q.own_perplexity(df).collect() == []


@pytest.mark.parametrize("name", ["perplexity", "filter_perplexity"])
def test_less_is_written_than_read(spark, monkeypatch, tmp_path, name):
    """Words as hashes and pairs as two hashes and a count took several times the text."""
    rng, folder = random.Random(1), tmp_path / "scratch"
    monkeypatch.setattr("textquarry.session.shared_folder", lambda _: str(folder))
    words = [f"word{i}" for i in range(20_000)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(200)]
    (tmp_path / "tables").mkdir()
    spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], ROWS).coalesce(1).write.parquet(str(tmp_path / "tables" / "documents.parquet"))
    assert len(all_queries()[name].run(spark, str(tmp_path / "tables")).collect()) > 0
    written = sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))
    assert 0 < written < sum(map(len, texts))


def test_squeezed_numbers_come_back():
    rng = np.random.default_rng(2)
    for values in ([], [0], [1] * 9, [2**64 - 1, 0], rng.integers(0, 2**63, 999), rng.integers(0, 300, 999)):
        values = np.array(values, np.uint64)
        for rising in (False, True):
            values = np.sort(values) if rising else values
            cell = pa.array([OP.squeezed(values, rising)])[0]
            assert OP.spread(cell, rising).tolist() == values.tolist()
    ones = OP.squeezed(np.ones(100_000, np.int64))
    assert len(ones) < 100


def test_long_documents_are_cut_without_losing_a_pair(monkeypatch):
    """The steps by hand, with chunks of seven words, against a count of all pairs."""
    import collections
    import math

    monkeypatch.setattr(PP, "CHUNK_WORDS", 7)
    rng, bits = random.Random(4), 2
    texts = [[rng.randint(0, 9) << 60 for _ in range(n)] for n in (2, 30, 7, 8, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["x"] * 5), pa.array([[w - (1 << 64) if w >> 63 else w for w in t] for t in texts], pa.list_(pa.int64()))], ["key", "lang", "words"])
    chunks = list(OP.chunks([batch]))

    def grouped(tables, *by):
        table, found = pa.concat_tables(tables), collections.defaultdict(list)
        for i, row in enumerate(zip(*(table.column(c).to_pylist() for c in by))):
            found[row].append(i)
        return {k: table.take(v) for k, v in found.items()}

    ids = [OP.numbered(t, bits) for t in grouped([pa.Table.from_batches([b]) for c in chunks for b in OP.asked_words([c], bits)], "lang", "bucket").values()]
    of = grouped(ids, "chunk")
    pairs = [OP.counted(pa.Table.from_batches([c]), of[(c.column("chunk")[0].as_py(),)], bits) for c in chunks]
    counted = pa.concat_tables([OP.summed(t, bits) for t in grouped(pairs, "lang", "bucket").values()])
    asked, sums = counted.filter(pa.compute.is_valid(counted["chunk"])), counted.filter(pa.compute.is_null(counted["chunk"]))
    by_bucket = grouped([sums], "bucket")
    words = [OP.word_sums(t, by_bucket[k]) for k, t in grouped(ids, "bucket").items()]
    total = pa.compute.sum(counted["total"]).as_py()

    def answer(t, of, column):
        none = pa.nulls(t.num_rows, pa.binary())
        return pa.Table.from_arrays([t["chunk"].cast(pa.string()), PP.same(of, t.num_rows), t["bucket"], t[column], none, none], ["chunk", "of", "bucket", "a", "b", "c"])

    answers = grouped([*words, *[answer(t, "ids", "id") for t in ids], answer(asked, "pairs", "n")], "chunk")
    got = collections.defaultdict(float)
    for c in chunks:
        t = pa.Table.from_batches([c]).append_column("total", pa.array([total]))
        for r in OP.log_probabilities(t, answers[(c.column("chunk")[0].as_py(),)], bits, 0.75).to_pylist():
            got[r["key"]] += r["logp"]

    n = collections.Counter(p for t in texts for p in zip(t, t[1:]))
    c, types, k = collections.Counter(), collections.Counter(a for a, _ in n), collections.Counter(b for _, b in n)
    for (a, _), m in n.items():
        c[a] += m
    assert total == len(n) and len(chunks) > 5
    for i, t in enumerate(texts):
        want = sum(math.log((n[a, b] - 0.75) / c[a] + 0.75 * types[a] / c[a] * k[b] / total) for a, b in zip(t, t[1:]))
        assert got[i] == pytest.approx(want), i
