"""Periodic runs of words."""

import collections
import random
import zlib

import numpy as np
import pytest
from made_up import WORD, prose
from pyspark.sql import functions as F

from textquarry.llm import periodic_runs
from textquarry.llm.common import id_crc
from textquarry.llm.periodic_runs import Positions, collapse, find_runs, loop_tail, strongest, suffix_ranks, word_runs


def by_definition(words, min_length=6, min_exponent=4):
    """Unbroken stretches of equal words at each distance, without those that a smaller period covers."""
    found = set()
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                found.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(
        r for r in found if not any(o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in found)
    )


def some_words(seed):
    rnd = random.Random(seed)
    n, kinds = rnd.randint(0, 60), rnd.choice([1, 2, 2, 3, 5])
    words = [rnd.randrange(kinds) for _ in range(n)]
    for _ in range(rnd.randint(0, 2)):
        if n > 8:
            a, p = rnd.randrange(n), rnd.randint(1, 6)
            for i in range(a + p, min(n, a + rnd.randint(1, n))):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("min_length,min_exponent", [(6, 4), (2, 2), (4, 3)])
def test_runs_equal_their_definition(min_length, min_exponent):
    for seed in range(600):
        words = some_words(seed)
        got = word_runs(np.array(words, np.int64), min_length, min_exponent)
        assert got == by_definition(words, min_length, min_exponent), words


def test_sets_of_many_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_BLOCK", 3)
    rnd = random.Random(5)
    for _ in range(60):
        words = [rnd.randrange(2) for _ in range(200)]
        assert word_runs(np.array(words), 6, 2) == by_definition(words, 6, 2)
    members = Positions(50)
    values = rnd.sample(range(50), 40) + rnd.sample(range(51, 100), 40)
    for x in values:
        known = sorted([50, *values[: values.index(x)]])
        assert members.around(x) == (
            max((k for k in known if k < x), default=-1),
            min((k for k in known if k > x), default=-1),
        )
        members.add(x)
    assert list(members) == sorted([50, *values])


def test_ranks_order_the_suffixes():
    words = [1, 0, 1, 0, 1, 2, 0, 1]
    order = np.argsort(suffix_ranks(np.array(words))[-1]).tolist()
    assert order == sorted(range(len(words)), key=lambda i: words[i:])


def test_strongest_run_and_what_stays():
    assert strongest([]) is None
    assert strongest([(9, 12, 3), (0, 8, 2), (4, 8, 2)]) == (0, 8, 2)
    runs = [(1, 8, 2), (5, 6, 1)]
    assert np.flatnonzero(~collapse(12, runs)).tolist() == [3, 4, 5, 6, 7, 8, 9, 10]


def test_find_runs_of_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(20, "ab ba " * 5 + "x", "en", "s1"), (21, "é " * 3000, "en", "s1"), (22, "a a " * 6, "en", "s1")]
    got = collections.Counter(
        (r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["strongest"] and tuple(r["strongest"]), r["collapsed"])
        for r in find_runs(make_docs(rows)).collect()
    )
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = by_definition(words) if len(words) < 5000 else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        want[doc_id, len(words), tuple(runs), strongest(runs), left] += 1
    assert got == want
    assert find_runs(make_docs([])).count() == 0


def test_looped_tails(make_docs):
    rows = [(i, prose(i, i % 40)) for i in range(300)] + [(None, prose(7, 30)), (3, None)]
    docs = make_docs(rows).select("doc_id", loop_tail(F.coalesce("text", F.lit("")), id_crc("doc_id")).alias("text"))
    got = collections.Counter((r["doc_id"], tuple(WORD.findall(r["text"]))) for r in docs.collect())
    want, changed = collections.Counter(), 0
    for doc_id, text in rows:
        words, h = WORD.findall(text or ""), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        want[doc_id, tuple(words)] += 1
    assert got == want and changed > 10


def test_the_query_finds_what_it_loops(spark):
    from textquarry.llm.queries import QUERIES

    rows = QUERIES["op11_runs"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: WORD.findall(r["text"] or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        words, h = docs[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            a, parts = h // 10 % len(words), 3 + h // 10 % 8
            p = 1 + (len(words) - a) // parts
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        runs = by_definition(words) if len(words) < 3000 else word_runs(np.unique(words, return_inverse=True)[1])
        best = strongest(runs)
        assert (r["n_runs"], r["start"]) == (len(runs), best and best[0])
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
