"""License scans: the set-similarity join against every block with every template."""

import collections
import math
import random
import re

import pytest
from made_up import prose

from textquarry.llm import licenses
from textquarry.llm.licenses import PHRASES, TEMPLATES, match_templates, plain_words, scan_licenses, width_of

MORE = (("zero", "granted"), ("mixed", "Licence Ünder ÄÖ terms 7 of the of the of the week"), *TEMPLATES)


def by_loop(text, templates=TEMPLATES, least=0.9):
    """``n_words, places, labels, matches, score`` of one text."""
    words = plain_words(text or "")
    places = []
    for label, phrase in PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    matches = set()
    for k, (label, notice) in enumerate(templates):
        own, width = set(plain_words(notice)), width_of(plain_words(notice))
        for block in range(max(1, math.ceil(len(words) / width) - 1)):
            start, end = block * width, min(len(words), (block + 2) * width)
            shared = len(own & set(words[start:end]))
            if shared >= math.ceil(least * len(own) - 1e-9):
                matches.add((start, end, k, label, shared / len(own)))
    labels = sorted({label for _, label in places} | {m[3] for m in matches})
    score = 1.0 if places else max((m[4] for m in matches), default=0.0)
    return len(words), tuple(places), tuple(labels), tuple(sorted(matches)), score


def edited(text, seed, rate):
    rnd, out = random.Random(seed), []
    for w in text.split():
        x = rnd.random()
        out += [] if x < rate / 2 else [w.upper() if x > 0.9 else w] + (["extra"] if x < rate else [])
    return rnd.choice([" ", "\n// ", "  "]).join(out)


def test_words_of_any_text(spark):
    texts = ["", "A-b_C\x00d\x7fÉé9", " \\ ' \" % ", "ﬁ ǅ İ MIT", "x" * 5000, "\x1c a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(licenses.text_words(licenses.F.col("t")).alias("w"))
    assert [r["w"] for r in df.collect()] == [plain_words(t) for t in texts]


@pytest.mark.parametrize("least", [0.9, 0.6])
def test_scan_equals_every_pair(make_docs, odd_rows, least):
    rows, n = list(odd_rows), 100
    for k, (_, notice) in enumerate(MORE):
        for seed, rate in enumerate((0.0, 0.05, 0.15, 0.3)):
            before, after = prose(n, (n * 7) % 90), prose(n + 1, (n * 13) % 200)
            rows.append((n, f"{before}\n{edited(notice, k * 10 + seed, rate)}\n{after}"))
            n += 1
    rows += [(n, "MIT License, MIT license mit LICENSE"), (n + 1, "General public\nLicense"), (n + 2, "license"), (n + 2, "license")]
    rows += [(n + 3 + i, "Hot copy. Released under the M.I.T. licence, or the MIT-License.") for i in range(40)]
    got = collections.Counter()
    for r in scan_licenses(make_docs(rows), MORE, least=least).collect():
        found = tuple((m["first_word"], m["end_word"], m["template"], m["label"], m["containment"]) for m in r["matches"])
        got[r["doc_id"], r["n_words"], tuple(map(tuple, r["places"])), tuple(r["labels"]), found, r["score"]] += 1
    assert got == collections.Counter((r[0], *by_loop(r[1], MORE, least)) for r in rows)
    assert sum(bool(x[4]) * c for x, c in got.items()) > 40
    assert scan_licenses(make_docs([]), least=least).count() == 0


def test_templates_are_bounded(make_docs):
    docs = make_docs([(1, "x")])
    with pytest.raises(ValueError):
        match_templates(docs, [("none", " - ")])
    with pytest.raises(ValueError):
        match_templates(docs, [("long", " ".join(f"w{i}" for i in range(licenses.MAX_TEMPLATE_WORDS + 1)))])


def test_native_plans(spark, make_docs, monkeypatch):
    """No Python on the way, in the steps that are written in between either."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(licenses, "materialize", seen)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plans.append(licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString())
    held = licenses.F.array_intersect(licenses._literal(["mit"]), licenses.text_words(licenses.F.col("text")))
    plans.append(docs.select(held)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", "".join(plans))
