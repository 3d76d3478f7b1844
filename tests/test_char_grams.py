"""Language identification (M5) by n-grams counted in numpy: the numbers of Spark ML, texts read once."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IDF, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textquarry.operators import char_grams as CG
from textquarry.operators import quality as Q

ROWS = "doc_id int, text string, lang string"
FEATURES = 1 << 10


def made():
    rng = random.Random(3)
    letters = {"en": "abcdefghij", "fr": "abcdéèàçœ", "zh": "的一是不了人我在有他这", "el": "αβγδς_'"}
    rows = [(lang, " ".join("".join(rng.choices(abc, k=rng.randint(1, 7))) for _ in range(rng.randint(1, 30)))) for lang, abc in letters.items() for _ in range(25)]
    odd = ["", " \t\n", "A", "É", "x😀y 😀", "İSTANBUL ΣΑΣ a b", "\x0bq\x0c\rw\n", "_ __ a_b", "é\u0000f", "\U0010ffff퟿", "a" * 3000]
    return [(i, t, lang) for i, (lang, t) in enumerate([*rows, *zip(["en", "fr"] * 9, odd)])]


def by_spark_ml(df):
    stages = [
        StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc"), HashingTF(inputCol="grams", outputCol="tf", numFeatures=FEATURES),
        IDF(inputCol="tf", outputCol="features"), NaiveBayes(modelType="multinomial"),
    ]
    cut = df.withColumn("grams", Q.char_ngrams(F.col("text")))
    model = Pipeline(stages=stages).fit(cut)
    found = model.transform(cut).select("doc_id", vector_to_array("probability").alias("p")).collect()
    return {r.doc_id: max((p, name) for p, name in zip(r.p, model.stages[0].labels)) for r in found}


def test_agrees_with_spark_ml(spark):
    df = spark.createDataFrame(made(), ROWS).repartition(3)
    found = Q.identify_language(df, Q.train_language_model(df, features=FEATURES))
    got = {r.doc_id: (r.language_score, r.language_id) for r in found.collect()}
    want = by_spark_ml(df)
    assert got.keys() == want.keys()
    assert all(got[i][1] == want[i][1] and got[i][0] == pytest.approx(want[i][0], rel=1e-9) for i in want)


def test_texts_are_read_once_to_learn_and_once_to_tell(spark):
    """Learning read every text twice, and n-grams were cut by regular expressions each time."""
    rows, read = made(), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        read.add(1)
        return text

    df = spark.createDataFrame(rows, ROWS).select("doc_id", "lang", told("text").alias("text"))
    model = Q.train_language_model(df, features=FEATURES)
    assert read.value == len(rows)
    kept = Q.filter_language(Q.identify_language(df, model), ["fr", "zh"])
    assert kept.count() > 40 and read.value == 2 * len(rows)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and plan.count("found(") == 1


def test_missing_texts_and_languages(spark):
    rows = [*made(), (900, None, "en"), (901, made()[0][1], None), (902, None, None)]
    df = spark.createDataFrame(rows, ROWS)
    model, whole = Q.train_language_model(df, features=FEATURES), Q.train_language_model(df.where("doc_id < 900"), features=FEATURES)
    assert model.labels == whole.labels and (model.weights == whole.weights).all() and (model.priors == whole.priors).all()
    found = {r.doc_id: r for r in Q.identify_language(df, model).collect()}
    assert len(found) == len(rows) and found[901].language_id == "en"
    assert [found[i][3:] for i in (900, 902)] == [(None, None)] * 2
    # Nothing to learn from: no language is told.
    none = Q.train_language_model(df.where("doc_id > 900"), features=FEATURES)
    assert Q.identify_language(df, none).where("language_id IS NOT NULL OR language_score IS NOT NULL").count() == 0


def test_small_blocks_and_windows_change_nothing(monkeypatch):
    rows = made()
    batches = [pa.RecordBatch.from_pydict({"lang": [r[2] for r in part], "text": [r[1].lower() for r in part]}) for part in (rows[:40], rows[40:40], rows[40:])]

    def both():
        model = CG.model_of(pa.Table.from_batches(CG.counted(iter(batches), FEATURES)), FEATURES)
        return model, CG.identified([r[1].lower() for r in rows], model)

    model, found = both()
    for sizes in ({"BLOCK_CHARS": 50, "WINDOW": 7}, {"BLOCK_FLAGS": 3 * FEATURES, "WINDOW": 1}, {"TABLE": 0}):
        for name, size in sizes.items():
            monkeypatch.setattr(CG, name, size)
        again, told = both()
        assert (again.weights == model.weights).all() and told.language_id.tolist() == found.language_id.tolist()
        assert np.allclose(told.language_score, found.language_score, rtol=1e-9)
        monkeypatch.undo()
    monkeypatch.setattr(CG, "BLOCK_CHARS", 50)
    long = max((r[1] for r in rows[:100]), key=len)
    assert len(list(CG.pieces(long))) > 1 and " ".join(CG.pieces(long)) == long and list(CG.pieces("a" * 99)) == ["a" * 99]
