"""Language identification: sparse multinomial logistic regression on character n-grams.

N-grams of one to three characters are hashed into a fixed number of features and
weighted by TF-IDF. Document frequencies cover all learning rows. The weights are
learned with follow-the-regularized-leader and an elastic-net penalty on a bounded
sample (``SAMPLE_PER_LANGUAGE`` rows a language), and a temperature fitted on sample
rows left out of the fit turns scores into probabilities. Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import id_crc, materialize, slices, text_of

FEATURES = 1 << 15
SAMPLE_PER_LANGUAGE = 2_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
BLOCK = 1 << 16

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    return _LETTERS[0]


def gram_counts(text: str) -> np.ndarray:
    """How often each feature occurs: n-grams of the lower-case text, other characters as one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.ones(len(codes), bool)
    basic = codes < (1 << 16)
    letter[basic] = _letters()[codes[basic]]
    codes = np.where(letter, codes, 32)
    keep = letter | np.concatenate(([False], letter[:-1]))
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    counts = np.zeros(FEATURES, np.int64)
    for start in range(0, len(codes), BLOCK):
        block = codes[start : start + BLOCK + 2]
        grams, packed = [block[:BLOCK]], block
        for n in (2, 3):
            packed = (packed[:-1] << np.uint64(21)) | block[n - 1 :]
            grams.append(packed[:BLOCK])
        for n, gram in enumerate(grams, 1):
            slot = ((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
            counts += np.bincount(slot.astype(np.int64), minlength=FEATURES)
    return counts


def _weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    slots = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[slots])) * idf[slots]
    norm = np.sqrt((values * values).sum())
    return slots, values / norm if norm else values


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many rows of the column ``text`` each feature occurs; the last entry counts rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FEATURES + 1, np.int64)
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                found[:-1] += gram_counts(text) > 0
                found[-1] += 1
        slots = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots.astype(np.int32)), pa.array(found[slots])], names=["slot", "n"]
        )

    total = np.zeros(FEATURES + 1, np.int64)
    # At most one row per feature.
    for slot, n in texts.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n")).collect():
        total[slot] = n
    return total


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights (classes x features, the last column is the intercept) by FTRL-proximal."""
    z = np.zeros((classes, FEATURES + 1))
    n = np.zeros_like(z)
    l1 = np.full(FEATURES + 1, L1)
    l1[-1] = 0.0
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            slots, values, label = rows[i]
            slots, values = np.append(slots, FEATURES), np.append(values, 1.0)
            zs, ns = z[:, slots], n[:, slots]
            w = _weights(zs, ns, l1[slots])
            gradient = _softmax(w @ values)
            gradient[label] -= 1.0
            g = gradient[:, None] * values
            squares = ns + g * g
            z[:, slots] = zs + g - (np.sqrt(squares) - np.sqrt(ns)) / ALPHA * w
            n[:, slots] = squares
    return _weights(z, n, l1)


def _weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its log."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(scaled - top).sum(axis=1))
        return float((norm - scaled[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        slots, values = _weigh(gram_counts(text), self.idf)
        p = _softmax((self.weights[:, slots] @ values + self.weights[:, -1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def train(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from the rows with a language; others are ignored.

    The sample takes the rows of a language with the smallest share of id hashes that
    holds about ``per_language`` rows; it is fitted in one task. Without a learning row the
    model knows no language.
    """
    labelled = rows.select(
        F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull())
    counts = {lang: n for lang, n in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.ones(FEATURES), np.zeros((0, FEATURES + 1)), 1.0)
    found = document_frequencies(labelled.select("text"))
    idf = 1.0 + np.log((1.0 + found[-1]) / (1.0 + found[:-1]))

    share = F.create_map(
        *[F.lit(v) for lang in languages for v in (lang, min(1.0, per_language / counts[lang]))]
    )
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("sample")), F.lit(1 << 20))
    sample = labelled.where(draw < share[F.col("lang")] * (1 << 20))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            slots, values = [], []
            for text in part.column(1).to_pylist():
                s, v = _weigh(gram_counts(text), idf)
                slots.append(s.astype(np.int32))
                values.append(v.astype(np.float32))
            labels = [languages.index(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.string()),
                    pa.array(slots, pa.list_(pa.int32())),
                    pa.array(values, pa.list_(pa.float32())),
                    pa.array(labels, pa.int32()),
                ],
                names=["id", "slots", "values", "label"],
            )

    shape = "id string, slots array<int>, values array<float>, label int"
    drawn = materialize(sample.mapInArrow(features, shape), "language-sample")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for key, slots, values, label in zip(*[batch.column(i) for i in range(4)]):
                s, v = slots.values.to_numpy(), values.values.to_numpy()
                rows.append((key.as_py() or "", s.astype(np.int64), v.astype(np.float64), label.as_py()))
        rows.sort(key=lambda r: (r[0], r[3], len(r[1])))
        rest = [r[1:] for i, r in enumerate(rows) if i % 5 == 0]
        learn = [r[1:] for i, r in enumerate(rows) if i % 5] or rest
        weights = fit_ftrl(learn, len(languages))
        logits = np.array([weights[:, s] @ v + weights[:, -1] for s, v, _ in rest]).reshape(-1, len(languages))
        temperature = fit_temperature(logits, np.array([y for _, _, y in rest], int))
        used = np.flatnonzero(np.abs(weights).sum(axis=0))
        slots = np.append(used, -1)
        table = np.vstack([weights[:, used].T, np.full((1, len(languages)), temperature)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots.astype(np.int32)), pa.array(list(table), pa.list_(pa.float64()))],
            names=["slot", "weights"],
        )

    weights = np.zeros((len(languages), FEATURES + 1))
    temperature = 1.0
    # At most one row per feature.
    for slot, column in drawn.repartition(1).mapInArrow(fit, "slot int, weights array<double>").collect():
        if slot < 0:
            temperature = column[0]
        else:
            weights[:, slot] = column
    return LanguageModel(languages, idf, weights, temperature)


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; ``und`` with score 0 for texts without a letter."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [shared.value.predict(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    schema = T.StructType(
        [source.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return source.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4):
    """Rows that the language model never learns from."""
    return id_crc(id_col) % folds == fold


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learn from the rows not held out, predict all."""
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    return predict(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, min_score: float = 0.4) -> DataFrame:
    """The rows of ``docs`` with a predicted language of at least ``min_score``.

    The decision depends on the text alone, so rows that share a text share it.
    """
    model = train(docs.where(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        found = [shared.value.predict(t) for t in texts]
        return pd.Series([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return docs.where(accepted(text_of("text")))
