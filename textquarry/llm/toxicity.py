"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on the passages of toxic
documents that set them apart (words whose share of toxic documents is surely higher
than their share of ordinary ones), one on ordinary text. Every window of a text is
compressed with both. A window counts as toxic if the toxic dictionary saves more bytes
than it does for all but a small share of ordinary windows of the same length; a
logistic curve turns the toxic windows of a document into a probability. Thresholds and
curve are calibrated on labelled documents that no dictionary has seen.

Fitting uses a bounded sample (``SAMPLE_PER_LABEL`` documents a label); scoring reads
every text whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import id_crc, materialize, slices, text_of

SAMPLE_PER_LABEL = 5_000
WINDOW_WORDS = 1
# A telling word: least share of toxic documents, least log ratio of the two shares.
LEAST_SHARE, LEAST_RATIO, SURENESS = 0.01, 2.0, 2.0
MOST_TELLING = 2_000
ORDINARY_PASSAGES = 20_000
PASSAGE_WORDS = 8
ORDINARY_BYTES = 65_536
LEVEL = 3
# Windows are counted by length (the last class is open) and by bytes saved (both ends are).
LENGTHS, LEAST_SAVED, MOST_SAVED = 20, -12, 19
SAVED = MOST_SAVED - LEAST_SAVED + 1
# Shares of ordinary windows that a threshold may let through, and sizes of the toxic
# dictionary over its text, from which calibration chooses.
TAILS = (1 / 300, 1 / 1_000, 1 / 3_000, 1 / 10_000)
TOXIC_SIZES = (2, 4, 8)
CACHED_WINDOWS = 300_000

# Both dictionaries and every window end in these bytes: zstandard stores very short
# inputs as they are and looks for no match in the last bytes of an input.
LEAD_OUT = b"0123456789ABCDEF0123456789abcdef"

_WORD = re.compile(r"[^\W\d_]+")


def windows(text: str, words: int = WINDOW_WORDS) -> list[str]:
    found = _WORD.findall(text.lower())
    return found if words == 1 else [" ".join(found[i : i + words]) for i in range(0, len(found), words)]


@dataclass
class ToxicModel:
    toxic: bytes
    ordinary: bytes
    thresholds: tuple[int, ...]  # least cell of SAVED that counts, by length
    curve: tuple[float, float, float]  # intercept, log hits, log hit rate


class Savings:
    """Bytes that the toxic dictionary saves over the ordinary one, window by window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.compressors = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d + LEAD_OUT), compression_params=parameters
            )
            if d
            else None
            for d in (toxic, ordinary)
        ]
        self.seen: dict[str, int] = {}

    def of(self, window: str) -> int:
        saved = self.seen.get(window)
        if saved is None:
            toxic, ordinary = self.compressors
            if toxic is None or ordinary is None:
                return 0
            raw = f" {window} ".encode("utf-8", "replace") + LEAD_OUT
            saved = len(ordinary.compress(raw)) - len(toxic.compress(raw))
            if len(self.seen) >= CACHED_WINDOWS:
                self.seen.clear()
            self.seen[window] = saved
        return saved

    def cells(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Length and savings class of every window."""
        found = windows(text)
        length = np.fromiter(map(len, found), np.int64, len(found))
        saved = np.fromiter(map(self.of, found), np.int64, len(found))
        return np.minimum(length, LENGTHS) - 1, np.clip(saved, LEAST_SAVED, MOST_SAVED) - LEAST_SAVED

    def hits(self, text: str, thresholds: np.ndarray) -> tuple[int, int]:
        """Toxic windows and all windows."""
        length, saved = self.cells(text)
        return int((saved >= thresholds[length]).sum()), len(length)


_LOADED: dict[tuple[bytes, bytes], Savings] = {}


def _savings(toxic: bytes, ordinary: bytes) -> Savings:
    """One per Python worker and pair of dictionaries."""
    if (toxic, ordinary) not in _LOADED:
        _LOADED.clear()
        _LOADED[toxic, ordinary] = Savings(toxic, ordinary)
    return _LOADED[toxic, ordinary]


def _features(hits: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(hits)), np.log1p(hits), np.log1p(1000.0 * hits / np.maximum(total, 1))])


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method: coefficients and log loss."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([0.0, *[ridge] * (x.shape[1] - 1)]) + 1e-9 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w)), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), 1e-9, 1 - 1e-9)
    return w, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or nothing if the samples are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=48, d=6).as_bytes()
    except zstandard.ZstdError:
        return b""


def _learning_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """At most about ``per_label`` labelled texts of each label, drawn by a hash of the id.

    The hash also deals them out: ``part`` 0 to 2 train dictionaries, 3 and 4 calibrate.
    """
    counts = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_label / n))])
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20))
    # Bounded by ``per_label``: safe to broadcast.
    chosen = labels.where(draw < share[F.col("label")] * (1 << 20)).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(5)).cast("int")
    )
    return materialize(docs.join(F.broadcast(chosen), "id"), "toxicity-sample")


def _telling_words(sample: DataFrame) -> list[tuple[str, int]]:
    """Words that are surely more common in toxic documents, and in how many they are."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    rows = sample.where("part < 3").select("label", words.alias("words"))
    totals = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    toxic, ordinary = (float(t or 0) for t in totals)
    if not toxic or not ordinary:
        return []
    counted = (
        rows.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
        .where(F.col("t") >= max(3.0, LEAST_SHARE * toxic))
    )
    ratio = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("o") + 0.5) / (ordinary + 1))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    sure = ratio - SURENESS * error
    found = counted.where(sure > LEAST_RATIO).orderBy(sure.desc(), "word").limit(MOST_TELLING)
    return [(r["word"], r["t"]) for r in found.collect()]


def _histograms(sample: DataFrame, toxic: bytes, ordinary: bytes) -> list:
    """``id, label, cells`` of each calibrating text: its windows by length and savings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings = _savings(toxic, ordinary)
        for part in slices(batches):
            found = []
            for text in part.column("text").to_pylist():
                length, saved = savings.cells(text)
                found.append(np.bincount(length * SAVED + saved, minlength=LENGTHS * SAVED).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").cast(pa.string()), part.column("label"), pa.array(found, pa.list_(pa.int32()))],
                names=["id", "label", "cells"],
            )

    rows = sample.where("part >= 3").select("id", "label", "text")
    # Bounded by the sample.
    return rows.mapInArrow(run, "id string, label int, cells array<int>").collect()


def _thresholds(ordinary: np.ndarray, tail: float) -> np.ndarray:
    """By length, the least savings class that at most ``tail`` of the ordinary windows reach."""
    reached = ordinary[:, ::-1].cumsum(axis=1)[:, ::-1]
    few = reached <= tail * reached[:, :1]
    # From the last class down, as far as it holds; an empty class holds.
    return SAVED - few[:, ::-1].cumprod(axis=1).sum(axis=1)


def _calibrate(held: list) -> tuple[float, np.ndarray, np.ndarray]:
    """Log loss, thresholds and curve of the best tail."""
    held = sorted(held, key=lambda r: (r["id"], r["label"]))
    y = np.array([r["label"] for r in held], float)
    cells = np.array([r["cells"] for r in held], np.int32).reshape(-1, LENGTHS, SAVED)
    total, best = cells.sum(axis=(1, 2)), None
    for tail in TAILS:
        thresholds = _thresholds(cells[y == 0].sum(axis=0), tail)
        counted = np.arange(SAVED) >= thresholds[:, None]
        curve, loss = _fit_curve(_features((cells * counted).sum(axis=(1, 2)), total), y)
        if best is None or loss < best[0]:
            best = (loss, thresholds, curve)
    return best


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = SAMPLE_PER_LABEL,
) -> ToxicModel:
    """Learn from the labelled rows; labels other than 0 and 1 and NULL ids are ignored.

    Without both labels the model gives every text the share of label 1.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .distinct()
    )
    known = materialize(known, "toxicity-labels")
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return _constant(10.0 if sizes.get(1) else -10.0)
    sample = _learning_sample(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), known, per_label)

    telling = _telling_words(sample)
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    passages = (
        sample.where("part < 3 and label = 0")
        .select(words.alias("words"))
        .select(
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(PASSAGE_WORDS)),
                    lambda i: F.array_join(F.slice("words", i, PASSAGE_WORDS), " "),
                )
            ).alias("passage")
        )
        .orderBy(F.xxhash64("passage"), "passage")
        .limit(ORDINARY_PASSAGES)
    )
    ordinary = _train_dictionary([f" {r[0]} ".encode() for r in passages.collect()], ORDINARY_BYTES)
    # Every telling word is as often in the samples as any other, next to changing words.
    rng = np.random.default_rng(11)
    terms = [w for w, _ in telling]
    mixed = [" " + " ".join(terms[i] for i in rng.permutation(len(terms))) + " " for _ in range(200)] if terms else []
    best = None
    for size in TOXIC_SIZES if mixed else ():
        toxic = _train_dictionary([m.encode() for m in mixed], max(512, size * len(mixed[0].encode())))
        if not toxic or not ordinary:
            continue
        held = _histograms(sample, toxic, ordinary)
        if len({r["label"] for r in held}) == 2:
            loss, thresholds, curve = _calibrate(held)
            if best is None or loss < best[0]:
                best = (loss, ToxicModel(toxic, ordinary, tuple(thresholds.tolist()), tuple(curve.tolist())))
    return best[1] if best else _constant(float(np.log(sizes[1] / sizes[0])))


def _constant(log_odds: float) -> ToxicModel:
    return ToxicModel(b"", b"", (SAVED,) * LENGTHS, (log_odds, 0.0, 0.0))


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row; a NULL or empty text has no toxic window."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings, thresholds = _savings(model.toxic, model.ordinary), np.array(model.thresholds)
        for part in slices(batches):
            found = np.array([savings.hits(t, thresholds) for t in part.column(1).to_pylist()], float).reshape(-1, 2)
            x = _features(found[:, 0], found[:, 1])
            p = 1 / (1 + np.exp(-np.clip(x @ np.array(model.curve), -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p)], names=["doc_id", "score"])

    return source.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", fold: int = 0, folds: int = 5) -> Column:
    """Rows that the toxicity model never learns from."""
    return id_crc(id_col) % folds == fold


def rate_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: learn from the rows not held out, score all."""
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
