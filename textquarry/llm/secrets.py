"""Secrets in text: fixed shapes first, then character Markov models.

Two first-order models over the characters of a token, one of random strings and one
of ordinary identifiers, are counted in Spark over labelled samples. A long token whose
log-likelihood ratio exceeds the prior odds against a secret is reported as ``markov``.

The samples come from the documents themselves. Random: the values that the fixed
shapes find, and the base64 and hexadecimal digests of every document. Ordinary: all
other tokens of all documents.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import slices, text_of

# The shapes, their kinds in order and their least lengths.
ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN_CHARS = string.ascii_letters + string.digits + "+/_=-"
STATES = len(TOKEN_CHARS) + 1  # state 0 stands for both ends of a token
MIN_TOKEN = 16
# Natural log of the odds against a long token being a secret.
PRIOR_LOG_ODDS = 14.0
# Observations that a character's general frequency counts for in each row of a model.
SMOOTHING = 5.0

_STATE = np.zeros(256, np.int64)
for _i, _c in enumerate(TOKEN_CHARS, 1):
    _STATE[ord(_c)] = _i
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[ord(c) for c in "0123456789abcdef"]] = True


def _bytes_of(text: str) -> np.ndarray:
    """One byte per code point; those above Latin-1 become a character of no token."""
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


def _runs(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of every maximal run of true values that is long enough."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= least
    return list(zip(starts[long_enough].tolist(), ends[long_enough].tolist()))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the fixed shapes, in order."""
    found = []
    lower = text.lower()
    # Case folding outside ASCII can only make this test succeed more often.
    if any(k in lower for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= MIN_ACCESS:
                found.append((m.start(), 1, m.end()))
    for start, end in _runs(_IS_HEX[_bytes_of(text)], MIN_HEX):
        found.append((start, 2, end))
    found.sort()
    return found


def _pair_counts(states: np.ndarray) -> np.ndarray:
    padded = np.concatenate(([0], states, [0]))
    return np.bincount(padded[:-1] * STATES + padded[1:], minlength=STATES * STATES)


def sample_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character pairs in a document's ordinary and in its random samples."""
    states = _STATE[_bytes_of(text)]
    random = []
    for start, kind, end in base_spans(text):
        value = text[start:end]
        random.append(ASSIGN.match(value)[2] if kind == 0 else value)
        states[start:end] = 0
    digest = hashlib.sha256(text.encode("utf-8", "replace")).digest()
    random += [base64.b64encode(digest[:24]).decode(), base64.urlsafe_b64encode(digest[8:]).decode(), digest.hex()]
    return _pair_counts(states), _pair_counts(_STATE[_bytes_of(" ".join(random))])


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The log-likelihood ratio of every character pair, random over ordinary.

    Counts cover all documents; what reaches the driver is one number per pair and label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STATES * STATES), np.int64)
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                ordinary, random = sample_counts(text)
                counts[0] += ordinary
                counts[1] += random
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(counts[label, pair])],
            names=["label", "pair", "n"],
        )

    rows = (
        docs.select(text_of(text_col).alias("text"))
        .mapInArrow(run, "label int, pair int, n bigint")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, STATES, STATES))
    for label, pair, n in rows:
        counts[label, pair // STATES, pair % STATES] += n
    return log_ratio(counts)


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios from pair counts; rare rows lean on how common the next character is."""
    counts = counts.copy()
    counts[:, 0, 0] = 0  # gaps between tokens say nothing
    single = counts.sum(axis=1) + 0.5
    single /= single.sum(axis=1, keepdims=True)
    smooth = counts + SMOOTHING * single[:, None, :]
    logs = np.log(smooth / smooth.sum(axis=2, keepdims=True))
    ratio = logs[1] - logs[0]
    ratio[0, 0] = 0.0
    return ratio


def all_spans(text: str, ratio: np.ndarray, log_odds: float = PRIOR_LOG_ODDS) -> list[tuple[int, int, int]]:
    """Base spans, and long tokens outside them that look random."""
    found = base_spans(text)
    states = _STATE[_bytes_of(text)]
    candidates = _runs(states > 0, MIN_TOKEN)
    if candidates:
        covered = np.zeros(len(states), bool)
        for start, _, end in found:
            covered[start:end] = True
        for start, end in candidates:
            if covered[start:end].any():
                continue
            token = np.concatenate(([0], states[start:end], [0]))
            if ratio[token[:-1], token[1:]].sum() >= log_odds:
                found.append((start, 3, end))
        found.sort()
    return found


def describe(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame, ratio: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, counts of the base shapes, and the text forms of base and all spans.

    One row per row of ``docs``. A NULL or empty text has no spans. ``ratio`` is a
    model from ``train``; without one it is trained on ``docs``.
    """
    model = train(docs, text_col) if ratio is None else ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: list[tuple] = []
            for text in part.column(1).to_pylist():
                spans = all_spans(text, model)
                base = [s for s in spans if s[1] < 3]
                kinds = [s[1] for s in base]
                out.append((kinds.count(0), kinds.count(1), kinds.count(2), describe(base), describe(spans)))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [part.column(0)]
                + [pa.array(c, pa.int64()) for c in columns[:3]]
                + [pa.array(c, pa.string()) for c in columns[3:]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = T.StructType(
        [source.schema["doc_id"]]
        + [T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")]
        + [T.StructField(c, T.StringType()) for c in ("base_spans", "spans")]
    )
    return source.mapInArrow(run, schema)


def masker(ratio: np.ndarray, mark: str = "[SECRET]") -> Callable:
    """A column function that replaces every span of a text by ``mark``."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if text is None:
                return None
            pieces, at = [], 0
            for start, _, end in all_spans(text, ratio):
                if start >= at:
                    pieces += [text[at:start], mark]
                at = max(at, end)
            return "".join(pieces) + text[at:] if pieces else text

        return texts.map(one, na_action=None).astype(object)

    return mask


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced; the length column, if there is one, follows."""
    masked = docs.withColumn(text_col, masker(train(docs, text_col))(F.col(text_col)))
    if length_col in docs.columns:
        masked = masked.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return masked.select(docs.columns)
