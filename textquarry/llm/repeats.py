"""Repeated passages by anchored windows.

Anchors are winnowed: of every window of ``window`` words, the word ``GRAM``-gram with the
least hash is an anchor, so equal windows have an equal anchor at an equal place.
Documents meet on anchors; one that occurs once in the corpus cannot lie in a repeat
and is dropped. No pair of documents is extended word by word: every whole window with
a shared anchor is hashed and held against its first occurrence, which avoids all pairs
on hot anchors. The words of windows that occur earlier somewhere else are removed.

Neither a frequent anchor nor a frequent window gathers its occurrences anywhere. Both
are aggregates with one row for each key; what goes back to the documents is only where
an anchor is the single one, and where a window occurs first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import WORD, materialize, mix64, slices, text_of
from textquarry.llm.global_order import global_order

WINDOW = 20
GRAM = 8
_BASE = 0x9E3779B97F4A7C15


class Passages:
    """The words of some documents side by side, and the windows inside each."""

    def __init__(self, texts: list[str], window: int):
        self.window = window
        self.words = [WORD.findall(t) for t in texts]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.offsets = np.concatenate(([0], self.lengths.cumsum()))
        flat = np.empty(self.offsets[-1], object)
        flat[:] = list(chain.from_iterable(self.words))
        hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
        self.powers = {1: mix64(hashes)}
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        at = np.arange(len(flat)) - self.offsets[self.doc]
        #: Flat word positions where a window starts, in order.
        self.starts = np.flatnonzero(at + window <= self.lengths[self.doc])

    def grams(self, width: int) -> np.ndarray:
        """A hash of the ``width`` words from each position (also across documents)."""
        if width not in self.powers:
            half = 1 << (width - 1).bit_length() - 1
            rest = width - half
            left, right = self.grams(half), self.grams(rest)
            n = max(0, len(self.powers[1]) - width + 1)
            factor = np.uint64(pow(_BASE, rest, 1 << 64))
            self.powers[width] = left[:n] * factor + right[half : half + n]
        return self.powers[width]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window its anchor's hash and flat position (the leftmost of equal ones)."""
        span = self.window - GRAM + 1
        gram = mix64(self.grams(GRAM))
        least, width = gram, 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        value = np.minimum(least[self.starts], least[self.starts + span - width])
        place = self.starts + span - 1
        for back in range(span - 2, -1, -1):
            place = np.where(gram[self.starts + back] == value, self.starts + back, place)
        return value, place

    def mark(self, lists: list[list[int] | None]) -> np.ndarray:
        """True at the given places of each document."""
        marked = np.zeros(self.offsets[-1], bool)
        for row, places in enumerate(lists):
            if places is not None and len(places):
                marked[self.offsets[row] + np.asarray(places, np.int64)] = True
        return marked

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """True for each word inside a window that starts at one of the flat positions."""
        edges = np.zeros(self.offsets[-1] + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + self.window, -1)
        return edges[:-1].cumsum() > 0

    def kept(self, row: int, removed: np.ndarray) -> tuple[int, str]:
        """Words removed from a document, and the text that stays."""
        gone = removed[self.offsets[row] : self.offsets[row + 1]]
        words = self.words[row]
        return int(gone.sum()), " ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def _anchor_rows(keyed: DataFrame, window: int) -> DataFrame:
    """``anchor, _d, _t, at``: every anchor of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            passages = Passages(part.column("text").to_pylist(), window)
            value, place = passages.anchors() if len(passages.starts) else (np.zeros(0, np.uint64),) * 2
            doc = passages.doc[passages.starts]
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
            doc, place = doc[new], place[new].astype(np.int64)
            key, tie = (part.column(c).to_numpy(zero_copy_only=False)[doc] for c in ("_d", "_t"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[new].view(np.int64)), pa.array(key), pa.array(tie), pa.array(place - passages.offsets[doc])],
                names=["anchor", "_d", "_t", "at"],
            )

    return keyed.mapInArrow(run, "anchor bigint, _d bigint, _t bigint, at bigint")


def _document_order(keyed: DataFrame) -> tuple[DataFrame, int]:
    """``_d, _t, _ord, _copy`` of each document, and the bits that hold any word position.

    ``_ord`` numbers documents in order; ``_copy`` marks those whose text an earlier one has.
    """
    digests = [F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), F.col("text")).alias("_h2")]
    narrow = keyed.select("_d", "_t", F.length("text").cast("bigint").alias("_chars"), *digests)
    written = materialize(
        narrow.groupBy("_d", "_t").agg(*[F.min(c).alias(c) for c in ("_chars", "_h1", "_h2")]), "documents"
    )
    longest = written.agg(F.max("_chars")).first()[0] or 0
    ordered = materialize(
        global_order(written, ["_d", "_t"], "_chars").select("_d", "_t", "_h1", "_h2", F.col("_row").alias("_ord")),
        "document-order",
    )
    texts = ordered.groupBy("_h1", "_h2").agg(F.min("_ord").alias("_first"), F.count("*").alias("_n"))
    # Written, so that a text with very many copies meets a table it can be split against.
    copied = materialize(texts.where("_n > 1").drop("_n"), "copied-texts")
    marked = ordered.join(copied, ["_h1", "_h2"], "left").select(
        "_d", "_t", "_ord", F.coalesce(F.col("_ord") > F.col("_first"), F.lit(False)).alias("_copy")
    )
    return marked, max(1, int(longest).bit_length())


def _settle(joined: DataFrame, id_field: T.StructField, window: int) -> DataFrame:
    """Finish the documents that share no anchor and the copies; keep the texts of the rest."""
    fields = [
        T.StructField("doc_id", id_field.dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("_ord", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("single", T.ArrayType(T.LongType())),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts, singles = part.column("text").to_pylist(), part.column("single").to_pylist()
            passages = Passages(texts, window)
            single = passages.mark(singles)
            shared = np.zeros(part.num_rows, bool)
            if len(passages.starts):
                _, place = passages.anchors()
                shared[passages.doc[passages.starts[~single[place]]]] = True
            removed, kept = [], []
            for row, copy in enumerate(part.column("_copy").to_pylist()):
                words = passages.words[row]
                if copy and len(words) >= window:
                    removed.append(len(words))
                    kept.append("")
                    shared[row] = False
                elif shared[row]:
                    removed.append(None)
                    kept.append(None)
                else:
                    removed.append(0)
                    kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(passages.lengths),
                    pa.array(removed, pa.int64()),
                    pa.array([None if k is None else _digest(k) for k in kept], pa.string()),
                    part.column("_ord"),
                    pa.array([t if s else None for t, s in zip(texts, shared)], pa.string()),
                    pa.array([x if s else None for x, s in zip(singles, shared)], pa.list_(pa.int64())),
                ],
                names=[f.name for f in fields],
            )

    return joined.select("doc_id", "text", "_ord", "_copy", "single").mapInArrow(run, T.StructType(fields))


def _shared_windows(pending: DataFrame, window: int, bits: int) -> DataFrame:
    """``anchor, words, position``: every window that a shared anchor extends to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            passages = Passages(part.column("text").to_pylist(), window)
            value, place = passages.anchors()
            shared = ~passages.mark(part.column("single").to_pylist())[place]
            starts = passages.starts[shared]
            doc = passages.doc[starts]
            order = part.column("_ord").to_numpy(zero_copy_only=False).astype(np.int64)
            position = (order[doc] << bits) | (starts - passages.offsets[doc])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value[shared].view(np.int64)),
                    pa.array(mix64(passages.grams(window)[starts]).view(np.int64)),
                    pa.array(position),
                ],
                names=["anchor", "words", "position"],
            )

    return pending.select("text", "single", "_ord").mapInArrow(run, "anchor bigint, words bigint, position bigint")


def _remove(pending: DataFrame, id_field: T.StructField, window: int) -> DataFrame:
    """Take the repeats out of documents whose first occurrences (``first``) are known."""
    schema = T.StructType(
        [
            T.StructField("doc_id", id_field.dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            passages = Passages(part.column("text").to_pylist(), window)
            _, place = passages.anchors()
            single = passages.mark(part.column("single").to_pylist())
            first = passages.mark(part.column("first").to_pylist())
            repeated = passages.starts[~single[place] & ~first[passages.starts]]
            removed = passages.covered(repeated)
            found = [passages.kept(row, removed) for row in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(passages.lengths),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([_digest(text) for _, text in found], pa.string()),
                ],
                names=schema.names,
            )

    return pending.select("doc_id", "text", "single", "first").mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: what is left of each row, as the digest of its words.

    Documents are ordered by their integer id; NULL ids come last. Rows that share an id
    but not the text are documents of their own, ordered by a hash of the text; rows
    equal in both are one document and get equal results. Texts under ``window`` words
    (NULL, empty) keep all they have.
    """
    if window < GRAM:
        raise ValueError(f"window must have at least {GRAM} words")
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_field = source.schema["doc_id"]
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    repeated_ids = docs.select(F.col(id_col).alias("doc_id")).groupBy(key.alias("_d")).count().where("count > 1")
    distinct_ids = repeated_ids.isEmpty()
    tie = F.lit(0).cast("bigint") if distinct_ids else F.xxhash64("text")
    keyed = source.select("doc_id", key.alias("_d"), tie.alias("_t"), "text")

    order, bits = _document_order(keyed)
    counted = _anchor_rows(keyed, window).groupBy("anchor").agg(
        # Rows equal in id and text are one document.
        (F.count("*") if distinct_ids else F.count_distinct("_d", "_t", "at")).alias("n"),
        F.min("_d").alias("_d"),
        F.min("_t").alias("_t"),
        F.min("at").alias("at"),
    )
    single = counted.where("n = 1").groupBy("_d", "_t").agg(F.collect_list("at").alias("single"))
    facts = materialize(order.join(single, ["_d", "_t"], "left"), "document-facts")
    settled = materialize(_settle(keyed.join(facts, ["_d", "_t"]), id_field, window), "settled")

    pending = settled.where(F.col("text").isNotNull())
    first = (
        _shared_windows(pending, window, bits)
        .groupBy("anchor", "words")
        .agg(F.min("position").alias("position"))
        .groupBy(F.shiftright("position", bits).alias("_ord"))
        .agg(F.collect_list(F.col("position").bitwiseAND((1 << bits) - 1)).alias("first"))
    )
    removed = _remove(pending.join(first, "_ord", "left"), id_field, window)
    finished = settled.where(F.col("text").isNull()).select("doc_id", "n_words", "n_removed", "kept")
    return finished.unionByName(removed)
