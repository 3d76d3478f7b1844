"""Maximal periodic runs of words, by uniting suffix classes from the longest common prefix down.

A run is a stretch of consecutive words that repeats with its smallest period ``q`` and that
no neighbouring word extends. The suffixes of a document are sorted; neighbours in that
order are edges weighted by their longest common prefix (LCP). Going down from the largest
LCP, Kruskal's way, each edge unites two classes of suffixes; a class keeps its positions in
order. Two positions that become neighbours within a class when it is united at LCP ``l``
share exactly ``l`` words, so at a distance ``q`` of at most ``l`` they begin a repetition
of ``q + l`` words with period ``q`` that cannot be extended to the right. No position of
the class lies between them, so no smaller period exists. It is a run if it cannot be
extended to the left either, and every run is met once, at its first word and the word one
period later, which share no more and no less.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import WORD, mix64, slices, text_of

MIN_LENGTH = 6
MIN_EXPONENT = 4

_BLOCK = 1024
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Positions:
    """An ordered set of numbers in blocks, so that a member enters a large set cheaply."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, only: int):
        self.blocks, self.firsts, self.size = [[only]], [only], 1

    def around(self, x: int) -> tuple[int, int]:
        """The members next to ``x``, which isn't one; -1 where there is none."""
        at = bisect_right(self.firsts, x) - 1
        if at < 0:
            return -1, self.firsts[0]
        block = self.blocks[at]
        k = bisect_right(block, x)
        if k < len(block):
            return block[k - 1], block[k]
        return block[k - 1], self.firsts[at + 1] if at + 1 < len(self.firsts) else -1

    def add(self, x: int) -> None:
        at = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[at]
        insort(block, x)
        self.firsts[at] = block[0]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[at : at + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.firsts.insert(at + 1, block[_BLOCK])

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.blocks)


def repeated(codes: np.ndarray, width: int) -> np.ndarray:
    """The positions at which a stretch of ``width`` words begins that occurs twice or more.

    Stretches are compared by hash: a collision adds a position, none is ever missed.
    """
    n = len(codes) - width + 1
    if n < 2:
        return np.zeros(0, np.int64)
    values = mix64(codes.astype(np.uint64) + np.uint64(1))
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = mix64(mixed * _STEP + values[k : k + n])
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.flatnonzero(np.isin(mixed, twice)) if len(twice) else np.zeros(0, np.int64)


def suffix_ranks(codes: np.ndarray) -> list[np.ndarray]:
    """By doubling: item ``k`` ranks the positions by the ``2**k`` words that begin there.

    A text's end ranks before every word, so equal ranks mean equal words, and the last
    item has no ties.
    """
    n, width = len(codes), 1
    ranks = [np.unique(codes, return_inverse=True)[1].astype(np.int32)]
    while width < n and int(ranks[-1].max()) < n - 1:
        pair = ranks[-1].astype(np.int64) * (n + 1)
        pair[: n - width] += ranks[-1][width:] + 1
        ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
        width *= 2
    return ranks


def _common(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of words that the suffixes at ``i`` and ``j`` share."""
    n, shared = len(ranks[0]), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        a, b = i + shared, j + shared
        inside = (a < n) & (b < n)
        same = inside & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        shared += same.astype(np.int64) << k
    return shared


def word_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple]:
    """``start, length, period`` of every run, by start, then period.

    ``min_exponent`` (2 or more) is the least length in periods.
    """
    # A run's first word shares length - period words with the word one period later.
    least = min(max((min_exponent - 1) * q, min_length - q) for q in range(1, min_length + 1))
    active = repeated(codes, least)
    if not len(active):
        return []
    ranks = suffix_ranks(codes)
    order = active[np.argsort(ranks[-1][active], kind="stable")]
    shared = _common(ranks, order[:-1], order[1:])
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")]

    parent = {p: p for p in active.tolist()}
    classes = {p: Positions(p) for p in parent}

    def root(p: int) -> int:
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    word, runs = codes.tolist(), []
    for i, j, lcp in zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist()):
        small, large = root(i), root(j)
        if classes[small].size > classes[large].size:
            small, large = large, small
        into, moved = classes[large], list(classes.pop(small))
        parent[small] = large
        met, last = [], -1
        for k, x in enumerate(moved):
            before, after = into.around(x)
            if before > last:
                met.append((before, x))
            if after >= 0 and (k + 1 == len(moved) or after < moved[k + 1]):
                met.append((x, after))
            last = x
        for x in moved:
            into.add(x)
        for first, second in met:
            q = second - first
            if (min_exponent - 1) * q <= lcp and q + lcp >= min_length:
                if first == 0 or word[first - 1] != word[second - 1]:
                    runs.append((first, q + lcp, q))
    return sorted(runs)


def strongest(runs: list[tuple]) -> tuple | None:
    """The run of the greatest length in periods; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(n_words: int, runs: list[tuple]) -> np.ndarray:
    """Which words stay: all but those that some run repeats after its first period."""
    edge = np.zeros(n_words + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n_words]) == 0


def _codes(words: list[str]) -> np.ndarray:
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def find_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, n_words, runs, strongest, collapsed`` for every row of ``docs``.

    Words are runs of anything but ASCII white space. ``runs`` holds ``start, length,
    period`` (in words, from 0) by start, then period; ``strongest`` is the one with the
    most periods, NULL without a run; ``collapsed`` are the words that no run repeats,
    joined by one space. A NULL, empty or blank text has no words, no runs and the empty
    ``collapsed``. Repeated rows and NULL ids are rows of their own; other columns are
    left aside; an empty table gives no rows. Each row is judged by itself, so nothing is
    shuffled and memory grows with one text only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts, found, best, left = [], [], [], []
            for text in part.column(1).to_pylist():
                words = WORD.findall(text)
                runs = word_runs(_codes(words), min_length, min_exponent)
                counts.append(len(words))
                found.append([dict(zip(RUN.names, r)) for r in runs])
                top = strongest(runs)
                best.append(None if top is None else dict(zip(RUN.names, top)))
                if runs:
                    words = [words[i] for i in np.flatnonzero(collapse(len(words), runs)).tolist()]
                left.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(found, pa.list_(_ARROW_RUN)),
                    pa.array(best, _ARROW_RUN),
                    pa.array(left, pa.string()),
                ],
                names=[id_col, "n_words", "runs", "strongest", "collapsed"],
            )

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("strongest", RUN),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return docs.select(id_col, text_of(text_col).alias("_text")).mapInArrow(run, schema)


def loop_tail(text: Column, crc: Column) -> Column:
    """A tenth of all texts, chosen by a checksum, with the words after some place looped.

    Built from array functions, since a lambda would evaluate the words once per word.
    """
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, g = F.size(words), F.floor(crc / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    root = F.slice(words, a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    looped = F.slice(F.flatten(F.array_repeat(root, times)), F.lit(1), n - a)
    return F.when((crc % 10 == 0) & (n > 0), F.concat_ws(" ", F.concat(F.slice(words, F.lit(1), a), looped))).otherwise(text)
