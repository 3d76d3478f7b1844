"""Pairs of words of a table that is scored by the model of its own pairs.

Chunks, pairs and groups are those of ``packed_pairs``. Here each word of a language gets a small
number, and whole numbers travel squeezed, so that a pair takes some three bytes. A group of
pairs adds up what the chunks hold and answers them at once: no model is written or asked.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa

from textquarry.operators import packed_pairs as PP

ASKED = "lang string, bucket int, chunk string, word binary"
NUMBERED = "lang string, bucket int, chunk string, id binary"
PAIRS = "lang string, bucket int, chunk string, pair binary, n binary"
# A chunk's answers have its name; sums of words have none, and one row of a group has its number of pairs.
COUNTED = "lang string, bucket int, chunk string, n binary, id binary, c binary, types binary, k binary, total bigint"
ANSWERS = "chunk string, of string, bucket int, a binary, b binary, c binary"


def squeezed(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers as their bytes of one rank after the other, compressed; rising ones as differences."""
    values = values.astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(values).to_bytes(4, "little") + bytes([width]) + (pa.compress(pa.py_buffer(planes), "zstd", asbytes=True) if len(values) else b"")


def spread(cell, rising: bool = False) -> np.ndarray:
    data = cell.as_buffer()
    size, width = int.from_bytes(data[:4].to_pybytes(), "little"), data[4]
    values = np.zeros((size, 8), np.uint8)
    if size:
        values[:, :width] = np.frombuffer(pa.decompress(data[5:], size * width, "zstd"), np.uint8).reshape(width, size).T
    values = values.view(np.uint64).ravel()
    return np.cumsum(values) if rising else values


def cells(arrays: list[np.ndarray], rising: bool = False) -> pa.Array:
    return pa.array([squeezed(x, rising) for x in arrays], pa.binary())


def groups(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones of sorted numbers, and where each begins."""
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(numbers)), bool), numbers[1:] != numbers[:-1])))
    return numbers[at], at


def chunks(batches):
    """A row for each chunk of documents: its different words in order, and which of them stands at each place."""
    for batch in batches:
        for lang, keys, sizes, words in PP.by_language(batch):
            known, at = np.unique(words, return_inverse=True)
            listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (keys, pa.array(sizes))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), PP.same(lang, 1), *listed, cells([known], True), cells([at])], ["chunk", "lang", "keys", "sizes", "words", "at"]
            )


def asked_words(batches, bits: int):
    for batch in batches:
        for chunk, lang, cell in zip(batch.column("chunk").to_pylist(), batch.column("lang").to_pylist(), batch.column("words")):
            words = spread(cell, True)
            buckets, cuts = PP.dealt(words, bits)
            parts = [words[a:b] for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [PP.same(lang, len(parts)), pa.array(buckets), PP.same(chunk, len(parts)), cells(parts, True)], ["lang", "bucket", "chunk", "word"]
            )


def numbered(table: pa.Table, bits: int) -> pa.Table:
    """A number for each word of a bucket, rising with the words; its lower bits are the bucket."""
    asked = [spread(x, True) for x in table.column("word")]
    known, bucket = np.unique(np.concatenate(asked)), table.column("bucket")[0].as_py()
    ids = [(np.searchsorted(known, x) << bits) | bucket for x in asked]
    return pa.Table.from_arrays([table.column(c) for c in ("lang", "bucket", "chunk")] + [cells(ids, True)], ["lang", "bucket", "chunk", "id"])


class Chunk:
    """A chunk's places as numbers of its different words and pairs, these in the order in which they are dealt."""

    def __init__(self, chunk: pa.Table, ids: list[np.ndarray], bits: int):
        self.sizes, at = np.asarray(chunk.column("sizes")[0].values), spread(chunk.column("at")[0]).astype(np.int64)
        ids, inside = np.concatenate(ids), np.ones(max(0, len(at) - 1), bool)
        inside[np.cumsum(self.sizes)[:-1] - 1] = False
        local, number, self.n = np.unique(at[:-1][inside] * len(ids) + at[1:][inside], return_inverse=True, return_counts=True)
        first, second = np.divmod(local, len(ids))
        pairs = ids[first] << np.uint64(32) | ids[second]
        buckets = (pairs * PP.ODD >> np.uint64(64 - bits)) if bits else np.zeros(len(pairs), np.uint64)
        order = np.lexsort((pairs, buckets))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.number, self.first, self.second, self.n = back[number], first[order], second[order], self.n[order]
        self.pairs, self.buckets = pairs[order], buckets[order].astype(np.int32)


def counted(chunk: pa.Table, ids: pa.Table, bits: int) -> pa.Table:
    """The different pairs of a chunk by bucket, and how often it has each."""
    own = Chunk(chunk, [spread(x, True) for x in by_bucket(ids).column("id")], bits)
    buckets, cuts = groups(own.buckets)
    pairs, n = ([x[a:b] for a, b in zip(cuts, [*cuts[1:], len(x)])] for x in (own.pairs, own.n))
    names = [PP.same(chunk.column(c)[0].as_py(), len(pairs)) for c in ("lang", "chunk")]
    return pa.Table.from_arrays([names[0], pa.array(buckets), names[1], cells(pairs, True), cells(n)], ["lang", "bucket", "chunk", "pair", "n"])


def by_bucket(table: pa.Table) -> pa.Table:
    return table.sort_by("bucket")


def summed(table: pa.Table, bits: int) -> pa.Table:
    """For each chunk the counts of its pairs in the whole table, and sums of a bucket's pairs by their words.

    A word's ``c`` is how often it is the first of a pair; ``types`` and ``k`` are of how many different
    pairs it is the first and the second. They are dealt by the lower ``bits`` of the word's number.
    """
    lang, bucket = (table.column(c)[0].as_py() for c in ("lang", "bucket"))
    asked = [spread(x, True) for x in table.column("pair")]
    known, at = np.unique(np.concatenate(asked), return_inverse=True)
    n = np.bincount(at, np.concatenate([spread(x) for x in table.column("n")]), len(known)).astype(np.int64)
    found = [n[x] for x in np.split(at, np.cumsum([len(x) for x in asked])[:-1])]

    first, second = (known >> np.uint64(32)).astype(np.int64), (known & np.uint64(0xFFFFFFFF)).astype(np.int64)
    words, at = np.unique(np.concatenate((first, second)), return_inverse=True)
    one, two = at[: len(first)], at[len(first) :]
    sums = [np.bincount(one, n, len(words)), np.bincount(one, minlength=len(words)), np.bincount(two, minlength=len(words))]
    order = np.argsort(words & ((1 << bits) - 1), kind="stable")
    buckets, cuts = groups((words & ((1 << bits) - 1))[order])
    parts = [[x[order][a:b] for a, b in zip(cuts, [*cuts[1:], len(x)])] for x in (words, *sums)]

    rows, more = len(found), len(buckets)
    none = pa.nulls(rows, pa.binary())
    columns = [
        PP.same(lang, rows + more), pa.array([bucket] * rows + buckets.tolist(), pa.int32()),
        pa.array(table.column("chunk").to_pylist() + [None] * more, pa.string()), pa.array([squeezed(x) for x in found] + [None] * more, pa.binary()),
        pa.concat_arrays([none, cells(parts[0], True)]), *[pa.concat_arrays([none, cells(x)]) for x in parts[1:]],
        pa.array([None] * rows + [len(known)] + [None] * (more - 1), pa.int64()),
    ]
    return pa.Table.from_arrays(columns, ["lang", "bucket", "chunk", "n", "id", "c", "types", "k", "total"])


def word_sums(ids: pa.Table, sums: pa.Table) -> pa.Table:
    """``c``, ``types`` and ``k`` of each word of a bucket that the chunks hold."""
    known, at = np.unique(np.concatenate([spread(x, True) for x in sums.column("id")]), return_inverse=True)
    totals = [np.bincount(at, np.concatenate([spread(x) for x in sums.column(c)]), len(known)).astype(np.int64) for c in ("c", "types", "k")]
    places = [np.searchsorted(known, spread(x, True)) for x in ids.column("id")]
    columns = [ids.column("chunk"), PP.same("words", len(places)), ids.column("bucket"), *[cells([x[p] for p in places]) for x in totals]]
    return pa.Table.from_arrays(columns, ["chunk", "of", "bucket", "a", "b", "c"])


def log_probabilities(chunk: pa.Table, answered: pa.Table, bits: int, discount: float) -> pa.Table:
    """Sum of log probabilities and number of pairs of each document of a chunk."""
    answered = by_bucket(answered)
    of = answered.column("of").to_pylist()

    def found(what: str, column: str, rising: bool = False) -> list[np.ndarray]:
        return [spread(x, rising) for x, kind in zip(answered.column(column), of) if kind == what]

    own, keys = Chunk(chunk, found("ids", "a", True), bits), chunk.column("keys").combine_chunks().flatten()
    n = np.concatenate(found("pairs", "a")).astype(np.int64)
    c, types, k = (np.concatenate(found("words", x)).astype(np.int64) for x in "abc")
    c, types, k, total = c[own.first], types[own.first], k[own.second], chunk.column("total")[0].as_py()
    log = np.log((n - discount) / c + discount * types / c * k / total)[own.number]
    pairs = own.sizes - 1
    return pa.Table.from_arrays([keys, pa.array(np.add.reduceat(log, np.cumsum(pairs) - pairs)), pa.array(pairs, pa.int64())], ["key", "logp", "m"])
