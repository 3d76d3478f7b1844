"""Pairs of words in packed rows: one row holds thousands of them as bytes of 64-bit numbers.

A pair is known by two numbers, ``mix`` (of both words) and ``first``; a word is its XXH64.
Every chunk of a table's words names each different pair once, so a pair that is everywhere
never gathers, and the top bits of ``mix`` deal the pairs over groups of bounded size.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words in a chunk, pairs in a group and pairs in a written row, at most or about.
CHUNK_WORDS = 1 << 20
GROUP_PAIRS = 1 << 21
ROW_PAIRS = 1 << 19

ODD = np.uint64(0x9E3779B97F4A7C15)
PAIRS = "lang string, bucket int, mix binary, first binary, n binary"
WORDS = "lang string, bucket int, word binary, c binary, types binary, k binary, total bigint"


def bits_for(df: DataFrame, text: str) -> int:
    """How many top bits part the pairs of a table into groups of bounded size: a word takes some six bytes, two at least."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(0, math.ceil(math.log2(max(1, size) / (6 * GROUP_PAIRS))))


def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Rows of bytes: ``values`` of 64 bits each, parted at ``cuts``."""
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(data)])


def unpacked(column, kind=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def joined(parts: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def dealt(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the groups that sorted keys fall into, and where each begins and the last ends."""
    if not bits or not len(keys):
        return np.zeros(min(1, len(keys)), np.int32), np.array([0, len(keys)][: 1 + min(1, len(keys))])
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    cuts = np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))
    full = np.flatnonzero(np.diff(cuts))
    return full.astype(np.int32), np.concatenate((cuts[full], [len(keys)]))


def same(lang: str | None, rows: int) -> pa.Array:
    return pa.array([lang] * rows, pa.string())


def different(mix: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the pairs, and which of them in that order differ from the one before."""
    order = np.argsort(mix)
    m, f = mix[order], first[order]
    equal, other = m[1:] == m[:-1], f[1:] != f[:-1]
    if (equal & other).any():  # different pairs of one mix may be mingled
        order = np.lexsort((first, mix))
        m, f = mix[order], first[order]
        equal, other = m[1:] == m[:-1], f[1:] != f[:-1]
    return order, np.concatenate((np.ones(min(1, len(mix)), bool), ~equal | other))


def pairs_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``mix`` and ``first`` of adjacent words inside documents of two words at least."""
    inside = np.ones(max(0, len(words) - 1), bool)
    inside[np.cumsum(sizes)[:-1] - 1] = False
    first, second = words[:-1][inside], words[1:][inside]
    return first * ODD + second, first


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """Language, keys, sizes and words of a batch's documents, cut into chunks; a document over that size is cut, with a word in common."""
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        of = batch.take(pa.array(np.flatnonzero(codes == code)))
        keys, words = of.column("key"), of.column("words").flatten().to_numpy().view(np.uint64)
        sizes = of.column("words").value_lengths().to_numpy().astype(np.int64)
        if (sizes > CHUNK_WORDS).any():
            starts, step = np.cumsum(sizes) - sizes, CHUNK_WORDS - 1
            cut = [(i, a, min(a + CHUNK_WORDS, s)) for i, s in enumerate(sizes.tolist()) for a in range(0, s - 1, step)]
            keys = keys.take(pa.array([i for i, _, _ in cut]))
            words = np.concatenate([words[starts[i] + a : starts[i] + b] for i, a, b in cut])
            sizes = np.array([b - a for _, a, b in cut])
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            before = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, "right")))
            yield lang, keys.slice(at, to - at), sizes[at:to], words[before : ends[to - 1]]
            at = to


def counted(batches, bits: int):
    """Packed pairs of documents, counted within a chunk."""
    for batch in batches:
        for lang, _, sizes, words in by_language(batch):
            yield summed(lang, *pairs_of(words, sizes), None, bits)


def summed(lang: str, mix: np.ndarray, first: np.ndarray, n: np.ndarray | None, bits: int) -> pa.RecordBatch:
    order, new = different(mix, first)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(mix))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    mix, first = mix[order][at], first[order][at]
    buckets, cuts = dealt(mix, bits)
    if len(mix) > ROW_PAIRS:  # groups longer than a row take several
        more = np.setdiff1d(np.arange(0, len(mix), ROW_PAIRS), cuts)
        buckets = np.insert(buckets, np.searchsorted(cuts, more), buckets[np.searchsorted(cuts, more) - 1])
        cuts = np.sort(np.concatenate((cuts, more)))
    columns = [packed(x, cuts) for x in (mix, first, n.astype(np.int64))]
    return pa.RecordBatch.from_arrays([same(lang, len(buckets)), pa.array(buckets), *columns], ["lang", "bucket", "mix", "first", "n"])


def merged(table: pa.Table, bits: int) -> pa.Table:
    """The packed pairs of a language and bucket, each once."""
    columns = [joined(unpacked(table.column(c), kind), kind) for c, kind in (("mix", np.uint64), ("first", np.uint64), ("n", np.int64))]
    return pa.Table.from_batches([summed(table.column("lang")[0].as_py(), *columns, bits)])


def dealt_anew(batches, bits: int):
    """Packed pairs dealt over more buckets."""
    for batch in batches:
        for lang, mix, first, n in zip(batch.column("lang").to_pylist(), unpacked(batch.column("mix")), unpacked(batch.column("first")), unpacked(batch.column("n"), np.int64)):
            yield summed(lang, mix, first, n, bits)


def words_summed(lang: str, word: np.ndarray, sums: list[np.ndarray], bits: int) -> pa.RecordBatch:
    order = np.argsort(word)
    ordered = word[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(word)), bool), ordered[1:] != ordered[:-1])))
    sums = [np.add.reduceat(x[order], at) if len(at) else x for x in sums]
    buckets, cuts = dealt(ordered[at], bits)
    columns = [packed(x, cuts) for x in (ordered[at], *sums)]
    total = np.add.reduceat(sums[2], cuts[:-1]) if len(buckets) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([same(lang, len(buckets)), pa.array(buckets), *columns, pa.array(total)], ["lang", "bucket", "word", "c", "types", "k", "total"])


def words_in_pairs(batches, bits: int):
    """Per word: its count as the first of a pair, and of how many different pairs it is the first and the second."""
    for batch in batches:
        for lang, mix, first, n in zip(batch.column("lang").to_pylist(), unpacked(batch.column("mix")), unpacked(batch.column("first")), unpacked(batch.column("n"), np.int64)):
            one, none = np.ones(len(n), np.int64), np.zeros(len(n), np.int64)
            sums = [np.concatenate(x) for x in ((n, none), (one, none), (none, one))]
            yield words_summed(lang, np.concatenate((first, mix - first * ODD)), sums, bits)


def words_merged(table: pa.Table, bits: int) -> pa.Table:
    sums = [joined(unpacked(table.column(c), np.int64), np.int64) for c in ("c", "types", "k")]
    return pa.Table.from_batches([words_summed(table.column("lang")[0].as_py(), joined(unpacked(table.column("word"))), sums, bits)])


def words_dealt_anew(batches, bits: int):
    for batch in batches:
        columns = [unpacked(batch.column(c), kind) for c, kind in (("word", np.uint64), ("c", np.int64), ("types", np.int64), ("k", np.int64))]
        for lang, word, *sums in zip(batch.column("lang").to_pylist(), *columns):
            yield words_summed(lang, word, sums, bits)


def chunks(batches):
    """A row for each chunk of documents, with a name of its own."""
    for batch in batches:
        for lang, keys, sizes, words in by_language(batch):
            ends = np.array([0, len(words)])
            listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (keys, pa.array(sizes))]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), same(lang, 1), *listed, packed(words, ends)], ["chunk", "lang", "keys", "sizes", "words"])


def chunk_rows(table) -> Iterator[tuple]:
    for chunk, lang, sizes, words in zip(table.column("chunk").to_pylist(), table.column("lang").to_pylist(), table.column("sizes"), unpacked(table.column("words"))):
        yield chunk, lang, np.asarray(sizes.values), words


def asked_pairs(batches, bits: int):
    """Each different pair of a chunk, packed by bucket."""
    for batch in batches:
        for chunk, lang, sizes, words in chunk_rows(batch):
            mix, first = pairs_of(words, sizes)
            order, new = different(mix, first)
            mix, first = mix[order][new], first[order][new]
            buckets, cuts = dealt(mix, bits)
            names = [same(lang, len(buckets)), pa.array(buckets), same(chunk, len(buckets))]
            yield pa.RecordBatch.from_arrays([*names, packed(mix, cuts), packed(first, cuts)], ["lang", "bucket", "chunk", "mix", "first"])


def asked_words(batches, bits: int):
    for batch in batches:
        for chunk, lang, _, words in chunk_rows(batch):
            word = np.unique(words)
            buckets, cuts = dealt(word, bits)
            names = [same(lang, len(buckets)), pa.array(buckets), same(chunk, len(buckets))]
            yield pa.RecordBatch.from_arrays([*names, packed(word, cuts)], ["lang", "bucket", "chunk", "word"])


ANSWERS = "chunk string, of string, bucket int, answer binary"


def answers(asked: pa.Table, of: str, found: list[np.ndarray]) -> pa.Table:
    rows = asked.num_rows
    columns = [asked.column("chunk").cast(pa.string()), same(of, rows), asked.column("bucket").cast(pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())]
    return pa.Table.from_arrays(columns, ["chunk", "of", "bucket", "answer"])


def in_order(table: pa.Table, names: list[str]) -> list[np.ndarray]:
    """Columns of packed rows of one bucket as whole arrays, ordered by the first, which each row has in order."""
    kinds = [np.uint64 if c in ("mix", "first", "word") else np.int64 for c in names]
    columns = [unpacked(table.column(c), kind) for c, kind in zip(names, kinds)]
    rows = sorted(range(table.num_rows), key=lambda i: columns[0][i][0])
    return [joined([x[i] for i in rows], kind) for x, kind in zip(columns, kinds)]


def pair_counts(asked: pa.Table, known: pa.Table) -> pa.Table:
    """How often the model has seen each pair of a bucket that the chunks ask for, 0 if never."""
    mix, first, n = in_order(known, ["mix", "first", "n"])
    found = []
    for m, f in zip(unpacked(asked.column("mix")), unpacked(asked.column("first"))):
        at = np.searchsorted(mix, m)
        got = np.zeros(len(m), np.int64)
        open_ = np.flatnonzero(at < len(mix))
        while len(open_ := open_[mix[at[open_]] == m[open_]]):  # as many rounds as pairs share a mix
            hit = first[at[open_]] == f[open_]
            got[open_[hit]] = n[at[open_[hit]]]
            at[open_] += 1
            open_ = open_[~hit]
            open_ = open_[at[open_] < len(mix)]
        found.append(got)
    return answers(asked, "pairs", found)


def word_counts(asked: pa.Table, known: pa.Table) -> pa.Table:
    """``c``, ``types`` and ``k`` of each word, 0 if never seen."""
    word, *sums = in_order(known, ["word", "c", "types", "k"])
    found = []
    for w in unpacked(asked.column("word")):
        at = np.searchsorted(word, w)
        hit = np.flatnonzero(at < len(word))
        hit = hit[word[at[hit]] == w[hit]]
        got = np.zeros((3, len(w)), np.int64)
        for row, x in zip(got, sums):
            row[hit] = x[at[hit]]
        found.append(got)
    return answers(asked, "words", found)


def log_probabilities(asking: pa.Table, answered: pa.Table, discount: float, unseen: float, unknown: float) -> pa.Table:
    """Sum of log probabilities and number of pairs of each document of a chunk."""
    (_, _, sizes, words), keys = next(chunk_rows(asking)), asking.column("keys").combine_chunks().flatten()
    total = asking.column("total")[0].as_py()
    mix, first = pairs_of(words, sizes)
    order, new = different(mix, first)
    number = np.empty(len(mix), np.int64)
    number[order] = np.cumsum(new) - 1
    mix, first = mix[order][new], first[order][new]
    rows = sorted(zip(answered.column("of").to_pylist(), answered.column("bucket").to_pylist(), unpacked(answered.column("answer"), np.int64)), key=lambda r: r[:2])
    n = joined([x for of, _, x in rows if of == "pairs"], np.int64)
    c, types, k = np.concatenate([x.reshape(3, -1) for of, _, x in rows if of == "words"], axis=1)
    known = np.unique(words)
    one, two = np.searchsorted(known, first), np.searchsorted(known, mix - first * ODD)
    c, types, k = c[one], types[one], k[two]
    often = np.maximum(c, 1)
    backoff = np.where(c > 0, discount * types / often, 1.0)
    share = np.full(len(k), unknown) if total is None else np.where(k > 0, k / total, unseen / total)
    log = np.log(np.where(n > 0, (n - discount) / often, 0.0) + backoff * share)[number]
    pairs = sizes - 1
    sums = np.add.reduceat(log, np.cumsum(pairs) - pairs)
    return pa.Table.from_arrays([keys, pa.array(sums), pa.array(pairs, pa.int64())], ["key", "logp", "m"])
