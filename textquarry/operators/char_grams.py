"""Character n-grams of whole batches of texts in numpy: what a language model counts and looks up.

Texts are laid out as one array of code points, words between marks. In a window of it each
different trigram gets a place; only these are hashed, and positions are counted by place.
Buckets are those of Spark's ``HashingTF``: Murmur3 of the UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

# Characters in a block of texts and positions in a window, at most (a longer text is a block of its own, and read in pieces), and flags in a block's table of texts by bucket.
BLOCK_CHARS = 1 << 20
WINDOW = 1 << 20
BLOCK_FLAGS = 1 << 24
# Possible trigrams of an alphabet up to which places are looked up in a table; above that they are sorted.
TABLE = 1 << 22

MARK, BLANK, BLANKS = ord("_"), ord(" "), re.compile(r"[ \t\n\r\f\x0B]")
SEED, C1, C2 = np.uint32(42), np.uint32(0xCC9E2D51), np.uint32(0x1B873593)
# Without a language: how many texts hold the bucket. Bucket -1: how many texts the language has.
COUNTED = "lang string, bucket int, n bigint"
BEST = "language_id string, language_score double"


@dataclass(frozen=True)
class LanguageModel:
    """Sorted labels, the logarithm of each one's share of texts, and what a bucket adds to each (nothing in the last column)."""

    labels: list[str]
    priors: np.ndarray
    weights: np.ndarray

    @property
    def features(self) -> int:
        return self.weights.shape[1] - 1


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint32(by)) | (x >> np.uint32(32 - by))


def buckets(letters: list[np.ndarray], features: int) -> np.ndarray:
    """The bucket of each n-gram, from one array of code points per place in it (three places at most)."""
    rows, at = np.arange(len(letters[0])), np.zeros(len(letters[0]), np.int64)
    coded = np.zeros((len(rows), 16), np.uint8)
    for c in letters:
        size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000).astype(np.int64)
        head = np.array([0, 0, 0xC0, 0xE0, 0xF0], np.uint32)[size]
        for i in range(int(size.max(initial=0))):
            has = np.flatnonzero(size > i)
            rest = (c[has] >> (6 * (size[has] - 1 - i)).astype(np.uint32))
            byte = np.where(i > 0, 0x80 | (rest & 0x3F), head[has] | rest)
            coded[has, at[has] + i] = byte
        at += size
    blocks, h = coded.view("<u4"), np.full(len(rows), SEED)
    mixed = _rotated(blocks * C1, 15) * C2
    for i in range(3):
        h = np.where(at >= 4 * (i + 1), _rotated(h ^ mixed[:, i], 13) * np.uint32(5) + np.uint32(0xE6546B64), h)
    h ^= mixed[rows, at // 4]  # the bytes left over, or nothing
    h ^= at.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64) % features


def blocks(texts: list[str], features: int) -> Iterator[tuple[int, int]]:
    """Where blocks of texts begin and end."""
    begin = chars = 0
    for i, text in enumerate(texts):
        if i > begin and (chars + len(text) > BLOCK_CHARS or (i - begin + 1) * features > BLOCK_FLAGS):
            yield begin, i
            begin, chars = i, 0
        chars += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def pieces(text: str) -> Iterator[str]:
    """A long text cut at blanks, so at no n-gram; only a long word keeps a piece long."""
    begin = 0
    while len(text) - begin > BLOCK_CHARS and (cut := BLANKS.search(text, begin + BLOCK_CHARS)):
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each word between marks and one blank between words, and the text that each position is of.

    A blank and the mark before it are of the text that ends there, so an n-gram is of the text of its second character.
    """
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    blank = (codes == BLANK) | ((codes >= 9) & (codes <= 13))
    width = np.ones(len(codes), np.int8)
    width[blank] = 3
    width[1:][blank[1:] & blank[:-1]] = 0
    ends = np.cumsum(width, dtype=np.int64)
    marked = np.repeat(codes, width)
    gaps = ends[np.flatnonzero(width == 3)]
    marked[gaps - 3] = marked[gaps - 1] = MARK
    marked[gaps - 2] = BLANK
    last = np.cumsum([len(t) + 1 for t in texts])
    return marked, np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends[last], prepend=0))


def windows(texts: list[str], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each window: the place of each position's trigram, the position's text, and by place the buckets of its first two characters and of all three.

    Bucket ``features`` is none: a blank is in no n-gram.
    """
    for part in ([piece] for piece in pieces(texts[0])) if len(texts) == 1 else [texts]:
        marked, of = laid_out(part)
        for begin in range(0, len(marked) - 2, WINDOW):
            yield window(marked[begin : begin + WINDOW + 2], of[begin + 1 : begin + WINDOW + 1], features)


def window(codes: np.ndarray, of: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    letters = np.flatnonzero(seen)
    number = np.empty(0x110000, np.int32)
    number[letters] = np.arange(len(letters))
    ids, n = number[codes].astype(np.int64), len(letters)
    keys = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    if n**3 <= TABLE:
        found = np.zeros(n**3, bool)
        found[keys] = True
        different = np.flatnonzero(found)
        places = np.empty(n**3, np.int32)
        places[different] = np.arange(len(different))
        place = places[keys]
    else:
        different, place = np.unique(keys, return_inverse=True)
    a, b, c = (letters[x].astype(np.uint32) for x in (different // (n * n), different // n % n, different % n))
    two = (a != BLANK) & (b != BLANK)
    three = two & (c != BLANK)
    return place, of[: len(place)], np.where(two, buckets([a, b], features), features), np.where(three, buckets([a, b, c], features), features)


def counted(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[pa.RecordBatch]:
    """What a task's texts add to a model; see ``COUNTED``. A task keeps a number per language and bucket."""
    grams: dict[str, np.ndarray] = {}
    texts_of: dict[str, int] = {}
    holding = np.zeros(features + 1, np.int64)
    for batch in batches:
        batch = batch.drop_null()  # here, as a filter would have Spark make a costly text twice
        langs, texts = batch.column("lang").dictionary_encode(), batch.column("text")
        codes = langs.indices.to_numpy()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            own = texts.take(pa.array(np.flatnonzero(codes == code))).to_pylist()
            sums = grams.setdefault(lang, np.zeros(features + 1, np.int64))
            texts_of[lang] = texts_of.get(lang, 0) + len(own)
            for begin, end in blocks(own, features):
                held = np.zeros((end - begin, features + 1), bool)
                flags = held.reshape(-1)
                for place, of, two, three in windows(own[begin:end], features):
                    times = np.bincount(place, minlength=len(two))
                    first = of.astype(np.int64) * (features + 1)
                    for bucket in (two, three):
                        np.add.at(sums, bucket, times)
                        flags[first + bucket[place]] = True
                holding += held.sum(axis=0)
    for lang, n in [*grams.items(), (None, holding)]:
        full = np.flatnonzero(n[:features])
        bucket, n = full.astype(np.int32), n[full]
        if lang is not None:
            bucket, n = np.append(bucket, np.int32(-1)), np.append(n, texts_of[lang])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64())], ["lang", "bucket", "n"])


def model_of(rows: pa.Table, features: int) -> LanguageModel:
    """Multinomial naive Bayes with add-one smoothing over counts times inverse document frequencies, as Spark ML fits it."""
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    codes = langs.indices.fill_null(-1).to_numpy()
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    names = langs.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    holding, grams, texts = np.zeros(features), np.zeros((len(names), features)), np.zeros(len(names))
    holding[bucket[codes < 0]] = n[codes < 0]
    for i, code in enumerate(order):
        own, sizes = bucket[codes == code], n[codes == code]
        grams[i, own[own >= 0]] = sizes[own >= 0]
        texts[i] = sizes[own < 0].sum()
    rarity = np.log((texts.sum() + 1) / (holding + 1))
    grams *= rarity
    weights = np.zeros((len(names), features + 1))
    weights[:, :features] = (np.log(grams + 1) - np.log(grams.sum(axis=1, keepdims=True) + features)) * rarity
    return LanguageModel([names[i] for i in order], np.log(texts + 1) - np.log(max(1, texts.sum() + len(names))), weights)


def identified(texts: list[str | None], model: LanguageModel) -> pd.DataFrame:
    """The most probable language of each text and its probability, neither for a missing text; of equal ones the last by name."""
    given = [i for i, t in enumerate(texts) if t is not None and model.labels]
    names, best = np.full(len(texts), None, object), np.full(len(texts), np.nan)
    own, of_labels = [texts[i] for i in given], np.array(model.labels, object)
    for begin, end in blocks(own, model.features):
        raw = np.repeat(model.priors[:, None], end - begin, axis=1)
        for place, of, two, three in windows(own[begin:end], model.features):
            for label, weights in enumerate(model.weights):
                raw[label] += np.bincount(of, (weights[two] + weights[three])[place], end - begin)
        p = np.exp(raw - raw.max(axis=0))
        p /= p.sum(axis=0)
        top = len(p) - 1 - p[::-1].argmax(axis=0)
        names[given[begin:end]] = of_labels[top]
        best[given[begin:end]] = p[top, np.arange(end - begin)]
    return pd.DataFrame({"language_id": names, "language_score": best})
