"""Benchmark leaks: n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are counted over all documents, and every one that occurs is
a seed: an edited copy is found by whatever n-grams its editor left, however often the others
stand elsewhere. Where a document holds a seed, the passage around it is aligned with the item
word by word, which finds edited and paraphrased copies; passages that share too few words to
reach the least score are skipped by an exact bound. Short items must match word for word, and
a long run of a long item is a leak whatever its share of the item. In scripts written without
blanks every character is a word.

Items are taken in blocks of ``BLOCK_CHARS`` characters, so an index is always small,
and every block is held against all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from textquarry.llm.common import materialize, slices, text_of
from textquarry.llm.global_order import global_order

GRAM = 3
# Any copied run of GRAM words has a seed, so one of GRAM + SEED_SPAN - 1 words has SEED_SPAN.
SEED_SPAN = 8
MATCH, MISMATCH, GAP = 2.0, -2.0, -2.0
# Least alignment score as a share of the item's score with itself.
MIN_SCORE = 0.4
# A passage that scores like this many copied words is a leak of an item of any length.
LONG_RUN = 40
# Items shorter than EXACT_WORDS count only where they stand word for word; those shorter than
# MIN_ITEM_WORDS can't be told from chance and are ignored.
EXACT_WORDS = 8
MIN_ITEM_WORDS = 4
BLOCK_CHARS = 2_000_000

# Thai to Burmese, Khmer, kana, Chinese characters: written without blanks.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(r"[^\W_]+")
_WORD_OR_CHAR = re.compile(rf"[^\W_{_UNSPACED}]+|[^\W_]")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case; single characters in scripts without blanks."""
    text = text.lower()
    try:
        text.encode("latin-1")  # the quickest way to see that no such script is there
    except UnicodeEncodeError:
        if _HAS_UNSPACED.search(text):
            return _WORD_OR_CHAR.findall(text)
    return _WORD.findall(text)


def needed_score(words: int, min_score: float = MIN_SCORE) -> float:
    """The alignment score at which a passage counts as a leak of an item of so many words."""
    share = 1.0 if words < EXACT_WORDS else min_score
    return MATCH * min(share * words, max(LONG_RUN, EXACT_WORDS))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """The best local alignment score, and the passage position where it ends."""
    steps = np.arange(len(passage)) * -GAP
    above, best, end = np.zeros(len(passage)), 0.0, 0
    for word in item:
        diagonal = np.concatenate(([0.0], above[:-1])) + np.where(passage == word, MATCH, MISMATCH)
        row = np.maximum(np.maximum(diagonal, above + GAP), 0.0)
        above = np.maximum.accumulate(row + steps) - steps
        at = int(above.argmax())
        if above[at] > best:
            best, end = float(above[at]), at
    return best, end + 1


class ItemIndex:
    """The words, n-grams and (once frequencies are known) seeds of a block of items."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids, self.words = [], []
        self.vocabulary: dict[str, int] = {}
        for key, text in items:
            words = words_of(text)
            if len(words) >= MIN_ITEM_WORDS:
                self.ids.append(key)
                self.words.append(
                    np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
                )
        self.base = len(self.vocabulary) + 1
        grams = [self._codes(w) for w in self.words]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
        self.seeds = np.zeros(0, np.int64)
        self.places: list[list[tuple[int, int]]] = []

    def _codes(self, words: np.ndarray) -> np.ndarray:
        """A number for each n-gram; 0 where a word is no item's.

        Beyond 2^21 different words numbers wrap around; n-grams that share one are told
        apart by the alignment.
        """
        n = max(0, len(words) - GRAM + 1)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(GRAM):
            part = words[i : i + n]
            code = code * self.base + part
            known &= part > 0
        return np.where(known, code, 0)

    def number(self, text: str) -> np.ndarray:
        known = self.vocabulary.get
        return np.array([known(w, 0) for w in words_of(text)], np.int64)

    def find(self, codes: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of n-grams that are in a sorted array, and their places there."""
        if not len(among):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = np.flatnonzero(codes)
        at = np.searchsorted(among, codes[held])
        at[at == len(among)] = 0
        same = among[at] == codes[held]
        return held[same], at[same]

    def choose_seeds(self, frequency: np.ndarray) -> None:
        """All n-grams of all items that occur in some document."""
        places: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(self.words):
            codes = self._codes(words)
            documents = frequency[np.searchsorted(self.grams, codes)]
            for at in np.flatnonzero(documents).tolist():
                places.setdefault(int(codes[at]), []).append((item, at))
        self.seeds = np.array(sorted(places), np.int64)
        self.places = [places[code] for code in self.seeds.tolist()]

    def matches(self, text: str, min_score: float = MIN_SCORE) -> list[tuple[object, float, int, int]]:
        """Item id, score, first word and end word of the best passage of each leaked item."""
        words = self.number(text)
        where, seed = self.find(self._codes(words), self.seeds)
        ranges: dict[int, list[list[int]]] = {}
        for at, s in zip(where.tolist(), seed.tolist()):
            for item, offset in self.places[s]:
                length = len(self.words[item])
                slack = length // 2
                low, high = max(0, at - offset - slack), at - offset + length + slack
                spans = ranges.setdefault(item, [])
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high)
                    spans[-1][0] = min(spans[-1][0], low)
                else:
                    spans.append([low, high])
        found = []
        for item, spans in ranges.items():
            own, best = self.words[item], None
            need = needed_score(len(own), min_score)
            have = Counter(own.tolist())
            for low, high in spans:
                passage = words[low:high]
                # No alignment matches more words than the two have in common.
                if MATCH * np.isin(passage, own).sum() < need:
                    continue
                shared = Counter(passage[passage > 0].tolist()) & have
                if MATCH * shared.total() < need:
                    continue
                score, end = align(own, passage)
                if score >= need and (best is None or score > best[0]):
                    _, back = align(own[::-1], passage[:end][::-1])
                    best = (score, low + end - back, low + end)
            if best:
                found.append((self.ids[item], best[0] / (MATCH * len(own)), best[1], best[2]))
        return sorted(found, key=lambda f: (f[2], f[3]))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items, ``BLOCK_CHARS`` characters at a time (a longer item is a block of its own)."""
    items = benchmark.select(
        F.col(item_col).alias("item_id"),
        text_of(text_col).alias("text"),
        F.monotonically_increasing_id().alias("_tie"),
    ).withColumn("_chars", F.length("text").cast("bigint"))
    placed = global_order(materialize(items, "items"), ["item_id", "_tie"], "_chars")
    placed = materialize(placed.withColumn("_block", F.floor(F.col("_before") / BLOCK_CHARS)), "item-blocks")
    for (block,) in placed.select("_block").distinct().orderBy("_block").collect():
        rows = placed.where(F.col("_block") == block).orderBy("_row").collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def build_indexes(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id"
) -> Iterator[ItemIndex]:
    """An index for each block of items, its seeds chosen by the frequencies in ``docs``."""
    texts = docs.select(text_of(text_col).alias("text"))
    for items in _blocks(benchmark, item_col, text_col):
        index = ItemIndex(items)
        if not len(index.grams):
            continue

        def count(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            documents = np.zeros(len(index.grams), np.int64)
            for part in slices(batches):
                for text in part.column(0).to_pylist():
                    _, at = index.find(index._codes(index.number(text)), index.grams)
                    documents[np.unique(at)] += 1
            seen = np.flatnonzero(documents)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(documents[seen])], names=["gram", "n"])

        frequency = np.zeros(len(index.grams), np.int64)
        # At most one row per n-gram of the block.
        counted = texts.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n"))
        for gram, n in counted.collect():
            frequency[gram] = n
        index.choose_seeds(frequency)
        yield index


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_score: float = MIN_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word`` for every document that holds an item.

    One row per document and item: its best passage. Documents without a leak have no
    row; NULL and empty texts never have one. Repeated documents and items give rows each.
    ``score`` is the share of the item's own score, so a long run of a long item may have one
    below ``min_score``. An empty table on either side gives no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    item_type = benchmark.schema[item_col].dataType
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("item_id", item_type),
            T.StructField("score", T.DoubleType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("end_word", T.LongType()),
        ]
    )
    item_arrow = to_arrow_type(item_type)
    found = docs.sparkSession.createDataFrame([], schema)
    for index in build_indexes(docs, benchmark, text_col, item_col):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                rows = [index.matches(t, min_score) for t in part.column(1).to_pylist()]
                owner = [i for i, r in enumerate(rows) for _ in r]
                item, score, start, end = zip(*chain.from_iterable(rows)) if owner else ((),) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(item, item_arrow),
                        pa.array(score, pa.float64()),
                        pa.array(start, pa.int64()),
                        pa.array(end, pa.int64()),
                    ],
                    names=schema.names,
                )

        found = found.unionByName(source.mapInArrow(run, schema))
    return found


def _is_clean(index: ItemIndex, min_score: float):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not index.matches(t, min_score) for t in texts], dtype=bool)

    return clean


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    kept = docs
    for index in build_indexes(docs, benchmark, text_col):
        kept = kept.where(_is_clean(index, min_score)(text_of(text_col)))
    return kept
