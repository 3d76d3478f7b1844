"""Best-fit packing of token pieces by bin completion.

Documents are tokenized and cut once, in Spark. How many pieces there are of each length
is a table of at most ``capacity`` rows, and it alone decides the packing: bin completion
takes the longest length that is left, enumerates the undominated fillings of the rest
of its bin, and branches on the filling and on how many bins get it, most of them first. The
best-fit-decreasing packing is the first incumbent, or where that misses the lower bound one that fills
bins exactly as long as it can, if it is better; a branch ends when the space it has
wasted, or its lower bound, shows that it cannot beat the incumbent, or when as few bins have
led to the same pieces left before. Nothing is left out of the enumeration, so a search that
ends by itself is optimal; one that spends its branches or steps keeps the incumbent. Pieces then find
their bin by their rank within their length, again in Spark.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from textquarry.llm.common import materialize, slices, text_of
from textquarry.llm.global_order import global_order

CAPACITY = 2048
END_ID = 0
CACHED_WORDS = 300_000
# Branches of a search, and steps of the enumeration of fillings in all of them.
MAX_NODES = 8_000
MAX_STEPS = 2_000_000
# So many fillings at a time are sorted by waste.
SORTED_FILLINGS = 50

# ---------------------------------------------------------------- tokens

# The vocabulary's own word pattern, written out for lower-case Latin-1 text. Only an
# apostrophe can start two kinds of word, so the order of the others doesn't matter.
_WORDS = re.compile(
    "[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:[stmd]|re|ve|ll)"
    "|[^a-z0-9\\t-\\r \x85\xa0\xaa\xb5\xba\xb2\xb3\xb9\xbc-\xbe\xdf-\xf6\xf8-\xff]+"
)


# The vocabulary is over bytes, each written as a character: printable ones as themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OF_BYTE = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}
_BYTES = {c: "".join(_OF_BYTE[b] for b in chr(c).encode()) for c in range(256) if _OF_BYTE.get(c) != chr(c) or c > 126}


class WordTokenizer:
    """Token ids of whole texts, remembering the ids of words it has seen.

    In this vocabulary a text is split into words first and no token crosses a word, so
    the ids of a text are those of its words. Texts with characters beyond Latin-1, or
    with the mark of a special token, go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = "the 'll don't r\xe9sum\xe9 \xe6\xff\xdf x2\xb2 \xa3\xa7 \x00\x1c\x7f\xad ~!"
        alone = b"".join(map(self._coded, _WORDS.findall(probe)))
        if alone != self._whole(probe).tobytes():
            raise ValueError("the vocabulary does not split texts as expected")
        # Two generations: a word that is met again while it is old becomes young.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _coded(self, word: str) -> bytes:
        """The ids of one lower-case Latin-1 word: straight from the merges, as it needs no splitting."""
        word = word if word.isascii() and word.isprintable() else word.translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        new = []
        for word in words:
            coded = self.old.get(word)
            if coded is None:
                new.append(word)
            else:
                self.young[word] = coded
        if not new:
            return
        for word in new:
            self.young[word] = self._coded(word)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split: list[list[str] | None] = []
        unknown: set[str] = set()
        for text in texts:
            try:
                text.encode("latin-1")
                plain = not any(s in text for s in self.special)
            except UnicodeEncodeError:
                plain = False
            words = _WORDS.findall(text.lower()) if plain else None
            split.append(words)
            if words:
                unknown.update(itertools.filterfalse(self.young.__contains__, words))
        if unknown:
            generation = self.young
            self._learn(unknown)
            if self.young is not generation:
                self._learn({w for words in split if words for w in words})
        known = self.young.__getitem__
        return [
            self._whole(text) if words is None else np.frombuffer(b"".join(map(known, words)), np.uint32)
            for text, words in zip(texts, split)
        ]


_LOADED: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that tasks share what it has seen."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every piece of every row.

    A document's tokens end with the id 0, so a NULL or empty text is one piece of length 1.
    """
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(path)
        for part in slices(batches, 64):
            owner, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, ids in enumerate(words.encode_batch(part.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for number, at in enumerate(range(0, len(ids), capacity)):
                    cut = ids[at : at + capacity]
                    owner.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    if keep_ids:
                        kept.append(cut.astype(np.int32))
            columns = [part.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    fields = [source.schema["doc_id"], T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return source.mapInArrow(run, T.StructType(fields))


# ---------------------------------------------------------------- bin completion


@dataclass(frozen=True)
class Filling:
    """``bins`` bins, each with ``uses`` pieces of each given length."""

    bins: int
    parts: tuple[tuple[int, int], ...]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing, all bins of one content at a time."""
    open_bins: dict[int, list[tuple[int, tuple]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_bins if r >= length):
            groups = open_bins.pop(room)
            fit = room // length
            while groups and left:
                bins, parts = groups.pop()
                filled = min(bins, left // fit)
                if filled < bins:
                    groups.append((bins - filled, parts))
                if filled:
                    after = room - fit * length
                    open_bins.setdefault(after, []).append((filled, parts + ((length, fit),)))
                    left -= filled * fit
                elif left:  # fewer than one bin would take
                    groups[-1] = (groups[-1][0] - 1, parts)
                    groups = [g for g in groups if g[0]]
                    open_bins.setdefault(room - left * length, []).append((1, parts + ((length, left),)))
                    left = 0
            if groups:
                open_bins.setdefault(room, []).extend(groups)
            if not left:
                break
        fit = capacity // length
        if left // fit:
            open_bins.setdefault(capacity - fit * length, []).append((left // fit, ((length, fit),)))
        if left % fit:
            rest = left % fit
            open_bins.setdefault(capacity - rest * length, []).append((1, ((length, rest),)))
    return [Filling(bins, parts) for groups in open_bins.values() for bins, parts in groups]


def _exact(left: dict[int, int], mask: int, mirror: int, room: int, capacity: int, most: int) -> tuple | None:
    """At most ``most`` pieces that are left and fill ``room`` exactly, longest first, or ``None``.

    Bit ``n`` of ``mask`` and bit ``capacity - n`` of ``mirror`` say that length ``n`` is left.
    """
    if mask >> room & 1:
        return (room,)
    if most == 1:
        return None
    below = (1 << room) - 1
    if most == 2:
        both = mask & (mirror >> (capacity - room)) & below
        n = both.bit_length() - 1
        if n * 2 == room and left[n] < 2:
            return None
        return (n, room - n) if n > 0 else None
    rest = mask & below
    while rest:
        n = rest.bit_length() - 1
        if n * most < room:
            return None
        rest ^= 1 << n
        more = _exact(left, mask, mirror, room - n, capacity, most - 1)
        if more and all(left[k] >= (n, *more).count(k) for k in (n, *more)):
            return (n, *more)
    return None


def least_waste(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Bin after bin the longest piece and what wastes the least of the rest, with few and long pieces.

    Best fit decides piece by piece and wastes a little in very many bins; here a bin is filled exactly
    as long as there are pieces for that, so only the last bins waste.
    """
    left, plan = dict(counts), []
    mask = sum(1 << n for n in left)
    mirror = sum(1 << (capacity - n) for n in left)

    def gone(n: int) -> None:
        nonlocal mask, mirror
        if not left[n]:
            mask &= ~(1 << n)
            mirror &= ~(1 << (capacity - n))

    while mask:
        room, uses = capacity, {}
        while room and (fits := mask & ((1 << (room + 1)) - 1)):
            n = fits.bit_length() - 1
            if uses and room <= 3 * n + 3:
                break
            # The longest piece, and more of them while three can't fill the rest.
            take = 1 if not uses else max(1, min(left[n], (room - 3 * n) // n))
            uses[n] = uses.get(n, 0) + take
            left[n] -= take
            gone(n)
            room -= take * n
        fits = mask & ((1 << (room + 1)) - 1)
        fill = None
        for target in range(room if fits else 0, 0, -1):
            if fill := _exact(left, mask, mirror, target, capacity, 3):
                break
        for n in fill or ():
            uses[n] = uses.get(n, 0) + 1
            left[n] -= 1
            gone(n)
        more = min(left[n] // k for n, k in uses.items())
        for n, k in uses.items():
            left[n] -= more * k
            gone(n)
        plan.append(Filling(1 + more, tuple(sorted(uses.items(), reverse=True))))
    return plan


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound: total length, and pieces that can't share a bin."""
    if not counts:
        return 0
    count = np.zeros(capacity + 2, np.int64)
    count[list(counts)] = list(counts.values())
    pieces = np.concatenate(([0], count.cumsum()))  # pieces[n]: shorter than n
    tokens = np.concatenate(([0], (count * np.arange(capacity + 2)).cumsum()))
    half = capacity // 2 + 1
    k = np.arange(half)  # pieces shorter than k are left out
    big = pieces[-1] - pieces[capacity - k + 1]
    middle = pieces[capacity - k + 1] - pieces[half]
    room = middle * capacity - (tokens[capacity - k + 1] - tokens[half])
    small = tokens[half] - tokens[k]
    return int((big + middle + np.maximum(0, -(-(small - room) // capacity))).max())


class Budget:
    """Branches and enumeration steps that a search may still spend."""

    def __init__(self, nodes: int, steps: int):
        self.nodes, self.steps = nodes, steps

    @property
    def spent(self) -> bool:
        return self.nodes <= 0 or self.steps <= 0


def fillings(counts: dict[int, int], largest: int, capacity: int, budget: Budget) -> Iterator[tuple]:
    """All undominated fillings of a bin that holds ``largest``, as they are found.

    A filling is dominated if one of its pieces can be exchanged for a longer one that is
    left and still fits, or if another piece still fits. With one piece that fills the
    bin exactly, that filling dominates all others. Fillings come ``SORTED_FILLINGS`` at a
    time, those of a portion by waste; the first ones take the most of the longest lengths.
    """
    room = capacity - largest
    available = dict(counts)
    available[largest] -= 1
    lengths = [n for n in sorted(available, reverse=True) if available[n] and n <= room]
    if not lengths:
        yield ((largest, 1),)
        return
    if lengths[0] == room:
        yield ((largest, 1), (room, 1))
        return

    def undominated() -> Iterator[tuple[int, tuple]]:
        # Next length to decide, room left, pieces taken, and how many of that length to try.
        stack = [(0, room, (), None)]
        while stack and not budget.spent:
            budget.steps -= 1
            at, left, parts, take = stack.pop()
            if take is None:
                while at < len(lengths) and lengths[at] > left:
                    at += 1
                if at == len(lengths):
                    used = dict(parts)
                    spare = [n for n in lengths if available[n] > used.get(n, 0)]
                    # Exchange or addition within the space left over would be at least as good.
                    if not left or not any(m < n <= m + left for m in [*used, 0] for n in spare):
                        yield left, parts
                    continue
                take = min(available[lengths[at]], left // lengths[at])
            n = lengths[at]
            if take:
                stack.append((at, left, parts, take - 1))
            stack.append((at + 1, left - take * n, parts + ((n, take),) if take else parts, None))

    found = undominated()
    while portion := list(itertools.islice(found, SORTED_FILLINGS)):
        portion.sort(key=lambda f: (f[0], len(f[1])))
        for _, parts in portion:
            yield ((largest, 1), *parts)


def _branches(left: dict[int, int], capacity: int, budget: Budget) -> Iterator[Filling]:
    """Every filling for the longest length, for the most bins, then for fewer and fewer."""
    largest = max(left)

    def each() -> Iterator[tuple[tuple, int]]:
        for parts in fillings(left, largest, capacity, budget):
            merged: dict[int, int] = {}
            for n, uses in parts:
                merged[n] = merged.get(n, 0) + uses
            yield tuple(merged.items()), min(left[n] // uses for n, uses in merged.items())

    for parts, most in each():
        yield Filling(most, parts)
    for parts, most in each():
        for bins in range(most - 1, 0, -1):
            yield Filling(bins, parts)


def _without(left: dict[int, int], filling: Filling) -> dict[int, int]:
    rest = dict(left)
    for n, uses in filling.parts:
        rest[n] -= filling.bins * uses
        if not rest[n]:
            del rest[n]
    return rest


def _state(left: dict[int, int]) -> bytes:
    return hashlib.blake2b(repr(sorted(left.items())).encode(), digest_size=16).digest()


def bin_completion(
    counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES, max_steps: int = MAX_STEPS
) -> list[Filling]:
    """Fillings that use every piece once, in as few bins as the search finds.

    Never more than best-fit decreasing needs. The packing is optimal if the incumbent
    meets the lower bound or the search runs out of branches; otherwise the search ends after
    ``max_nodes`` branches or ``max_steps`` steps of enumeration.
    """
    counts = {n: c for n, c in counts.items() if c}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    incumbent, bound = best_fit_decreasing(counts, capacity), lower_bound(counts, capacity)
    if counts and sum(f.bins for f in incumbent) > bound:
        incumbent = min(incumbent, least_waste(counts, capacity), key=lambda plan: sum(f.bins for f in plan))
    fewest = sum(f.bins for f in incumbent)
    total = sum(n * c for n, c in counts.items())
    budget = Budget(max_nodes, max_steps)
    seen: dict[bytes, int] = {}
    # One entry per depth: pieces left, bins so far, waste so far, fillings to try.
    path: list[Filling] = []
    depth = [(counts, 0, 0, _branches(counts, capacity, budget))] if counts else []
    while depth and fewest > bound and not budget.spent:
        left, bins, waste, branches = depth[-1]
        filling = next(branches, None)
        if filling is None:
            depth.pop()
            if path:
                path.pop()
            continue
        budget.nodes -= 1
        rest, bins = _without(left, filling), bins + filling.bins
        waste += filling.bins * (capacity - sum(n * uses for n, uses in filling.parts))
        if not rest:
            if bins < fewest:
                fewest, incumbent = bins, [*path, filling]
            continue
        # Waste bound: a better packing has at most so much empty space in all.
        if waste > (fewest - 1) * capacity - total or bins + lower_bound(rest, capacity) >= fewest:
            continue
        state = _state(rest)
        if seen.get(state, bins + 1) <= bins:
            continue
        seen[state] = bins
        path.append(filling)
        depth.append((rest, bins, waste, _branches(rest, capacity, budget)))
    return incumbent


# ---------------------------------------------------------------- placing pieces


@dataclass
class Placement:
    """Which sequence and offset the pieces of each length get, by rank within the length."""

    key: np.ndarray  # length << 40 | first rank
    first_bin: np.ndarray
    uses: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, plan: list[Filling]) -> Placement:
        rows, taken, first_bin = [], {}, 0
        for filling in plan:
            offset = 0
            for n, uses in filling.parts:
                rank = taken.get(n, 0)
                rows.append((n << 40 | rank, first_bin, uses, offset))
                taken[n] = rank + uses * filling.bins
                offset += n * uses
            first_bin += filling.bins
        rows.sort()
        return cls(*[np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 4)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 40 | rank, side="right") - 1
        within = rank - (self.key[at] & ((1 << 40) - 1))
        return self.first_bin[at] + within // self.uses[at], self.offset[at] + within % self.uses[at] * length


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, max_nodes: int = MAX_NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table with a column ``length``."""
    numbered = pieces.withColumn("_tie", F.monotonically_increasing_id())
    written = materialize(numbered, "pieces")
    ranked = global_order(written, ["length", "_tie"], "length")
    # At most ``capacity`` rows.
    by_length = ranked.groupBy("length").agg(F.count("*").alias("n"), F.min("_row").alias("_first")).collect()
    plan = bin_completion({r["length"]: r["n"] for r in by_length}, capacity, max_nodes)
    placement = Placement.of(plan)
    first = np.zeros(capacity + 1, np.int64)
    for r in by_length:
        first[r["length"]] = r["_first"]

    columns = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, row = batch.column("length").to_numpy(), batch.column("_row").to_numpy()
            sequence, offset = placement.place(length, row - first[length])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = T.StructType(
        pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.select(*columns, "_row").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Every row gives at least one piece, repeated rows theirs each; an empty table none.
    """
    return pack_pieces(tokenized_pieces(docs, tokenizer_path, capacity, id_col, text_col, keep_ids), capacity)
