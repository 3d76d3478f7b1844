"""Near copies by SimHash, then MinHash for those beyond its ball; every link is checked exactly.

Every text is the set of its shingles. Texts with equal sets are one content. The SimHash
fingerprints of the contents meet by ball hashing (see ``simhash.near_links``), and those at
most ``RADIUS`` bits apart are linked where the exact similarity is high enough. Texts of
similarity 0.8 are about ten bits apart, too far for a ball, so contents that share a band of
MinHash values meet as well. A group is what links reach, so pairs within one group need no
link of their own. Each member of a meeting is held against the ones that come first in
``ELECTED`` orders, one common to all bands and the others different from band to band, which
joins large groups of copies at a linear cost. Then every pair of a meeting that still lies in two
groups is looked at: directly where such pairs are few for the meeting's size, and otherwise
(pages of one template, say) by an exact prefix join of the members' shingles, rarest first. No
pair of a meeting is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import ASCII_LOWER, WORD, materialize, mix64, slices, text_of
from textquarry.llm.components import connected_components
from textquarry.llm.simhash import keep_one, majority, near_links

SHINGLE = 5
MIN_JACCARD = 0.8
RADIUS = 2
# Two texts of similarity 0.8 share none of the bands with a chance of 5 in 100 000.
BANDS, ROWS = 25, 5
# Pairs in two groups that a meeting compares directly, per member; beyond that the prefix join takes over.
DIRECT = 4
ELECTED = 5
SEED = 42

_RANDOM = np.random.default_rng(SEED)
_XOR = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
_FACTOR = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of a text's different shingles; a shorter text is one shingle."""
    words = WORD.findall(text.translate(ASCII_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    width = min(shingle, len(words))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    n = len(words) - width + 1
    code = np.full(n, width, np.uint64)
    for i in range(width):
        code = mix64(code * _STEP + hashes[i : i + n])
    return np.unique(code)


def content_of(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED)


def bands(own: np.ndarray) -> np.ndarray:
    """A number for each band of MinHash values."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for start in range(0, len(own), 4096):  # a few MB at a time, however long the text
        least = np.minimum(least, ((own[start : start + 4096] ^ _XOR) * _FACTOR).min(axis=1))
    code = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        code = mix64(code * _STEP + column)
    return code.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _sketches(keyed: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, content, fp, bands`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in ("doc_id", "h1", "h2")],
                    _signed([content_of(s) for s in sets]),
                    _signed([majority(s) for s in sets]),
                    pa.array([bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "h1", "h2", "content", "fp", "bands"],
            )

    schema = T.StructType(
        [
            *[keyed.schema[c] for c in ("doc_id", "h1", "h2")],
            T.StructField("content", T.LongType()),
            T.StructField("fp", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    return keyed.select("doc_id", "h1", "h2", "text").mapInArrow(run, schema)


def _sets(texts: DataFrame) -> DataFrame:
    """``content, shingles`` of ``content, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = [shingles(t).tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary())], names=["content", "shingles"])

    return texts.select("content", "text").mapInArrow(run, "content bigint, shingles binary")


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` of contents whose exact similarity is at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            left, right = part.column("left").to_pylist(), part.column("right").to_pylist()
            fits = [
                jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least for x, y in zip(left, right)
            ]
            yield part.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    both = pairs.join(sets.select(F.col("content").alias("b"), F.col("shingles").alias("right")), "b").join(
        sets.select(F.col("content").alias("a"), F.col("shingles").alias("left")), "a"
    )
    short, long = (f(F.length("left"), F.length("right")) for f in (F.least, F.greatest))
    return both.where(short >= least * long).select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def ball_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: contents whose fingerprints meet in a ball.

    ``prints`` has ``content, fp``. The least content of a fingerprint stands for it: the other
    contents of the fingerprint are held against it, and it against those of near fingerprints.
    """
    first = materialize(prints.groupBy("fp").agg(F.min("content").alias("_first")), "fingerprints")
    same = prints.join(first, "fp").select("content", F.col("_first").alias("other"))
    named = [first.select(F.col("fp").alias(c), F.col("_first").alias(f"_{c}")) for c in ("a", "b")]
    near = near_links(first.select("fp"), radius).join(named[0], "a").join(named[1], "b").select("_a", "_b")
    pairs = same.where(F.col("content") != F.col("other")).union(near)
    return pairs.select(F.greatest("content", "other").alias("a"), F.least("content", "other").alias("b")).distinct()


def _elected(met: DataFrame, salts: list[Column]) -> DataFrame:
    """``a, b``: each member of a meeting with those that come first in the salted orders."""
    firsts = met.groupBy("meeting").agg(
        *[F.min(F.col("content").bitwiseXOR(s)).bitwiseXOR(s).alias(f"_{k}") for k, s in enumerate(salts)]
    )
    chosen = F.explode(F.array_distinct(F.array(*[f"_{k}" for k in range(len(salts))])))
    pairs = met.join(firsts, "meeting").select("content", chosen.alias("_first"))
    return (
        pairs.where(F.col("content") != F.col("_first"))
        .select(F.greatest("content", "_first").alias("a"), F.least("content", "_first").alias("b"))
        .distinct()
    )


def _between_groups(pairs: DataFrame, component: DataFrame) -> DataFrame:
    named = [component.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")]
    joined = pairs.join(named[0], "a", "left").join(named[1], "b", "left")
    return joined.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _merged(component: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` after ``links a, b`` between different groups: only the groups are joined anew."""
    named = [component.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")]
    between = links.join(named[0], "a", "left").join(named[1], "b", "left")
    groups = materialize(
        connected_components(between.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))), "merged"
    )
    above = groups.select(F.col("node").alias("component"), F.col("component").alias("_above"))
    known = component.join(above, "component", "left").select("node", F.coalesce("_above", "component").alias("component"))
    # A content without a link so far has its own name and no row in ``component``.
    return known.union(groups.join(component, "node", "left_anti"))


def _pairs(left: DataFrame, right: DataFrame, key: str, fits: Column) -> DataFrame:
    """``a, b`` of the different groups that ``key`` brings together and ``fits`` lets through."""
    apart = (F.col("l._group") != F.col("r._group")) & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    joined = left.alias("l").join(right.alias("r"), apart & fits)
    return joined.select(F.greatest("l.content", "r.content").alias("a"), F.least("l.content", "r.content").alias("b"))


def _elements(sets: DataFrame) -> DataFrame:
    """``content, _group, shingle, n`` of every shingle of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own = [np.frombuffer(x, np.int64) for x in part.column("shingles").to_pylist()]
            sizes = np.array([len(x) for x in own], np.int64)
            at = np.repeat(np.arange(len(own)), sizes)
            if len(at):
                rows = part.select(["content", "_group"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.concatenate(own)), pa.array(sizes[at])],
                    names=["content", "_group", "shingle", "n"],
                )

    return sets.select("content", "_group", "shingles").mapInArrow(
        run, "content bigint, _group bigint, shingle bigint, n bigint"
    )


def prefix_pairs(sets: DataFrame, least: float) -> DataFrame:
    """``a, b``: the pairs of different groups that may reach ``least``, none left out.

    ``sets`` has ``content, _group, shingles``. With all shingles in one order, rarest
    first, two sets of ``m <= n`` shingles that share ``k = least / (1 + least) * (m + n)`` of
    them have their first common one among the first ``n - k + 1`` of the larger. The
    smaller set needs only its first ``m - 2 * least / (1 + least) * m + 1``, since ``n`` is not less
    than ``m``: texts that share too little to be copies share none of those.
    """
    elements = materialize(_elements(sets), "elements")
    common = elements.groupBy("shingle").agg(F.count("*").alias("often"))
    place = F.row_number().over(W.partitionBy("content").orderBy("often", "shingle"))
    ordered = elements.join(common, "shingle").withColumn("place", place)
    probe_length = F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1
    share = least / (1 + least)
    prefixes = materialize(ordered.where(F.col("place") <= probe_length).drop("often"), "prefixes")
    index = prefixes.where(F.col("place") <= F.col("n") - F.ceil(2 * share * F.col("n") - 1e-9) + 1)
    smaller = F.struct("l.n", "l.content") < F.struct("r.n", "r.content")
    close = F.col("l.n") >= least * F.col("r.n") - 1e-9
    rest = 1 + F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place"))
    enough = rest >= share * (F.col("l.n") + F.col("r.n")) - 1e-9
    return _pairs(index, prefixes, "shingle", smaller & close & enough).distinct()


def _apart(met: DataFrame, component: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``a, b``: every pair of a meeting in two groups that may be similar."""
    named = component.select(F.col("node").alias("content"), F.col("component").alias("_group"))
    grouped = met.join(named, "content", "left").withColumn("_group", F.coalesce("_group", "content"))
    grouped = materialize(grouped, "grouped-meetings")
    sizes = grouped.groupBy("meeting", "_group").agg(F.count("*").alias("n")).groupBy("meeting").agg(
        F.sum("n").alias("members"), F.sum(F.col("n") * F.col("n")).alias("inside")
    )
    cross = (F.col("members") * F.col("members") - F.col("inside")) / 2
    mixed = materialize(
        sizes.where(cross > 0).select("meeting", (cross <= DIRECT * F.col("members")).alias("few")), "mixed-meetings"
    )
    few = grouped.join(mixed.where("few").select("meeting"), "meeting")
    direct = _pairs(few, few, "meeting", F.col("l.content") > F.col("r.content")).distinct()
    many = grouped.join(mixed.where("not few").select("meeting"), "meeting").select("content", "_group").distinct()
    return direct.union(prefix_pairs(sets.join(many, "content"), least)).distinct()


def keep_one_per_copy(docs: DataFrame, least: float = MIN_JACCARD) -> DataFrame:
    """One row of ``docs`` for each group of near copies (see ``keep_one``).

    A group is what links between texts of similarity ``least`` or more reach. Texts meet by their
    SimHash fingerprints, and every pair that meets in a band is linked if it is that similar;
    two texts of similarity 0.8 meet in no band with a chance of 5 in 100 000. NULL, empty and
    blank texts are copies of each other.
    """
    keyed = docs.select("doc_id", text_of("text").alias("text")).withColumns(
        {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(SEED), "text")}
    )
    rows = materialize(_sketches(keyed), "sketches")
    # Equal contents have equal bands.
    own_bands = rows.select("content", F.explode("bands").alias("meeting")).distinct()
    shared = own_bands.groupBy("meeting").count().where("count > 1").select("meeting")
    met = materialize(own_bands.join(shared, "meeting"), "meetings")
    balls = materialize(ball_pairs(rows.where(F.size("bands") > 0).select("content", "fp").distinct()), "ball-pairs")
    meeting = met.select("content").union(balls.select("a")).union(balls.select("b")).distinct()
    # One text of each content that meets another; contents first, as one may have very many rows.
    texts = rows.groupBy("content").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "h1")).alias("_row")
    )
    texts = texts.select("content", F.col("_row.doc_id").alias("_id"), F.col("_row.h1").alias("_h1"))
    texts = texts.join(meeting, "content", "left_semi")
    of_row = (keyed["h1"] == texts["_h1"]) & keyed["doc_id"].eqNullSafe(texts["_id"])
    sets = materialize(_sets(keyed.join(texts, of_row)).dropDuplicates(["content"]), "shingle-sets")

    links = materialize(_similar(balls, sets, least), "ball-links")
    # What a link leads to is group enough to leave out pairs that are joined already.
    near = materialize(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "ball-groups")
    salts = [F.lit(0).cast("bigint"), *[F.xxhash64("meeting", F.lit(k)) for k in range(ELECTED - 1)]]
    others = materialize(_between_groups(_elected(met, salts), near), "elected")
    links = links.union(materialize(_similar(others, sets, least), "elected-links"))
    component = materialize(connected_components(links), "elected-components")
    apart = materialize(_apart(met, component, sets, least), "apart")
    more = materialize(_similar(apart, sets, least), "more-links")
    component = materialize(_merged(component, more), "components")
    groups = rows.select("doc_id", "h1", "h2", "content").join(
        component.withColumnRenamed("node", "content"), "content", "left"
    )
    return keep_one(docs, groups.withColumn("component", F.coalesce("component", "content")))
