"""Removal of documents that share long word sequences with benchmark items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import let
from textquarry.functions.text import words

N_GRAM = 13
# Words of 64 bits in the Bloom filter: 8 MB of bits, whatever the size of the index.
BLOOM_WORDS = 1 << 20
BLOOM_BITS = 4


def normalized_words(text: Column) -> Column:
    """Lower-case words without punctuation."""
    return words(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N} \t\n\r\f\x0B]", " "))


def ngrams(text: Column, n: int = N_GRAM) -> Column:
    """Distinct n-grams of a whole text, each as one string."""
    return _distinct_slices(text, n, lambda gram: F.array_join(gram, " "))


def ngram_hashes(text: Column, n: int = N_GRAM) -> Column:
    """Distinct 8-byte hashes of the n-grams of a whole text."""
    return _distinct_slices(text, n, F.xxhash64)


def _distinct_slices(text: Column, n: int, of) -> Column:
    def cut(w: Column) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.array_distinct(F.transform(starts, lambda i: of(F.slice(w, i, F.lit(n)))))

    return let(normalized_words(text), cut)


def build_ngram_index(
    benchmark: DataFrame, text: str = "text", query: str | None = None, n: int = N_GRAM
) -> DataFrame:
    """Distinct n-grams of the benchmark: of the answer text, of the query, and across their seam."""
    fields = [F.col(text)]
    if query:
        seam = F.concat_ws(
            " ", F.slice(normalized_words(F.col(query)), -(n - 1), n - 1), F.slice(normalized_words(F.col(text)), 1, n - 1)
        )
        long_query = F.size(normalized_words(F.col(query))) >= n - 1
        fields += [F.col(query), F.when(long_query, seam).otherwise(F.concat_ws(" ", query, text))]
    grams = F.array_distinct(F.flatten(F.array(*[ngrams(F.coalesce(f, F.lit("")), n) for f in fields])))
    return benchmark.select(F.explode(grams).alias("ngram")).distinct()


def _bloom_place(h: Column, words: int) -> tuple[Column, Column]:
    """The word of a hash, and its ``BLOOM_BITS`` bits within the word."""
    mixed = F.xxhash64(h)
    bits = [F.shiftrightunsigned(mixed, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BLOOM_BITS)]
    mask = reduce(lambda m, x: m.bitwiseOR(x), [F.call_function("shiftleft", F.lit(1).cast("bigint"), x) for x in bits])
    return F.pmod(F.shiftrightunsigned(mixed, 6 * BLOOM_BITS), F.lit(words)), mask


def bloom_filter(hashes: DataFrame, column: str = "h", words: int = BLOOM_WORDS) -> DataFrame:
    """``word, bits``: a blocked Bloom filter of a column of 8-byte hashes.

    Every hash sets a few bits of one word, and words are combined by OR on the map side
    first, so the filter has at most ``words`` rows however many hashes there are.
    """
    word, mask = _bloom_place(F.col(column), words)
    return hashes.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def may_contain(df: DataFrame, bloom: DataFrame, column: str = "h", words: int = BLOOM_WORDS) -> DataFrame:
    """The rows whose hash may be in the filter; all that are in it, and few others.

    The filter is broadcast: its size is fixed by ``words``.
    """
    word, mask = _bloom_place(F.col(column), words)
    placed = df.withColumns({"_word": word, "_mask": mask})
    met = placed.join(F.broadcast(bloom), F.col("_word") == F.col("word"))
    return met.where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*df.columns)


def contaminated_ids(
    df: DataFrame, index: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_GRAM, bloom_words: int = BLOOM_WORDS
) -> DataFrame:
    """Keys of documents that contain an indexed n-gram.

    The exploded n-grams of the documents meet a Bloom filter of the index within their
    task, and only the few that pass are shuffled: they are joined with the index's 8-byte hashes,
    and the documents left are matched on the n-grams themselves. The index may
    have any size; a larger one lets more hashes pass, never fewer.
    """
    wanted = index.select(F.xxhash64(F.split("ngram", " ")).alias("h")).distinct()
    hashed = df.select(key, F.explode(ngram_hashes(F.col(text), n)).alias("h"))
    passed = may_contain(hashed, bloom_filter(wanted, "h", bloom_words), "h", bloom_words)
    suspects = passed.join(wanted, "h", "left_semi").select(key).distinct()
    grams = df.join(suspects, key, "left_semi").select(key, F.explode(ngrams(F.col(text), n)).alias("ngram"))
    return grams.join(index, "ngram", "left_semi").select(key).distinct()


def decontaminate(
    df: DataFrame, index: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_GRAM, **options
) -> tuple[DataFrame, DataFrame]:
    """``(clean, removed)``: the document table split by contamination."""
    bad = contaminated_ids(df, index, key, text, n, **options)
    return df.join(bad, key, "left_anti"), df.join(bad, key, "left_semi")
