"""What several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.session import scratch_path

# A word is a run of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Rows that a Python worker unpacks at once; bounds its memory, not the result.
SLICE_ROWS = 128


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps and lost
    executors start from the files, not from the plan that made them."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_of(column: str) -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_crc(column: str) -> Column:
    """CRC-32 of the id's decimal text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")))


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, so that sums of hashes become hashes again."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
