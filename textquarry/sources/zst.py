"""A sink for Zstandard-compressed JSON lines.

Spark reads ``.zst`` files by itself, as a stream and from any store (``read_jsonl``), but has
no codec to write them. This data source takes one column of lines; every task compresses its
own as they come and writes one file, so neither side holds more than a block of a file.
A file gets its final name when the job commits, so failed and repeated tasks leave nothing
that a reader would see.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SUFFIX = ".jsonl.zst"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI or absolute path, and the path within it."""
    return pafs.FileSystem.from_uri(path)


@dataclass
class _Written(WriterCommitMessage):
    file: str | None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, level: int, overwrite: bool):
        self.path, self.level, self.job = path, level, uuid.uuid4().hex
        store, folder = _store(path)
        if overwrite and store.get_file_info(folder).type != pafs.FileType.NotFound:
            store.delete_dir_contents(folder)
        store.create_dir(f"{folder}/_temporary-{self.job}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        import zstandard

        store, folder = _store(self.path)
        name, raw, out = f"part-{uuid.uuid4().hex}{SUFFIX}", None, None
        for batch in iterator:
            for line in batch.column(0).to_pylist():
                if out is None:
                    raw = store.open_output_stream(f"{folder}/_temporary-{self.job}/{name}", compression=None)
                    out = zstandard.ZstdCompressor(level=self.level).stream_writer(raw, closefd=False)
                out.write(line.encode() + b"\n")
        if out is not None:
            out.close()
            raw.close()
        return _Written(None if out is None else name)

    def commit(self, messages: list[_Written | None]) -> None:
        store, folder = _store(self.path)
        for message in messages:
            if message is not None and message.file:
                store.move(f"{folder}/_temporary-{self.job}/{message.file}", f"{folder}/{message.file}")
        store.delete_dir(f"{folder}/_temporary-{self.job}")

    def abort(self, messages: list[_Written | None]) -> None:
        store, folder = _store(self.path)
        store.delete_dir(f"{folder}/_temporary-{self.job}")


class JsonLinesZst(DataSource):
    """``path`` and ``level`` (3) are its options."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_zst"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options.get("level", 3)), overwrite)


def write_jsonl_zst(df: DataFrame, path: str, level: int = 3) -> None:
    """All columns as JSON lines in ``.jsonl.zst`` files below ``path``; NULL fields are left out."""
    df.sparkSession.dataSource.register(JsonLinesZst)
    lines = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    lines.write.format("jsonl_zst").mode("overwrite").option("level", level).save(path)
