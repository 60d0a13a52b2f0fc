"""Landed record snapshots, zipped or plain, as a Spark data source: ``spark.read.format("record_files").load(folder)``.

Each row is a record by the rules of CSV with tabs: separators and line ends inside quotes belong to their field, two quotes
are one. A quote may open anywhere before, so a file is read from its start by one task, as a stream and in batches of bounded size; files are packed into partitions
of some ``partition_bytes``. An archive that is broken anywhere gives no record but one row with its ``error``; its
check sums are tested before its first record is given.

As a stream (``readStream``) files are taken in order of their names, which for snapshots is the order of time: a file that lands with a
name before one that has been read is not seen.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, member string, row long, fields array<string>, error string"
ARROW = pa.schema([("file", pa.string()), ("member", pa.string()), ("row", pa.int64()), ("fields", pa.list_(pa.string())), ("error", pa.string())])
ROWS = 2_000
BYTES = 64 << 20
#: No field is longer than a file may be.
LONGEST_FIELD = 1 << 30


class Files(InputPartition):
    def __init__(self, names: list[str]) -> None:
        self.names = names


def _files(folder: str) -> list[tuple[str, int]]:
    """Names and sizes of a folder's files, in order of their names; hidden ones are left out."""
    system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    found = system.get_file_info(fs.FileSelector(path))
    return sorted((f.base_name, f.size) for f in found if f.is_file and f.base_name[0] not in "._")


def _packed(files: list[tuple[str, int]], most: int) -> list[Files]:
    out, size = [], most
    for name, n in files:
        if size + n > most:
            out.append(Files([]))
            size = 0
        out[-1].names.append(name)
        size += n
    return out


def _records(text: Iterator[str], file: str, member: str) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(LONGEST_FIELD)
    rows: list = []
    for n, fields in enumerate(csv.reader(text, delimiter="\t")):
        rows.append((file, member, n, fields, None))
        if len(rows) == ROWS:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


def _read(folder: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    text = lambda raw: io.TextIOWrapper(raw, "utf-8", "ignore", newline="")
    for name in names:
        with system.open_input_file(f"{path}/{name}") as raw:
            if not name.endswith(".zip"):
                yield from _records(text(raw), name, "")
                continue
            try:
                archive = zipfile.ZipFile(raw)
                if bad := archive.testzip():
                    raise zipfile.BadZipFile(f"bad check sum: {bad}")
            except (zipfile.BadZipFile, zipfile.LargeZipFile, EOFError, OSError, NotImplementedError, ValueError, RuntimeError) as e:
                yield _batch([(name, None, None, None, f"{type(e).__name__}: {e}")])
                continue
            for member in archive.namelist():
                with archive.open(member) as m:
                    yield from _records(text(m), name, member)


class _Reader(DataSourceReader):
    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder, most

    def partitions(self) -> list[Files]:
        return _packed(_files(self.folder), self.most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from _read(self.folder, partition.names)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder, most

    def initialOffset(self) -> dict:  # noqa: N802
        return {"last": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"last": max((n for n, _ in _files(self.folder)), default="")}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        return _packed([f for f in _files(self.folder) if start["last"] < f[0] <= end["last"]], self.most)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from _read(self.folder, partition.names)


class RecordFiles(DataSource):
    """Options: ``path`` and ``partition_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        return SCHEMA

    def _own(self) -> tuple[str, int]:
        return self.options["path"].rstrip("/"), int(self.options.get("partition_bytes", BYTES))

    def reader(self, schema) -> _Reader:
        return _Reader(*self._own())

    def streamReader(self, schema) -> _StreamReader:  # noqa: N802
        return _StreamReader(*self._own())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordFiles)
