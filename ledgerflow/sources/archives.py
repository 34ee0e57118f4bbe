"""Tab-separated members of zip archives, as a data source that reads and writes them.

    spark.dataSource.register(ZippedTables)
    spark.read.format("zipped_tables").option("member", "INFOTABLE.tsv").schema("a string, b string").load(folder)

Reading plans one partition for each archive and member and streams its rows: a member of any
size is held a batch of rows at a time. Only the columns of the schema are kept. Writing puts
each partition into an archive of its own under a name that is new, and moves them all to their place when the
job ends; what a lost task wrote stays behind in a folder that goes then.

Paths are of any file system that Arrow knows (file, hdfs, s3, ...).
"""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Rows of a batch, and fields' encoding where the option does not say another.
BATCH_ROWS, ENCODING = 20_000, "latin-1"


def opened(path: str):
    """The file system of a path or URI, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def archives(path: str) -> list[str]:
    """The zip files of a folder, in order of name, or the one file."""
    from pyarrow import fs

    system, at = opened(path)
    head = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = system.get_file_info(at)
    if info.type == fs.FileType.Directory:
        found = [f.path for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File]
        return [head + f for f in sorted(found) if f.lower().endswith(".zip") and "/_staging-" not in f]
    return [path] if info.type == fs.FileType.File else []


@dataclass
class Member(InputPartition):
    path: str
    name: str


@dataclass
class Archives(WriterCommitMessage):
    names: list[str]


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.fields = schema.names
        self.path, self.wanted = options["path"], options.get("member", "").lower()
        self.delimiter, self.encoding = options.get("delimiter", "\t"), options.get("encoding", ENCODING)

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in archives(self.path):
            system, at = opened(path)
            with system.open_input_file(at) as f, zipfile.ZipFile(f) as z:  # the directory alone is read here
                out += [Member(path, n) for n in z.namelist() if not n.endswith("/") and n.lower().rsplit("/", 1)[-1].endswith(self.wanted)]
        return out or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in self.fields])
        if not partition.path:
            return
        system, at = opened(partition.path)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as z, z.open(partition.name) as raw:
            rows = csv.reader(io.TextIOWrapper(raw, self.encoding, newline=""), delimiter=self.delimiter, quoting=csv.QUOTE_NONE)
            head = next(rows, [])
            place = [head.index(n) if n in head else -1 for n in self.fields]
            kept: list[list[str | None]] = [[] for _ in place]
            for row in rows:
                for column, i in zip(kept, place, strict=True):
                    column.append(row[i] if 0 <= i < len(row) and row[i] != "" else None)
                if kept and len(kept[0]) >= BATCH_ROWS:
                    yield pa.record_batch([pa.array(c, pa.string()) for c in kept], schema)
                    kept = [[] for _ in place]
            if kept and kept[0]:
                yield pa.record_batch([pa.array(c, pa.string()) for c in kept], schema)


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.member, self.overwrite = options["path"].rstrip("/"), options.get("member", "rows.tsv"), overwrite
        self.delimiter, self.encoding = options.get("delimiter", "\t"), options.get("encoding", ENCODING)
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        first = next(iterator, None)
        if first is None:
            return Archives([])
        name = f"{uuid.uuid4().hex}.zip"
        system, at = opened(f"{self.staging}/{name}")
        system.create_dir(at.rsplit("/", 1)[0])
        clean = lambda v: "" if v is None else str(v).translate({ord(c): " " for c in "\r\n" + self.delimiter})
        with system.open_output_stream(at) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z, z.open(self.member, "w", force_zip64=True) as out:
            out.write((self.delimiter.join(first.__fields__) + "\n").encode(self.encoding))
            while first is not None:
                out.write((self.delimiter.join(map(clean, first)) + "\n").encode(self.encoding, "replace"))
                first = next(iterator, None)
        return Archives([name])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, at = opened(self.path)
        before = archives(self.path) if self.overwrite else []
        for n in (n for m in messages if m for n in m.names):
            system.move(opened(f"{self.staging}/{n}")[1], f"{at}/{n}")
        for path in before:
            system.delete_file(opened(path)[1])
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, at = opened(self.staging)
        if system.get_file_info(at).type == fs.FileType.Directory:
            system.delete_dir(at)


class ZippedTables(DataSource):
    """Options: path, member (ending of its name, any case), delimiter, encoding."""

    @classmethod
    def name(cls) -> str:
        return "zipped_tables"

    def schema(self) -> StructType:
        """All columns of the first member's heading, as texts."""
        reader = _Reader(StructType(), self.options)
        part = reader.partitions()[0]
        if not part.path:
            raise ValueError(f"no archive with the member in {self.options['path']}")
        system, at = opened(part.path)
        with system.open_input_file(at) as f, zipfile.ZipFile(f) as z, z.open(part.name) as raw:
            head = next(csv.reader(io.TextIOWrapper(raw, reader.encoding), delimiter=reader.delimiter, quoting=csv.QUOTE_NONE), [])
        out = StructType()
        for n in head:
            out.add(n, "string")
        return out

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, overwrite)
