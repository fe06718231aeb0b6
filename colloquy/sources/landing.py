"""Transcript files as a data source: `spark.read.format("landing")`, and `readStream` over files as they arrive.

    register(spark)
    spark.read.format("landing").load(folder).filter(F.col("path").startswith(...) & F.col("name").endswith(".md"))

Rows are those of `transcripts.scan`, with each file's name, created time, etag and content type. The folder is listed
once, by the driver's Python; partitions are runs of files of about `partitionBytes`, which tasks read one file at a
time. Filters on `path` and `name` (equality, prefix, suffix, substring) and on the `etag` are applied to the listing,
so files that they rule out are never opened, if `spark.sql.python.filterPushdown.enabled` is on; `register` sets it.

A stream's offset is a place in the listing: the modification time and the path of the last file taken. Files are taken
in that order, once they are `settleSeconds` old, so that files of the same time are all there; a file that is put in
place with an older time than the offset isn't seen. A file that is written again is a new one, as its time is.

Options: `path`, `recursive` (true), `suffixes` (`.md,.txt`, whatever their case), `partitionBytes` (32 MB),
`settleSeconds` (2). Folders are reached by pyarrow (local and mounted paths, file:, s3:, gs:, hdfs:, with s3a: as s3:);
for other stores `transcripts.scan` reads by Spark's own file systems.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

SCHEMA = "path string, name string, stem string, size bigint, created timestamp, modified timestamp, etag string, content_type string, md5 string, text string"
# Types of files by their endings.
TYPES = {"txt": "text/plain", "md": "text/markdown"}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark: SparkSession) -> None:
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Landing)


def store_of(uri: str):
    """The file system of a folder as pyarrow has it, and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri("file:///" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri)


@dataclass(frozen=True, order=True)
class File:
    modified_ns: int
    path: str
    size: int

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]

    @property
    def etag(self) -> str:
        """Changes whenever the file is written again."""
        return hashlib.md5(f"{self.path}|{self.size}|{self.modified_ns}".encode()).hexdigest()


@dataclass
class Run(InputPartition):
    files: tuple[File, ...]


@dataclass
class Folder:
    """What is listed: a folder, by its options."""

    uri: str
    recursive: bool
    suffixes: tuple[str, ...]
    partition_bytes: int
    settle_s: float

    @classmethod
    def of(cls, options: dict) -> Folder:
        if "path" not in options:
            raise ValueError("landing: a path is needed")
        return cls(options["path"].rstrip("/"), options.get("recursive", "true").lower() == "true", tuple(options.get("suffixes", ".md,.txt").lower().split(",")), int(options.get("partitionBytes", 32 << 20)), float(options.get("settleSeconds", 2)))

    def store(self):
        """The file system, and the folder's path in it."""
        return store_of(self.uri)

    def files(self) -> list[File]:
        """All transcript files, oldest first."""
        from pyarrow import fs

        store, folder = self.store()
        found = store.get_file_info(fs.FileSelector(folder, recursive=self.recursive, allow_not_found=True))
        hidden = lambda path: any(part.startswith((".", "_")) for part in path.removeprefix(folder).split("/"))
        return sorted(File(f.mtime_ns or 0, f.path, f.size or 0) for f in found if f.type == fs.FileType.File and f.path.lower().endswith(self.suffixes) and not hidden(f.path))

    def runs(self, files: Iterable[File]) -> list[Run]:
        """Files in partitions of about partition_bytes; a larger file is one of its own. No files are one empty partition."""
        out, run, held = [], [], 0
        for f in files:
            if run and held + f.size > self.partition_bytes:
                out.append(Run(tuple(run)))
                run, held = [], 0
            run.append(f)
            held += f.size
        return [*out, Run(tuple(run))] if run or not out else out

    def rows(self, run: Run) -> Iterator[tuple]:
        store, _ = self.store()
        for f in run.files:
            with store.open_input_stream(f.path) as stream:
                data = stream.read()
            at = dt.datetime.fromtimestamp(f.modified_ns / 1e9, dt.timezone.utc)
            stem, _, ending = f.name.rpartition(".")
            yield f.path, f.name, stem, len(data), at, at, f.etag, TYPES.get(ending.lower(), "text/plain"), hashlib.md5(data).hexdigest(), data.decode("utf-8", "replace")


def test_of(given: Filter):
    """Of a filter on what a listing knows, whether a file passes; None for any other filter."""
    column = ".".join(given.attribute) if hasattr(given, "attribute") else None
    if column not in ("path", "name", "etag"):
        return None
    said = lambda f: getattr(f, column)
    match given:
        case EqualTo(value=v):
            return lambda f: said(f) == v
        case In(value=vs):
            return lambda f: said(f) in vs
        case StringStartsWith(value=v):
            return lambda f: said(f).startswith(v)
        case StringEndsWith(value=v):
            return lambda f: said(f).endswith(v)
        case StringContains(value=v):
            return lambda f: v in said(f)
    return None


class Reader(DataSourceReader):
    def __init__(self, folder: Folder):
        self.folder, self.tests = folder, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for given in filters:
            test = test_of(given)
            if test is None:
                yield given
            else:
                self.tests.append(test)

    def partitions(self) -> list[Run]:
        return self.folder.runs(f for f in self.folder.files() if all(test(f) for test in self.tests))

    def read(self, partition: Run) -> Iterator[tuple]:
        return self.folder.rows(partition)


class StreamReader(DataSourceStreamReader):
    """Offsets are {"modified_ns", "path"} of the last file taken."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"modified_ns": -1, "path": ""}

    def latestOffset(self) -> dict:
        ready = time.time_ns() - int(self.folder.settle_s * 1e9)
        last = max((f for f in self.folder.files() if f.modified_ns <= ready), default=None)
        return self.initialOffset() if last is None else {"modified_ns": last.modified_ns, "path": last.path}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        place = lambda o: (o["modified_ns"], o["path"])
        return self.folder.runs(f for f in self.folder.files() if place(start) < (f.modified_ns, f.path) <= place(end))

    def read(self, partition: Run) -> Iterator[tuple]:
        return self.folder.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class Landing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(Folder.of(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(Folder.of(self.options))
