"""A folder for each row and a file in it, on a store that all workers reach as local files; written and read by tasks.

The layout is that of Spark's writer partitioned by `name`: `name=<name>/part-<partition>-<attempt>.txt`.
"""

from __future__ import annotations

import bz2
import errno
import gzip
import json
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import suppress
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: What a task holds at once of the files that it reads: so many, or so many bytes and a file.
_FILES, _BYTES = 1000, 4 << 20
_ENTRIES = 10_000
# Spark's name of a folder for null, and the characters that it escapes in one.
_NULL = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def folder_name(name: str | None) -> str:
    """The folder of a name, as Spark's writers call it."""
    return "name=" + (_ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name) if name else _NULL)


def write(rows: DataFrame, path: str) -> None:
    """Replaces a folder by one of the rows (name, value), which are dealt and sorted by name.

    Each attempt of a task makes its folders in one of its own, as many tasks that make them in one folder wait for each
    other. Those of the attempts that count are then moved by few tasks, and the whole is put in place at the end; until
    then the old folder stays."""
    spark, path = rows.sparkSession, path.rstrip("/")
    draft = f"{os.path.dirname(path)}/.draft-{uuid.uuid4().hex}"
    made, whole, old = (f"{draft}/{kind}" for kind in ("made", "whole", "old"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        by = f"{task.partitionId():05d}-{task.taskAttemptId()}"
        os.mkdir(f"{made}/{by}")
        pairs = ((n, v) for b in batches for n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for name, same in groupby(pairs, key=lambda p: p[0]):
            folder = f"{made}/{by}/{folder_name(name)}"
            with suppress(FileExistsError):  # null and an empty name have one folder
                os.mkdir(folder)
            _append(f"{folder}/part-{by}.txt", (v + b"\n" for _, v in same))
        yield pa.RecordBatch.from_pydict({"by": [by]})

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for by in (by for b in batches for by in b.column(0).to_pylist()):
            with suppress(FileNotFoundError):  # another attempt moved all of them
                for name in os.listdir(f"{made}/{by}"):
                    _move(f"{made}/{by}/{name}", f"{whole}/{name}")
                os.rmdir(f"{made}/{by}")
        yield pa.RecordBatch.from_pydict({"by": pa.array([], pa.string())})

    os.makedirs(made)
    os.mkdir(whole)
    try:
        ended = rows.selectExpr("name", "CAST(value AS binary) AS value").mapInArrow(make, "by string").collect()
        # a local store renames one after the other, whoever asks
        tasks = max(1, spark.sparkContext.defaultParallelism // 8)
        spark.createDataFrame(ended, "by string").coalesce(tasks).mapInArrow(move, "by string").collect()
        open(f"{whole}/_SUCCESS", "x").close()
        if os.path.lexists(path):
            os.rename(path, old)
        os.rename(whole, path)
    finally:
        shutil.rmtree(draft, ignore_errors=True)


def _append(path: str, parts: Iterator[bytes]) -> None:
    out = os.open(path, os.O_WRONLY | os.O_CREAT | os.O_APPEND | os.O_CLOEXEC, 0o666)
    try:
        for part in parts:
            view = memoryview(part)
            while view:
                view = view[os.write(out, view) :]
    finally:
        os.close(out)


def _move(folder: str, to: str) -> None:
    """Moves a folder, or its files if there is one of that name; another attempt may have done it."""
    try:
        os.rename(folder, to)
    except FileNotFoundError:
        if not os.path.isdir(to):
            raise OSError(f"{folder} is gone, and {to} isn't there") from None
    except OSError as error:
        if error.errno not in (errno.ENOTEMPTY, errno.EEXIST):
            raise
        for name in os.listdir(folder):
            os.rename(f"{folder}/{name}", f"{to}/{name}")
        os.rmdir(folder)


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass a file over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _shown(folder: str) -> list[str]:
    """The files of a folder that are read, in order."""
    with os.scandir(folder) as entries:
        return sorted(e.name for e in entries if not _hidden(e.name) and e.is_file())


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """What is in a folder (entry, whether it is a folder), listed by one task and dealt as wide as a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            names, kinds = [], []
            with os.scandir(path) as entries:
                for e in entries:
                    inner = e.is_dir()
                    if inner or not _hidden(e.name):  # as with Spark's readers, `*` names folders whatever they are called
                        names.append(e.name)
                        kinds.append(inner)
                    if len(names) == _ENTRIES:
                        yield pa.RecordBatch.from_pydict({"entry": names, "inner": kinds})
                        names, kinds = [], []
            yield pa.RecordBatch.from_pydict({"entry": pa.array(names, pa.string()), "inner": pa.array(kinds, pa.bool_())})

    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.range(0, 1, 1, 1).mapInArrow(run, "entry string, inner boolean").repartition(wide, "entry")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder and of the folders in it: content, as UTF-8, and whether it is no text in the encoding that JSON
    begins with. Files are read whole, and unpacked if they end in .gz or .bz2."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for b in batches:
            for entry, inner in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = f"{path}/{entry}"
                for file in [f"{at}/{name}" for name in _shown(at)] if inner else [at]:
                    how = gzip.open if file.endswith(".gz") else bz2.open if file.endswith(".bz2") else open
                    with how(file, "rb") as data:
                        yield data.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, broken, size = [], [], 0
        made = lambda: pa.RecordBatch.from_pydict({"content": pa.array(held, pa.binary()), "broken": pa.array(broken, pa.bool_())})
        for data in contents(batches):
            text = _utf8(data)
            held.append(data if text is None else text)
            broken.append(text is None)
            size += len(held[-1])
            if size > _BYTES or len(held) == _FILES:
                yield made()
                held, broken, size = [], [], 0
        yield made()

    return _entries(spark, path).mapInArrow(run, "content binary, broken boolean")


def _utf8(data: bytes) -> bytes | None:
    """JSON as UTF-8 without a byte order mark; none if it is no text."""
    kind = json.detect_encoding(data)
    try:
        text = data.decode(kind)
    except UnicodeDecodeError:
        return None
    return data if kind == "utf-8" else text.encode()
