"""Files of any store that Spark reaches, by its own file systems: small ones, written and listed by the driver."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def store(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def local(spark: SparkSession, path: str) -> str | None:
    """The path as workers open it by themselves, if its store is the local one or a mounted one (file:); else none."""
    fs, place = store(spark, path)
    full = fs.makeQualified(place).toString()
    return f"/{full.removeprefix('file:').lstrip('/')}" if full.startswith("file:") else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = store(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = store(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, place = store(spark, old)
    if not fs.rename(place, store(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder; nothing if there is none."""
    fs, place = store(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def put(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Writes a file whole; without `overwrite` only if there is none, which one of several writers does."""
    fs, place = store(spark, path)
    out = fs.create(place, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file if there is none; of several writers one does. Whether this one did."""
    try:
        put(spark, path, text, overwrite=False)
    except Exception:
        if exists(spark, path):
            return False
        raise
    return True


def get(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path, wholetext=True).first()
    return first[0] if first else ""


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder in spark.checkpoint.dir; in local mode, where that is unset, in a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="colloquy-")
    return f"{root.rstrip('/')}/colloquy-{what}/{uuid.uuid4().hex}"
