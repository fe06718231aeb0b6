"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Settings of Spark: shuffle files go when the query that made them ends; Arrow batches end at so many bytes.
CLEANUP, BATCH_BYTES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch"
#: A worker holds a batch and what it makes of it; a longer text is a batch of its own.
MOST_BYTES = 4 << 20

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; where it is unset, a folder of our own, but only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="colloquy-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/colloquy/{what}-{uuid.uuid4().hex}"


def store_uri(spark: SparkSession, path: str) -> str:
    """path with its store's scheme, as readers outside Spark want it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit of an Arrow batch to MOST_BYTES, so that long texts don't add up in a worker."""
    if int(spark.conf.get(BATCH_BYTES).rstrip("bB")) > MOST_BYTES:
        spark.conf.set(BATCH_BYTES, MOST_BYTES)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries run in here remove their shuffle files as they end."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, what: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read back: a lost executor costs no recomputation."""
    spark, path = df.sparkSession, new_path(df.sparkSession, what)
    with tidy(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def drop(*tables: DataFrame) -> None:
    """Removes tables that `cut` wrote and that nothing will read any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(_paths.pop(table))
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
