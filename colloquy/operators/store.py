"""Tables by name: creation, evolution, views, logs, claims and cached results."""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from colloquy import schemas
from colloquy.config import Config
from colloquy.operators.merge import missing_columns
from colloquy.sources import each, files


#: The property of a table that names its required columns.
_REQUIRED = "colloquy.required"


def _name(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(name)}")


def create_table(spark: SparkSession, name: str, schema: StructType, required: tuple[str, ...] = (), defaults: dict[str, str] | None = None) -> None:
    """Creates a table if there is none. Required columns are kept with it, for `insert` to refuse nulls by (Spark itself
    doesn't); defaults (SQL) are what an insert that names other columns alone puts in."""
    defaults = defaults or {}
    required = tuple(f.name for f in schema.fields if f.name in required or not f.nullable)
    more = lambda f: (" NOT NULL" if f.name in required else "") + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{more(f)}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING parquet TBLPROPERTIES ('{_REQUIRED}' = '{json.dumps(required)}')")


def insert(rows: DataFrame, name: str) -> None:
    """Adds rows by column names to a table of `create_table`: columns that rows lack get their defaults, and a null in a
    required one fails the whole insert."""
    spark = rows.sparkSession
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_name(name)}").collect()}
    required = json.loads(kept.get(_REQUIRED, "[]"))
    if lacking := [c for c in required if c not in rows.columns and spark.table(name).schema[c].metadata.get("CURRENT_DEFAULT") is None]:
        raise ValueError(f"{name}: required columns are missing: {lacking}")
    refuse = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{name}.{c} is required, but null"))).otherwise(F.col(c)).alias(c)
    checked = rows.select(*[refuse(c) if c in required else F.col(c) for c in rows.columns])
    spark.sql(f"INSERT INTO {_name(name)} ({', '.join(f'`{c}`' for c in rows.columns)}) SELECT * FROM {{rows}}", rows=checked)


def evolve_table(spark: SparkSession, name: str, schema: StructType, apply: bool = True) -> list[str]:
    """Adds the columns that the table lacks; returns them, also on a dry run."""
    lacking = missing_columns(spark.table(name), schema)
    if lacking and apply:
        spark.sql(f"ALTER TABLE {_name(name)} ADD COLUMNS ({', '.join(f'`{c}` {schema[c].dataType.simpleString()}' for c in lacking)})")
    return lacking


def staged(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON lines for a merge: by a schema, failing on rows that don't fit it, or with one inferred."""
    return spark.read.json(path) if schema is None else spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts kept as one JSON document a file; what can't be read is in `_corrupt`.

    `folder/*` are the files of a folder and of the folders in it. On a local or mounted store one task lists that folder
    and as many as a shuffle has read the files, so that the driver holds none of their names."""
    schema = StructType([*schemas.TRANSCRIPT.fields]).add("_corrupt", "string")
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    folder = path.removesuffix("/*")
    if folder == path or not folder or re.search(r"[*?{}\[\]\\]", folder) or not files.exists(spark, folder) or (place := files.local(spark, folder)) is None:
        return spark.read.schema(schema).options(multiLine=True, **options).json(path)
    read = each.read(spark, place).select(F.col("content").cast("string").alias("text"), "broken")
    # as the JSON source has it: a file may hold an array of documents, and one without any gives no row
    text = F.when(F.col("broken"), "{").otherwise(F.col("text"))
    one = F.array(F.from_json(text, schema, options))
    found = F.when(F.ltrim(text).startswith("["), F.coalesce(F.from_json(text, ArrayType(schema)), one)).otherwise(one)
    rows = read.select("text", "broken", F.explode(found).alias("d")).filter("d IS NOT NULL")
    return rows.select("d.*", "text", "broken").withColumn("_corrupt", F.when(F.col("broken"), F.col("text")).otherwise(F.col("_corrupt"))).drop("text", "broken")


def mappings(spark: SparkSession, name: str) -> DataFrame:
    """The alias table, or an empty one where there is none."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schemas.MAPPINGS)


def log_calls(rows: DataFrame, path: str, config: Config = Config()) -> bool:
    """Appends to the cost log; a failure is logged and never stops the caller."""
    if config.cost_log_disabled:
        return False
    try:
        rows.select(*schemas.COST_LOG.names).write.mode("append").parquet(path)
    except Exception:
        logging.getLogger(__name__).warning("cost log not written", exc_info=True)
        return False
    return True


def request_key(stem: Column, generation: Column, event: Column) -> Column:
    """An idempotency key: one object version is one request."""
    return F.concat(F.lit("auto-"), stem, F.lit("-"), F.coalesce(generation, event))


def acquire(requests: DataFrame, claims: DataFrame, order: list[str], key: str = "key", day: str = "day") -> tuple[DataFrame, DataFrame]:
    """Requests that get their day's claim (the first of each key by `order`, if none holds it), and the claims afterwards."""
    first = requests.groupBy(key, day).agg(F.min_by(F.struct(*requests.columns), F.struct(*order, *requests.columns)).alias("r")).select("r.*")
    granted = first.join(claims.select(key, day), [key, day], "left_anti")
    return granted, claims.unionByName(granted.select(key, day))


def release(claims: DataFrame, failed: DataFrame, key: str = "key", day: str = "day") -> DataFrame:
    """Claims without those whose work failed, so that it may be tried again."""
    return claims.join(failed.select(key, day), [key, day], "left_anti")


class Claims:
    """Claims of a day as files that only one writer can create; a failure of the store itself doesn't keep work back."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, key: str, day: str) -> str:
        return f"{self.folder}/{day}/{hashlib.sha256(key.encode()).hexdigest()}"

    def take(self, key: str, day: str) -> bool:
        """Whether this caller gets the claim."""
        try:
            files.put(self.spark, self._path(key, day), key, overwrite=False)
        except Exception as error:
            if files.exists(self.spark, self._path(key, day)):
                return False
            logging.getLogger(__name__).warning("no claim could be made, going on without: %s", error)
        return True

    def release(self, key: str, day: str) -> None:
        try:
            files.delete(self.spark, self._path(key, day))
        except Exception:
            logging.getLogger(__name__).warning("a claim was not released", exc_info=True)

    @contextmanager
    def held(self, key: str, day: str) -> Iterator[bool]:
        """Gives whether the claim was taken; it is released if the work ends in any error, or is cancelled."""
        taken = self.take(key, day)
        try:
            yield taken
        except BaseException:
            if taken:
                self.release(key, day)
            raise


class ResultCache:
    """Results by key and day, in a folder with one folder a day; of several for one key the last written counts.

    Writing appends, so writers don't get in each other's way; `compact` leaves one row a key in a day, and `forget`
    removes days whole. Lookups read the days that are asked for."""

    SCHEMA = "key string, result string, cached_at timestamp, written bigint, day date"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, results: DataFrame, day: str = "day", cached_at: Column | None = None) -> None:
        """Adds results (key, result, day); a null result is none. Of rows with one key and day the latest by cached_at counts."""
        at = F.current_timestamp() if cached_at is None else cached_at
        rows = results.filter("result IS NOT NULL").select("key", "result", at.cast("timestamp").alias("cached_at"), F.lit(time.time_ns()).alias("written"), F.col(day).cast("date").alias("day"))
        rows.write.mode("append").partitionBy("day").parquet(self.path)

    def read(self) -> DataFrame:
        """One row for each key and day: key, day, result, cached_at."""
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], "key string, day date, result string, cached_at timestamp")
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        last = rows.groupBy("key", "day").agg(F.max_by(F.struct("result", "cached_at"), F.struct("written", "cached_at", "result")).alias("r"))
        return last.select("key", "day", "r.*")

    def find(self, requests: DataFrame, key: str = "key", day: str = "day") -> DataFrame:
        """requests with `result`, null on a miss: one row for each."""
        known = self.read().select(F.col("key").alias("__key"), F.col("day").alias("__day"), "result")
        same = (requests[key] == F.col("__key")) & (requests[day].cast("date") == F.col("__day"))
        return requests.join(known, same, "left").drop("__key", "__day")

    def days(self) -> list[str]:
        return [n.removeprefix("day=") for n in files.names(self.spark, self.path) if n.startswith("day=")]

    def compact(self, day: str) -> None:
        """Leaves one row a key in a day. Readers meanwhile see rows twice, which changes nothing, as the last counts."""
        at = f"{self.path}/day={day}"
        old = [n for n in files.names(self.spark, at) if n.startswith("part-")]
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path).filter(F.col("day") == F.lit(day).cast("date"))
        last = rows.groupBy("key").agg(F.max_by(F.struct("result", "cached_at", "written"), F.struct("written", "cached_at", "result")).alias("r"))
        last.select("key", "r.*").write.mode("append").parquet(at)
        for name in old:
            files.delete(self.spark, f"{at}/{name}")

    def forget(self, before: str) -> list[str]:
        """Removes the days before one; gives them."""
        gone = [d for d in self.days() if d < before]
        for d in gone:
            files.delete(self.spark, f"{self.path}/day={d}")
        return gone


def write_each(df: DataFrame, name: Column, path: str) -> None:
    """A folder of JSON for each row, named after it: for exports that people open, not for tables of any size.

    On a local or mounted store tasks write the files by themselves: Spark's writer starts some processes a file there
    (to set permissions, where Hadoop's native library is missing), and its driver moves each folder."""
    rows = df.select(name.alias("name"), F.to_json(F.struct(*df.columns)).alias("value"))
    # a file costs much more than its bytes, by which few rows would go to one task
    dealt = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    place = files.local(df.sparkSession, path)
    if place is None:
        dealt.write.mode("overwrite").partitionBy("name").text(path)
    else:
        each.write(dealt.sortWithinPartitions("name"), place)


def recent_jobs(jobs: DataFrame, n: int = 10) -> DataFrame:
    """The last n jobs, their errors cut to 100 characters."""
    error = F.when(F.length("error") > 100, F.concat(F.substring("error", 1, 100), F.lit("..."))).otherwise(F.col("error"))
    return jobs.orderBy(F.desc("seq")).limit(n).withColumn("error", error)


def tally(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
