"""Structured Streaming into a keyed table: each micro-batch is deduplicated and merged."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colloquy.operators.dedup import latest_wins
from colloquy.sources import files


class KeyedTable:
    """The latest row of each key, as Parquet in one folder, in BUCKETS parts by key (a number that must stay for a folder).

    A batch reads and writes the buckets that its keys fall into, beside those of the batches before, and then
    commits by a manifest, which says where each bucket is. What isn't in a manifest isn't in the table, so a
    batch that fails leaves it as it was. The state is the folder's alone: a new object on it goes on from the
    last manifest, and a batch that was committed isn't run again. The last KEEP manifests and their files stay.
    """

    BUCKETS = 16
    KEEP = 2

    def __init__(self, spark: SparkSession, folder: str, key: str, order: list[str]):
        self.spark, self.folder, self.key, self.order = spark, folder.rstrip("/"), key, order

    def batches(self) -> list[int]:
        """Committed batches, in order."""
        return sorted(int(n.removeprefix("manifest-")) for n in files.names(self.spark, f"{self.folder}/manifests") if n.startswith("manifest-"))

    def _manifest(self, batch_id: int) -> dict[str, str]:
        return json.loads(files.get(self.spark, f"{self.folder}/manifests/manifest-{batch_id}"))

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.BUCKETS)).cast("int")

    def _rows(self, where: dict[str, str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{at}/__bucket={bucket}" for bucket, at in where.items()])

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        done = self.batches()
        if batch_id in done:
            return
        manifest = self._manifest(done[-1]) if done else {}
        before = {b: at for b, at in manifest.items() if b != "schema"}
        # columns are never lost: a batch that lacks some has them as null, one that brings some adds them
        known = StructType.fromJson(manifest["schema"]) if done else batch.schema
        schema = StructType([*known.fields, *(f for f in batch.schema.fields if f.name not in known.names)])
        batch = batch.select(*[F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        touched = {str(r[0]) for r in batch.select(self._bucket()).distinct().collect()}
        old = {b: at for b, at in before.items() if b in touched}
        rows = batch.unionByName(self._rows(old, schema)) if old else batch
        at = f"rows-{batch_id}-{uuid.uuid4().hex}"
        merged = latest_wins(rows, [self.key], self.order).withColumn("__bucket", self._bucket())
        merged.repartition("__bucket").write.partitionBy("__bucket").parquet(f"{self.folder}/{at}")
        now = before | {b: at for b in touched}
        draft = f"{self.folder}/drafts/{uuid.uuid4().hex}"
        files.put(self.spark, draft, json.dumps({"schema": schema.jsonValue()} | now))
        fs, place = files.store(self.spark, f"{self.folder}/manifests")
        fs.mkdirs(place)
        files.rename(self.spark, draft, f"{self.folder}/manifests/manifest-{batch_id}")
        self._clean()

    def _clean(self) -> None:
        done = self.batches()
        kept = {at for k in done[-self.KEEP :] for at in self._manifest(k).values() if isinstance(at, str)}
        for k in done[: -self.KEEP]:
            files.delete(self.spark, f"{self.folder}/manifests/manifest-{k}")
        for name in files.names(self.spark, self.folder):
            if name.startswith("rows-") and name not in kept and int(name.split("-")[1]) <= done[-1]:
                files.delete(self.spark, f"{self.folder}/{name}")

    def read(self) -> DataFrame:
        manifest = self._manifest(self.batches()[-1])
        return self._rows({b: at for b, at in manifest.items() if b != "schema"}, StructType.fromJson(manifest["schema"]))


def replay(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The table after a stream over the file at `path` has run to its end: the latest row of each key."""
    schema = spark.read.parquet(path).schema
    folder = files.shared_folder(spark, "stream")
    state = KeyedTable(spark, folder, key, order)
    parent, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8)
    # a table may be one file or a folder of them
    store, place = files.store(spark, path)
    rows = stream.parquet(path) if store.getFileStatus(place).isDirectory() else stream.option("pathGlobFilter", name).parquet(parent)
    query = rows.writeStream.foreachBatch(state.upsert).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return state.read()


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Counts by hour and type; rows later than the watermark are left out. Works on streams and tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type").count()


def first_in_day(events: DataFrame, keys: list[str]) -> DataFrame:
    """Claims: the first row of each key within a day of event time, with state that expires."""
    return events.withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(keys)
