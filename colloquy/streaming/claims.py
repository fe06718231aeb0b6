"""Claims of a day as keyed state of a stream.

Requests and what became of the work they were granted come as one stream of rows (key, ts, event_id, kind). For each
key and day of event time the state holds whether the work is under way or done. A request is granted if
neither holds; `completed` ends the work for the day, `failed` gives the claim back, so that the next request runs
again; at the day's end a timer on the watermark drops the state. What a key did before a restart is in the
query's checkpoint.

Keys are dealt by their hash into BUCKETS for each day, and a bucket is one group with one value state and one timer: a call
of Python costs some ten milliseconds with its messages to the state store, which a call for each key would pay.
A bucket's state is read and written whole, so a micro-batch costs what the days it touches hold.

Rows of one key are taken in order of ts and event_id within a micro-batch; over micro-batches they are taken as
they come. A bucket's rows of one micro-batch are held by one task, so bound micro-batches (`maxFilesPerTrigger`).
Rows older than the watermark are left out, null keys are a key of their own. Keys are of an atomic type whose text
tells its values apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from colloquy.sources import files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REQUEST, COMPLETED, FAILED = "request", "completed", "failed"
#: Rows of the answer: what became of each row. A request is granted or a duplicate; an outcome is taken or ignored.
ANSWER = "event_id bigint, ts timestamp, kind string, answer string"


#: Groups a day's keys are dealt into. A checkpoint holds only with the number it began with.
BUCKETS = 64


class DayClaims(StatefulProcessor):
    """The states of a bucket's keys on one day: those whose work is under way, and those whose work is done."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "pending array<string>, completed array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows).sort_values(["ts", "event_id"], kind="stable")
        found = self.held.get()
        pending, completed = map(set, found or ((), ()))
        answers = []
        for who, kind in zip(batch["key"].tolist(), batch["kind"].tolist()):
            if kind == REQUEST:
                answers.append("duplicate" if who in pending or who in completed else "granted")
                if who not in completed:
                    pending.add(who)
            elif who in pending and kind in (COMPLETED, FAILED):
                answers.append("taken")
                pending.remove(who)
                if kind == COMPLETED:
                    completed.add(who)
            else:
                answers.append("ignored")
        self.held.update(([*pending], [*completed]))
        if not found:
            self.handle.registerTimer(int(batch["until"].iloc[0]))
        out = batch[["key", "event_id", "ts", "kind"]].assign(answer=answers)
        out.insert(1, "day", key[0])
        yield out

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def answers(events: DataFrame, key: Column, kind: Column, late: str = "1 day") -> DataFrame:
    """What became of each row of a stream of events (event_id, ts): key, day, event_id, ts, kind, answer."""
    day = F.col("ts").cast("date")
    until = (F.unix_timestamp(F.date_add(day, 1).cast("timestamp")) * 1000).alias("until")
    rows = events.select(key.alias("key"), day.alias("day"), F.col("event_id").cast("bigint").alias("event_id"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"), until)
    # pandas has no whole numbers with nulls, so keys go as text
    texts = rows.withColumns({"bucket": F.pmod(F.xxhash64("key"), F.lit(BUCKETS)), "key": F.col("key").cast("string")})
    grouped = texts.withWatermark("ts", late).groupBy("day", "bucket")
    told = grouped.transformWithStateInPandas(DayClaims(), f"key string, day date, {ANSWER}", "Append", "EventTime")
    return told.withColumn("key", F.col("key").cast(rows.schema["key"].dataType))


@contextmanager
def keeping_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state in the store that such processors need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def run(stream: DataFrame, key: Column, kind: Column, out: str, checkpoint: str, late: str = "1 day") -> None:
    """Writes the answers of all that the stream holds now to Parquet at `out`; a later run goes on where this one ended."""
    with keeping_state(stream.sparkSession):
        query = answers(stream, key, kind, late).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()


def replay(spark: SparkSession, events: DataFrame, key: Column, kind: Column, *, parts: int = 3, late: str = "1 day") -> DataFrame:
    """Answers to a table of events that arrives in `parts` spans of days, each a run of its own on the state before."""
    folder = files.shared_folder(spark, "claims")
    ends = events.agg(F.min("ts").cast("date").alias("first"), F.max("ts").cast("date").alias("last")).first()
    days = ((ends["last"] - ends["first"]).days + 1) if ends["first"] else 1
    part = F.floor(F.datediff(F.col("ts").cast("date"), F.lit(ends["first"])) * parts / days)
    for k in range(parts):
        events.filter(part == k).write.mode("append").parquet(f"{folder}/in")
        run(spark.readStream.schema(events.schema).parquet(f"{folder}/in"), key, kind, f"{folder}/out", f"{folder}/checkpoint", late)
    return spark.read.parquet(f"{folder}/out")
