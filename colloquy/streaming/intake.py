"""Events to stored rows: arrivals are claimed, worked on, merged, and retried if that fails for a while.

A micro-batch joins what arrived with the retries that are due. One row of each key is worked on; keys whose work is done
are duplicates. Results, each key's status and the retries that are left are three tables of one folder
(`operators.tables`), and are committed together with the batch's number, so a batch that is stopped between any two
writes leaves all three as they were and is run again, and one that was committed isn't.

A transient failure waits in `retries` with the number of attempts and the time from which it is due (doubling and
bounded, without jitter, so that a batch run again gives the same); after the last attempt it has failed. A permanent failure has
failed at once. A key that failed runs again when it arrives again, with its attempts counted on; one that completed doesn't.

* Rows with a null key are refused: they have no status.
* Of several arrivals of one key in a batch the first by `order` is worked on, the others are duplicates.
* `work` is given arrivals with `attempts`, how often each was tried before, and must give one row for each: its columns,
  `outcome` (completed, transient or permanent), `error` and the result's own columns.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colloquy.config import Config
from colloquy.operators.tables import BUCKETS, Conflict, Folder

STATUS = "status string, attempts int, error string, at timestamp"
WAITING = "attempts int, due timestamp"
COMPLETED, TRANSIENT, PERMANENT = "completed", "transient", "permanent"
#: A batch that another writer's commit got in the way of is run again so often.
TRIES = 5

Work = Callable[[DataFrame], DataFrame]


def delay(attempts, config: Config = Config()):
    """Seconds to wait after so many attempts, as a column: doubling, bounded."""
    return F.least(F.lit(config.retry_max_s), F.lit(config.retry_base_s) * F.pow(F.lit(2.0), attempts - 1))


class Intake:
    """The tables of a folder that a stream of arrivals with some schema is worked into."""

    def __init__(self, spark: SparkSession, path: str, arrivals: StructType, key: str, order: list[str], work: Work, result: list[str], config: Config = Config(), name: str = "intake", buckets: int = BUCKETS):
        self.spark, self.folder, self.key, self.order, self.work, self.result, self.config, self.name = spark, Folder(spark, path), key, order, work, result, config, name
        self.arrivals, self.buckets = arrivals, buckets

    def _with_key(self, ddl: str) -> StructType:
        return StructType([self.arrivals[self.key], *StructType.fromDDL(ddl).fields])

    def process(self, batch: DataFrame, number: int, now: datetime | None = None, name: str | None = None) -> None:
        """One micro-batch. `now` is what retries are due by; the latest `ts` of the batch if it isn't given."""
        for k in range(TRIES):
            try:
                return self._once(batch, (name or self.name, number), now)
            except Conflict:
                if k == TRIES - 1:
                    raise

    def _once(self, batch: DataFrame, number: tuple[str, int], now: datetime | None) -> None:
        t, key = self.folder.begin(), self.key
        if t.has(*number):
            return
        t.create("status", key, self._with_key(STATUS), self.buckets)
        t.create("retries", key, StructType([*self.arrivals.fields, *StructType.fromDDL(WAITING).fields]), self.buckets)
        if now is None:
            now = batch.agg(F.max("ts")).first()[0]
        at, names = F.lit(now).cast("timestamp"), self.arrivals.names
        first = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*names), F.struct(*self.order)).alias("r")).select("r.*")
        due = t.read("retries").filter(F.col("due") <= at).select(*names)
        # (an arrival of a key that waits takes its place)
        pool = first.unionByName(due.join(first.select(key), key, "left_anti"))
        known = t.read("status").select(F.col(key).alias("__key"), F.col("status").alias("__status"), F.col("attempts").alias("__attempts"))
        asked = pool.join(known, pool[key] == known["__key"], "left").filter(F.coalesce(F.col("__status") != COMPLETED, F.lit(True)))
        given = asked.select(*names, F.coalesce("__attempts", F.lit(0)).alias("attempts"))
        done = t._stage(self.work(given))  # what was paid for is worked out once
        attempts = (F.col("attempts") + 1).cast("int")
        again = (F.col("outcome") == TRANSIENT) & (attempts < self.config.retry_attempts)
        state = F.when(F.col("outcome") == COMPLETED, COMPLETED).when(again, "pending").otherwise("failed")
        ended = done.select(*names, *self.result, F.col("error").cast("string").alias("error"), attempts.alias("attempts"), state.alias("status"))

        results = ended.filter(F.col("status") == COMPLETED).select(key, *[c for c in self.result if c != key])
        t.create("results", key, results.schema, self.buckets)
        t.upsert("results", results)
        t.upsert("status", ended.select(key, "status", "attempts", "error", at.alias("at")))
        due_at = F.timestamp_micros(F.unix_micros(at) + (delay(F.col("attempts"), self.config) * 1_000_000).cast("bigint"))
        waits = ended.filter(F.col("status") == "pending").select(*names, "attempts", due_at.alias("due"))
        t.delete("retries", ended.filter(F.col("status") != "pending").select(key))
        t.upsert("retries", waits)
        for table in ("results", "status", "retries"):
            t.compact(table)
        t.commit(number)

    def waiting(self) -> DataFrame:
        return self.folder.read("retries")

    def drain(self) -> int:
        """Works on what waits until nothing does, each round at the time the last is due; gives the number of rounds."""
        rounds, name = 0, f"{self.name}-drain"
        while self.folder.versions() and (last := self.waiting().agg(F.max("due")).first()[0]) is not None:
            number = self.folder.state()[1]["batches"].get(name, -1) + 1
            self.process(self.spark.createDataFrame([], self.arrivals), number, last, name)
            rounds += 1
        return rounds

    def stream(self, arrivals: DataFrame, checkpoint: str) -> None:
        """Works on all that a stream of arrivals holds now; a later call goes on after it."""
        query = arrivals.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
