"""A batch of transcripts: each is processed on its own, and a failure is that one's result."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from colloquy.operators.store import tally
from colloquy.sources import files

RESULT = "status string, error string"


def status(error: BaseException | None) -> str:
    """success, timeout, failed (the service refused: the error has a status), or error."""
    if error is None:
        return "success"
    if isinstance(error, TimeoutError):
        return "timeout"
    return "failed" if getattr(error, "status", None) or getattr(error, "status_code", None) else "error"


def run(rows: DataFrame, key: str, make: Callable[[], Callable[[dict], None]], width: int = 3) -> DataFrame:
    """What became of each row: key, status and error. `make` gives the work once a task; `width` tasks run it."""
    kind = rows.schema[key].dataType.simpleString()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = make()
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                error = None
                try:
                    work(row)
                except Exception as caught:
                    error = caught
                out.append((row[key], status(error), None if error is None else str(error)))
            yield pd.DataFrame(out, columns=[key, "status", "error"])

    return rows.repartition(max(1, width)).mapInPandas(each, f"`{key}` {kind}, {RESULT}")


def report(results: DataFrame, path: str, key: str) -> dict[str, int]:
    """Writes the results as JSON lines, in order of key, by the tasks that have them, and gives how many there are of each status."""
    spark, kind = results.sparkSession, results.schema
    results.write.mode("overwrite").parquet(f"{path}-run")  # each row is worked on once
    done = spark.read.schema(kind).parquet(f"{path}-run")
    done.orderBy(key).write.mode("overwrite").json(path)
    counts = {r.status: r.n for r in tally(done).collect()}
    files.delete(spark, f"{path}-run")
    return counts
