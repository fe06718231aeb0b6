"""Files to scored meetings: a stream of transcript files is parsed, scored by a completer and stored.

    landing.register(spark)
    files = spark.readStream.format("landing").load(folder)
    run = pipeline(spark, tables, prompts, make, journal=journal)
    run.stream(arrivals(files), checkpoint)

A file that can't be parsed is a permanent failure; it is never asked about. A question that failed for good, after the
completer's own retries, is a transient one: the meeting waits for its next attempt, and what was answered meanwhile is
in the journal. A meeting is claimed by its id: one that is scored isn't scored again, whatever file brings it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.operators import completion
from colloquy.sources import transcripts
from colloquy.streaming import intake

RESULT = [*completion.SECTIONS, "total_qualified_sections", "qualified"]


def arrivals(files: DataFrame, default_date=None) -> DataFrame:
    """Scanned files, of a table or a stream, as arrivals: TRANSCRIPT rows with `ts`, the file's time, and `reject`."""
    return transcripts.parse(files.withColumn("ts", F.col("modified")), default_date, keep=("ts",))


def scorer(prompts: dict[str, str], make: Callable[[], completion.Completer], config: Config = Config(), **asking) -> intake.Work:
    """Work on arrivals: sections and totals, by questions about the transcript, or the notes where there is none."""

    def work(rows: DataFrame) -> DataFrame:
        spoken = F.array_join(F.transform("notes", lambda n: F.concat_ws(": ", n["speaker"], n["text"])), "\n")
        good = rows.filter("reject IS NULL").withColumn("__context", F.coalesce(F.nullif("full_transcript", F.lit("")), spoken))
        scored = completion.opportunity(completion.ask(good, prompts, "__context", make, config, **asking), config)
        failed = F.exists(F.map_values("raw"), lambda a: a.isNull())
        done = scored.withColumns({"outcome": F.when(failed, intake.TRANSIENT).otherwise(intake.COMPLETED), "error": F.when(failed, "a question was not answered")}).drop("raw", "__context")
        bad = rows.filter("reject IS NOT NULL").withColumns({"outcome": F.lit(intake.PERMANENT), "error": F.col("reject")})
        return done.unionByName(bad, allowMissingColumns=True)

    return work


def pipeline(spark: SparkSession, path: str, prompts: dict[str, str], make: Callable[[], completion.Completer], config: Config = Config(), **asking) -> intake.Intake:
    """The tables at path, into which meetings are worked: `results`, `status` and `retries`, by meeting_id."""
    from pyspark.sql.types import StringType, StructType, TimestampType

    schema = StructType([*schemas.TRANSCRIPT.fields]).add("ts", TimestampType()).add("reject", StringType())
    return intake.Intake(spark, path, schema, "meeting_id", ["ts", "title"], scorer(prompts, make, config, **asking), RESULT, config)
