"""Claims in a stream's state over restarts, and the path from events to stored rows with failures in between."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from colloquy.config import Config
from colloquy.operators import tables
from colloquy.sources import files
from colloquy.streaming import claims, intake

EVENTS = "event_id bigint, ts timestamp, user_id bigint, kind string"


def at(day, hour):
    return dt.datetime(2024, 1, day, hour)


def test_claims_are_kept_released_and_dropped_over_restarts(spark, tmp_path):
    runs = [
        [(1, at(1, 1), 7, "request"), (2, at(1, 2), 7, "request"), (3, at(1, 1), 8, "request"), (4, at(1, 3), 8, "failed"), (5, at(1, 1), None, "request")],
        [(6, at(1, 4), 7, "request"), (7, at(1, 4), 8, "request"), (8, at(1, 5), 8, "completed"), (9, at(1, 6), 8, "failed"), (10, at(1, 7), None, "request")],
        [(11, at(1, 8), 8, "request"), (12, at(1, 5), 7, "failed"), (13, at(1, 9), 7, "request"), (14, at(2, 1), 8, "request")],
        [(15, at(9, 1), 1, "request")],  # the days before end
        [(16, at(9, 2), 1, "completed"), (17, at(1, 10), 7, "request")],  # the last is too late
    ]
    got = {}
    for k, rows in enumerate(runs):
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in")
        claims.run(stream, F.col("user_id"), F.col("kind"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")  # each a new query
        got[k] = {r.event_id: r.answer for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[0] == {1: "granted", 2: "duplicate", 3: "granted", 4: "taken", 5: "granted"}
    assert got[4] == got[0] | {6: "duplicate", 7: "granted", 8: "taken", 9: "ignored", 10: "duplicate", 11: "duplicate", 12: "taken", 13: "granted", 14: "granted", 15: "granted", 16: "taken"}


def test_claims_of_many_keys_share_a_group(spark, tmp_path):
    big = 2**60  # told apart by its last digit, beside a null key
    rows = [(k, at(1, 1), k if k < 300 else [big, big + 1, None][k - 300], "request") for k in range(303)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in")
    claims.run(stream, F.col("user_id"), F.col("kind"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.event_id, r.key, r.answer) for r in got.collect()) == [(r[0], r[2], "granted") for r in rows]
    # states are kept for buckets, so calls of Python don't grow with the keys
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{tmp_path}/checkpoint")
    assert held.count() <= claims.BUCKETS


# --- intake

ARRIVALS = "k string, ts timestamp, needs int, kind string"


def work(df):
    o = F.when(F.col("kind") == "bad", intake.PERMANENT).when(F.col("attempts") < F.col("needs"), intake.TRANSIENT).otherwise(intake.COMPLETED)
    return df.withColumns({"outcome": o, "error": F.when(o != intake.COMPLETED, F.concat(F.lit("failed at "), "attempts")), "score": F.col("needs") * 10})


def batch(spark, *rows):
    return spark.createDataFrame([(k, at(1, hour), needs, kind) for k, hour, needs, kind in rows], ARRIVALS).coalesce(1)


@pytest.fixture
def made(spark, tmp_path):
    return lambda: intake.Intake(spark, f"{tmp_path}/t", batch(spark, ("x", 1, 0, "")).schema, "k", ["ts", "needs"], work, ["score"], Config(retry_attempts=3), buckets=2)


def state(run):
    status = {r.k: (r.status, r.attempts) for r in run.folder.read("status").collect()}
    return status, {r.k: r.score for r in run.folder.read("results").collect()}, sorted(r.k for r in run.waiting().collect())


def test_transient_failures_end_in_time_and_permanent_ones_at_once(spark, made):
    run = made()
    run.process(batch(spark, ("a", 1, 0, ""), ("b", 1, 1, ""), ("c", 1, 2, ""), ("d", 1, 9, ""), ("e", 1, 0, "bad"), ("a", 2, 5, ""), (None, 1, 0, "")), 0)
    assert state(run) == ({"a": ("completed", 1), "b": ("pending", 1), "c": ("pending", 1), "d": ("pending", 1), "e": ("failed", 1)}, {"a": 0}, ["b", "c", "d"])
    due = {r.k: r.due for r in run.waiting().collect()}
    assert set(due.values()) == {at(1, 2) + dt.timedelta(seconds=1)}
    run.process(batch(spark, ("a", 1, 7, "")), 1, at(1, 1))  # nothing is due, and what is done isn't done again
    assert state(run)[2] == ["b", "c", "d"] and state(run)[1] == {"a": 0}
    run = made()  # as after a restart
    assert run.drain() == 2
    assert state(run) == ({"a": ("completed", 1), "b": ("completed", 2), "c": ("completed", 3), "d": ("failed", 3), "e": ("failed", 1)}, {"a": 0, "b": 10, "c": 20}, [])
    run.process(batch(spark, ("e", 5, 0, ""), ("d", 5, 0, ""), ("b", 5, 0, "")), 2)  # what failed runs again when it comes again
    assert state(run) == ({"a": ("completed", 1), "b": ("completed", 2), "c": ("completed", 3), "d": ("completed", 4), "e": ("completed", 2)}, {"a": 0, "b": 10, "c": 20, "d": 0, "e": 0}, [])


@pytest.mark.parametrize("stop_at", [2, 8])
def test_a_batch_that_is_stopped_between_its_writes_is_as_if_it_never_ran(spark, made, monkeypatch, stop_at):
    run = made()
    first, second = batch(spark, ("a", 1, 0, ""), ("b", 1, 1, "")), batch(spark, ("c", 2, 0, ""), ("d", 2, 1, ""), ("a", 2, 0, ""))
    run.process(first, 0)
    before, seen = state(run), []
    writer = type(first.write)
    real = writer.parquet

    def stopping(self, *a, **b):
        seen.append(1)
        if len(seen) == stop_at:
            raise OSError("stopped")
        return real(self, *a, **b)

    with monkeypatch.context() as patched:
        patched.setattr(writer, "parquet", stopping)
        with pytest.raises(OSError):
            run.process(second, 1)
    assert state(run) == before
    made().process(second, 1)
    after = state(run)
    assert after == ({"a": ("completed", 1), "b": ("completed", 2), "c": ("completed", 1), "d": ("pending", 1)}, {"a": 0, "b": 10, "c": 0}, ["d"])
    made().process(second, 1)
    assert state(run) == after


def test_a_stopped_commit_and_a_writer_in_between(spark, made, monkeypatch):
    run = made()
    run.process(batch(spark, ("a", 1, 0, "")), 0)
    real, left = files.create, [1]

    def between(*a):
        if left:
            left.pop()
            other = made()
            other.name = "other"
            other.process(batch(spark, ("a", 2, 0, ""), ("b", 2, 0, "")), 0)
        return real(*a)

    with monkeypatch.context() as patched:
        patched.setattr(files, "create", between)
        run.process(batch(spark, ("b", 3, 0, ""), ("c", 3, 0, "")), 1)  # runs again on what the other left
    status = state(run)[0]
    assert status == {"a": ("completed", 1), "b": ("completed", 1), "c": ("completed", 1)}

    def always(*_, **__):
        raise tables.Conflict("always")

    monkeypatch.setattr(tables.Transaction, "commit", always)
    with pytest.raises(tables.Conflict):
        run.process(batch(spark, ("z", 4, 0, "")), 2)


def test_a_stream_goes_on_where_it_ended(spark, made, tmp_path):
    for rows in ([("a", 1, 1, ""), ("b", 1, 0, "")], [("a", 2, 1, ""), ("c", 2, 0, "bad")]):
        batch(spark, *rows).write.mode("append").parquet(f"{tmp_path}/in")
        made().stream(spark.readStream.schema(ARRIVALS).parquet(f"{tmp_path}/in"), f"{tmp_path}/checkpoint")
    assert state(made()) == ({"a": ("completed", 2), "b": ("completed", 1), "c": ("failed", 1)}, {"a": 10, "b": 0}, [])
