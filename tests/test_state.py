"""State that outlives its writer: keyed tables, swapped tables, claims, aliases and batches."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import batch, completion, dedup, merge, sinks, store, talent
from colloquy.sources import files
from colloquy.streaming.upserts import KeyedTable

ROWS = "k string, v int, at int"


def rows(table):
    return {r.k: (r.v, r["at"]) for r in table.read().collect()}


@pytest.fixture
def frame(spark):
    return lambda *r: spark.createDataFrame(list(r), ROWS)


def test_keyed_table_goes_on_in_a_new_object(spark, tmp_path, frame):
    folder = str(tmp_path / "t")
    KeyedTable(spark, folder, "k", ["at"]).upsert(frame(("a", 1, 1), ("b", 1, 1), ("a", 2, 2)), 0)
    again = KeyedTable(spark, folder, "k", ["at"])
    assert rows(again) == {"a": (2, 2), "b": (1, 1)}
    again.upsert(frame(("b", 9, 9), ("c", 3, 3), ("a", 0, 0)), 1)
    assert rows(KeyedTable(spark, folder, "k", ["at"])) == {"a": (2, 2), "b": (9, 9), "c": (3, 3)}


def test_keyed_table_runs_a_batch_once(spark, tmp_path, frame):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"])
    table.upsert(frame(("a", 1, 1)), 0)
    table.upsert(frame(("a", 2, 2)), 1)
    table.upsert(frame(("a", 7, 7)), 1)  # run again, as after a failure behind the commit
    assert rows(table) == {"a": (2, 2)} and table.batches() == [0, 1]


def test_keyed_table_without_the_commit_is_as_before(spark, tmp_path, frame, monkeypatch):
    folder = str(tmp_path / "t")
    table = KeyedTable(spark, folder, "k", ["at"])
    table.upsert(frame(("a", 1, 1)), 0)

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(files, "rename", stop)
        with pytest.raises(OSError):
            table.upsert(frame(("a", 2, 2), ("b", 2, 2)), 1)
    assert rows(KeyedTable(spark, folder, "k", ["at"])) == {"a": (1, 1)}
    KeyedTable(spark, folder, "k", ["at"]).upsert(frame(("a", 2, 2), ("b", 2, 2)), 1)
    assert rows(table) == {"a": (2, 2), "b": (2, 2)}


def test_keyed_table_writes_only_touched_buckets(spark, tmp_path, frame, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"])
    table.upsert(frame(*[(f"k{n}", n, 1) for n in range(200)]), 0)
    table.upsert(frame(("k5", 0, 2)), 1)
    newest = [n for n in files.names(spark, table.folder) if n.startswith("rows-1-")]
    assert len(files.names(spark, f"{table.folder}/{newest[0]}")) <= 3  # a bucket and the marker
    for k in range(2, 6):
        table.upsert(frame((f"k{k}", 0, 3)), k)
    assert len(rows(table)) == 200 and len(table.batches()) == table.KEEP


def test_swap_of_a_table_survives_a_stop(spark, tmp_path, frame, monkeypatch):
    path = str(tmp_path / "t")
    frame(("a", 1, 1)).write.parquet(path)
    real, left = files.rename, [1]

    def stop_second(*a):
        if not left:
            raise OSError("stopped")
        left.pop()
        real(*a)

    with monkeypatch.context() as patched:
        patched.setattr(files, "rename", stop_second)
        with pytest.raises(OSError):
            sinks.replace_table(frame(("a", 2, 2)), path)
    assert not files.exists(spark, path)
    sinks.recover_table(spark, path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    assert sinks.replace_table(spark.read.parquet(path).withColumn("v", F.lit(3)), path).first().v == 3
    assert sorted(files.names(spark, str(tmp_path))) == ["t"]


def test_claims_are_taken_once_and_released_on_failure(spark, tmp_path):
    claims = store.Claims(spark, str(tmp_path / "claims"))
    with claims.held("m1", "2024-01-01") as first, claims.held("m1", "2024-01-01") as second:
        assert first and not second
    assert not claims.take("m1", "2024-01-01") and claims.take("m1", "2024-01-02")
    for error in (ValueError, KeyboardInterrupt):
        with pytest.raises(error), claims.held("m2", "2024-01-01") as taken:
            assert taken
            raise error
    assert claims.take("m2", "2024-01-01")


def test_claims_fail_open(spark, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise OSError("no store")

    monkeypatch.setattr(files, "put", broken)
    assert store.Claims(spark, str(tmp_path / "claims")).take("m", "2024-01-01")


@pytest.mark.parametrize("most", [100, 0])
def test_canonical_names_in_arrays_row_by_row(spark, monkeypatch, most):
    monkeypatch.setattr(talent.names, "BROADCAST_ROWS", most)  # in place, and by a join of the distinct arrays
    df = spark.createDataFrame([("x", ["a", " B "]), ("x", ["b", None]), ("y", None), (None, []), ("z", ["q"])], "k string, names array<string>")
    maps = spark.createDataFrame([("A", "Alpha"), ("b", "Beta")], "variant_name string, canonical_name string")
    got = talent.canonical_in_arrays(df, {"names": None}, maps)
    assert got.columns == df.columns
    assert sorted((r.names or ["null"] for r in got.collect()), key=repr) == sorted([["Alpha", "Beta"], ["Beta", None], ["null"], ["null"], ["q"]], key=repr)


def test_latest_wins_by_an_aggregate(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), (None, 2, 1), (None, 3, 0), ("b", None, 9)], "k string, at int, v int")
    assert sorted(map(repr, map(tuple, dedup.latest_wins(df, ["k"], ["at", "v"]).collect()))) == sorted(map(repr, [("a", 1, 5), (None, 3, 0), ("b", None, 9)]))
    plan = dedup.latest_wins(df, ["k"], ["at", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_merge_counts_before_it_joins(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception, match="several source rows"):
        merge.merge(t, spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int"), "k", set_=["v"]).collect()
    got = merge.merge(t, spark.createDataFrame([("b", 2), ("b", 3)], "k string, v int"), "k", set_=["v"])
    assert sorted((r.k, r["_op"]) for r in got.collect()) == [("a", "keep"), ("b", "insert"), ("b", "insert")]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_fences_and_lists_of_evidence(spark):
    answers = ['```json\n{"qualified": true, "reason": "r", "summary": null, "evidence": ["a b", null, "", "c"]}\n```', '{"qualified": true, "reason": "r", "summary": "s", "evidence": "x"}', "```{}```"]
    got = spark.createDataFrame([(a,) for a in answers], "a string").select(completion.section(F.col("a")).alias("s")).collect()
    assert [(r.s.qualified, r.s.evidence) for r in got] == [(True, "a b c"), (True, "x"), (False, None)]


def test_requests_by_family():
    chat = completion.request("gpt-4o", "p", "c", token_param="max_completion_tokens", temperature=None)
    assert "temperature" not in chat and chat["max_completion_tokens"] == 1000 and chat["messages"][0]["role"] == "system"
    assert completion.request("o1-mini", "p", "c")["max_completion_tokens"] == 1500 and "temperature" not in completion.request("o1-mini", "p", "c")
    assert completion.request("gpt-5", "p", "c", max_tokens=4000)["max_output_tokens"] == 4000


def test_batch_isolates_failures(spark, tmp_path):
    def make():
        def work(row):
            if row["k"] % 2:
                raise TimeoutError("late")

        return work

    results = batch.run(spark.range(6).withColumnRenamed("id", "k"), "k", make)
    assert batch.report(results, str(tmp_path / "r.json"), "k") == {"success": 3, "timeout": 3}


def test_reports_say_what_they_leave_out(spark, monkeypatch):
    monkeypatch.setattr(sinks, "REPORT_ROWS", 3)
    assert "2 more rows are not shown" in sinks.markdown(spark.range(5), "t") and "2 more rows" in sinks.html_page(spark.range(5), "t")
    assert "more rows" not in sinks.markdown(spark.range(3), "t")


def test_a_column_that_a_batch_lacks_stays(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", ["at"])
    table.upsert(spark.createDataFrame([("a", 1, 1, "w"), ("b", 1, 1, "x")], "k string, v int, at int, w string"), 0)
    table.upsert(spark.createDataFrame([("c", 2, 2)], ROWS), 1)
    table.upsert(spark.createDataFrame([("a", 3, 3, True)], "k string, v int, at int, z boolean"), 2)
    assert table.read().columns == ["k", "v", "at", "w", "z"]
    assert {r.k: (r.v, r.w, r.z) for r in table.read().collect()} == {"a": (3, None, True), "b": (1, "x", None), "c": (2, None, None)}


def test_the_last_result_of_a_key_and_day_counts(spark, tmp_path):
    cache = store.ResultCache(spark, f"{tmp_path}/cache")
    frame = lambda *r: spark.createDataFrame(list(r), "key string, result string, day string")
    asked = spark.createDataFrame([("a", "2024-01-02"), ("a", "2024-01-03"), ("b", "2024-01-02"), (None, "2024-01-02"), ("a", "2024-01-02")], "key string, day string")
    found = lambda: sorted((str(r.key), r.day, str(r.result)) for r in cache.find(asked).collect())
    assert [r[2] for r in found()] == ["None"] * 5
    cache.put(frame(("a", "old", "2024-01-02"), ("b", "b", "2024-01-02"), ("b", None, "2024-01-02")))
    cache.put(frame(("a", "new", "2024-01-02"), ("a", "next day", "2024-01-03")))
    want = [("None", "2024-01-02", "None"), ("a", "2024-01-02", "new"), ("a", "2024-01-02", "new"), ("a", "2024-01-03", "next day"), ("b", "2024-01-02", "b")]
    assert found() == want
    for _ in range(2):
        cache.compact("2024-01-02")
        assert found() == want and spark.read.parquet(f"{tmp_path}/cache/day=2024-01-02").count() == 2
    cache.put(frame(("a", "newest", "2024-01-02")))
    assert [r[2] for r in found()] == ["None", "newest", "newest", "next day", "b"]
    assert cache.forget("2024-01-03") == ["2024-01-02"] and cache.days() == ["2024-01-03"]
    assert [r[2] for r in found()] == ["None", "None", "None", "next day", "None"]


def test_prefixes_are_joined_by_equality(spark):
    from colloquy.operators import costs

    prefixes = spark.range(100_000).selectExpr("concat('p', id) AS prefix", "CAST(id AS INT) AS ord", "id * 1.0D AS rate_in", "0.5D AS rate_out")
    models = spark.createDataFrame([("p1-mini",), ("p99999",), ("p777777x",), ("q1",), ("",), (None,), ("p12",)], "model string")
    got = costs.by_longest_prefix(models, prefixes)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert {r.model: r.prefix for r in got.collect()} == {"p1-mini": "p1", "p99999": "p99999", "p777777x": "p77777", "q1": None, "": None, None: None, "p12": "p12"}
    first = costs.by_first_prefix(models, prefixes)
    assert "NestedLoop" not in first._jdf.queryExecution().toString()
    assert {r.model: r.config for r in first.collect()} == {"p1-mini": "p1", "p99999": "p99999", "p777777x": "p7", "q1": None, "": None, None: None, "p12": "p12"}


def test_the_least_of_several_aliases_wins(spark):
    from colloquy.operators import names

    mappings = spark.createDataFrame([("A ", "z"), ("a", "y"), ("b", "x")], "variant_name string, canonical_name string")
    got = names.canonical(spark.createDataFrame([("a",), (" B",), ("c",)], "n string"), "n", mappings, "out")
    assert {r.n: r.out for r in got.collect()} == {"a": "y", " B": "x", "c": "c"}
