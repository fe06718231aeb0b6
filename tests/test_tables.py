"""Keyed tables: merges against the operator on plain frames, bytes that follow the batch, two writers, unique keys."""

import pytest
from pyspark.sql import functions as F

from colloquy.operators import tables
from colloquy.operators.merge import merge
from colloquy.sources import files

ROWS = "k string, a int, b string, c int"


@pytest.fixture
def frame(spark):
    return lambda *r, ddl=ROWS: spark.createDataFrame(list(r), ddl).coalesce(1)


@pytest.fixture
def folder(spark, tmp_path, frame):
    made = tables.Folder(spark, f"{tmp_path}/t")
    start = made.begin()
    start.create("t", "k", frame().schema, buckets=4)
    start.append_unique("t", frame(*[(f"k{n}", n, "old", n) for n in range(40)], (None, -1, "null", 0)))
    assert start.commit() == 1
    return made


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merges_are_those_of_the_operator(folder, frame):
    want = folder.read("t")
    sources = [
        frame(("k1", 100, None, 7), ("k39", 101, "new", None), ("x", 102, "new", 9), (None, 5, "also", 5)),
        frame(("x", None, "newer", 1), ("k1", 1, "b", 2)),
        frame(("k1", 5, None, None), ("y", 6, None, 6)),
    ]
    for source in sources:
        change = folder.begin()
        change.merge("t", source, set_=["a"], coalesce=["b"], insert_only=["c"])
        change.commit()
        assert change.written == source.count()
        want = merge(want, source, "k", set_=["a"], coalesce=["b"], insert_only=["c"]).drop("_op").localCheckpoint()
        assert rows(folder.read("t")) == rows(want)
    with pytest.raises(Exception, match="several source rows"):
        folder.begin().merge("t", frame(("k1", 1, "b", 2), ("k1", 2, "b", 2)), set_=["a"])


def test_what_a_merge_writes_follows_its_source(spark, folder, frame):
    size = lambda: sum(files.store(spark, p)[0].getContentSummary(files.store(spark, p)[1]).getLength() for p in [f"{folder.path}/t"])
    grow = folder.begin()
    grow.append_unique("t", spark.range(50_000).selectExpr("concat('n', id) AS k", "CAST(id AS INT) AS a", "sha2(CAST(id AS STRING), 256) AS b", "1 AS c"))
    grow.commit()
    whole = size()
    small = folder.begin()
    small.merge("t", frame(*[(f"n{n * 997}", 0, "x", 0) for n in range(50)]), set_=["a", "b"])
    small.commit()
    assert small.written == 50 and size() - whole < whole / 10  # (what is left are the footers of a few files)
    assert folder.read("t").count() == 50_041 and folder.read("t").filter("b = 'x'").count() == 50


def test_older_versions_stay_readable_until_cleaned(spark, folder, frame):
    before = rows(folder.read("t"))
    for k in range(3):
        change = folder.begin()
        change.upsert("t", frame(("k1", k, "b", k)))
        change.commit()
    assert rows(folder.read("t", 1)) == before and folder.versions() == [1, 2, 3, 4]
    now = rows(folder.read("t"))
    folder.clean(keep=1)
    assert folder.versions() == [4] and rows(folder.read("t")) == now
    assert not files.names(spark, f"{folder.path}/staged")


def test_writers_of_different_parts_both_commit_and_of_one_part_one(folder, frame, spark):
    part = {r.k: r.b for r in spark.createDataFrame([(f"k{n}",) for n in range(40)], "k string").withColumn("b", F.pmod(F.xxhash64("k"), F.lit(4))).collect()}
    one = "k0"
    other = next(k for k in part if part[k] != part[one])
    first, second, third = folder.begin(), folder.begin(), folder.begin()
    first.upsert("t", frame((one, 1000, "first", 1)))
    second.upsert("t", frame((other, 2000, "second", 1)))
    third.upsert("t", frame((one, 3000, "third", 1)))
    assert first.commit() == 2 and second.commit() == 3
    with pytest.raises(tables.Conflict):
        third.commit()
    found = {r.k: r.a for r in folder.read("t").collect()}
    assert found[one] == 1000 and found[other] == 2000 and len(found) == 41
    again = folder.begin()
    again.upsert("t", frame((one, 3000, "third", 1)))
    again.commit()
    assert {r.k: r.a for r in folder.read("t").collect()}[one] == 3000


def test_a_version_is_made_by_one_of_two_at_the_same_moment(folder, frame, monkeypatch):
    mine, theirs = folder.begin(), folder.begin()
    mine.create("u", "k", frame().schema)
    theirs.create("v", "k", frame().schema)
    real, done = files.create, []

    def late(*a):
        if not done:
            done.append(1)
            theirs.commit()
        return real(*a)

    monkeypatch.setattr(files, "create", late)
    assert mine.commit() == 3 and set(folder.state()[1]["tables"]) == {"t", "u", "v"}


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, folder, frame, monkeypatch):
    before = rows(folder.read("t"))
    change = folder.begin()
    change.upsert("t", frame(("k1", 9, "b", 9)))

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(files, "create", stop)
        with pytest.raises(OSError):
            change.commit()
    assert rows(folder.read("t")) == before
    files.put(spark, f"{folder.path}/versions/{2:012d}", "")  # made, but never filled
    assert rows(folder.read("t")) == before
    again = folder.begin()
    again.upsert("t", frame(("k1", 9, "b", 9)))
    assert again.commit() == 3 and ("k1", 9, "b", 9) in rows(folder.read("t"))


def test_a_batch_is_committed_once(folder, frame):
    for _ in range(2):
        change = folder.begin()
        if not change.has("s", 4):
            change.upsert("t", frame(("k1", 77, "b", 9)))
            change.commit(("s", 4))
    assert folder.versions() == [1, 2] and folder.begin().has("s", 3)
    late = folder.begin()
    late.state["batches"] = {}  # as of a writer that began before
    late.upsert("t", frame(("k1", 78, "b", 9)))
    assert late.commit(("s", 4)) == 2 and {r.k: r.a for r in folder.read("t").collect()}["k1"] == 77


@pytest.mark.parametrize("listed", [1000, 1])
def test_unique_keys_are_refused_on_write(folder, frame, monkeypatch, listed):
    monkeypatch.setattr(tables, "LISTED", listed)
    before = rows(folder.read("t"))
    for bad in ([("n1", 1, "", 1), ("n1", 2, "", 1)], [("n1", 1, "", 1), ("n2", 1, "", 1), ("k7", 2, "", 1)]):
        with pytest.raises(tables.Refused):
            folder.begin().append_unique("t", frame(*bad))
    assert rows(folder.read("t")) == before and folder.versions() == [1]
    gone = folder.begin()
    gone.delete("t", frame(("k7",), ("none",), ddl="k string"))
    gone.commit()
    good = folder.begin()
    good.append_unique("t", frame(("k7", 2, "", 1), (None, 3, "", 1), (None, 4, "", 1)))
    good.commit()
    assert folder.read("t").count() == 43 and {r.k: r.a for r in folder.read("t").collect()}["k7"] == 2


def test_an_append_of_new_keys_reads_only_the_index(spark, folder, frame, monkeypatch):
    loaded, real = [], tables.Transaction._load
    monkeypatch.setattr(tables.Transaction, "_load", lambda self, name, kind, *a: (loaded.append(kind), real(self, name, kind, *a))[1])
    folder.begin().append_unique("t", frame(("n1", 1, "", 1), ("n2", 1, "", 1)))
    assert "index" in loaded and "rows" not in loaded


def test_columns_are_never_lost(folder, frame):
    for source in (frame(("k1", "late"), ddl="k string, d string"), frame(("k2", 5), ddl="k string, a int")):
        change = folder.begin()
        change.upsert("t", source)
        change.commit()
    found = {r.k: r for r in folder.read("t").collect()}
    assert (found["k1"].a, found["k1"].d, found["k2"].a, found["k2"].b, found["k2"].d) == (1, "late", 5, "old", None)


def test_latest_rows_stay_and_compaction_changes_nothing(folder, frame):
    for batch in ([("k1", 1, "later", 50), ("k2", 1, "earlier", 0)], [("k1", 2, "earlier", 49), ("z", 1, "", 1)], [("z", 2, "", 2), ("z", 3, "", 0)]):
        change = folder.begin()
        change.upsert("t", frame(*batch), order=["c"])
        change.commit()
    found = {r.k: r.b for r in folder.read("t").collect()}
    assert found["k1"] == "later" and found["k2"] == "old" and {r.k: r.a for r in folder.read("t").collect()}["z"] == 2
    before = rows(folder.read("t"))
    change = folder.begin()
    assert change.compact("t", runs=1)
    change.commit()
    assert rows(folder.read("t")) == before and all(len(p["runs"]) == 1 and not p["dead"] for p in folder.state()[1]["tables"]["t"]["parts"].values() if p["n"])
    assert folder.begin().compact("t", runs=5) == []


def test_an_empty_source_changes_nothing(folder, frame):
    before = rows(folder.read("t"))
    for do in ("upsert", "append_unique"):
        change = folder.begin()
        getattr(change, do)("t", frame())
        change.commit()
    change = folder.begin()
    change.delete("t", frame(ddl="k string"))
    change.commit()
    assert rows(folder.read("t")) == before
