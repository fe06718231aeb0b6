"""Files as a data source: batch and stream give the same rows, filters spare files, files come once."""

import os

import pytest
from pyspark.sql import functions as F

from colloquy.sources import landing, transcripts


@pytest.fixture
def folder(spark, tmp_path):
    landing.register(spark)
    at = tmp_path / "in"
    (at / "below").mkdir(parents=True)
    for k in range(9):
        (at / f"t{k}.{('md', 'txt', 'TXT')[k % 3]}").write_text(f"Title {k}\nAnn: ü {k}\n")
    (at / "below" / "deep.md").write_text("Deep")
    (at / "no.csv").write_text("a,b")
    (at / ".hidden.md").write_text("x")
    (at / "empty.txt").write_text("")
    return str(at)


def table(spark, folder, **options):
    return spark.read.format("landing").options(settleSeconds=0, **options).load(folder)


def test_rows_are_those_of_a_scan(spark, folder):
    here = table(spark, folder, recursive="false")
    wanted = {(r.stem, r.size, r.md5, r.text) for r in transcripts.scan(spark, folder).filter(~F.col("path").contains(".hidden")).collect()}
    # (Spark's own files leave empty ones out)
    assert {(r.stem, r.size, r.md5, r.text) for r in here.filter("size > 0").collect()} == wanted and len(wanted) == 9 and here.count() == 10
    types = {r.name: r.content_type for r in here.collect()}
    assert types["t0.md"] == "text/markdown" and types["t2.TXT"] == "text/plain"


def test_partitions_are_runs_of_files(spark, folder):
    assert table(spark, folder).count() == 11
    assert table(spark, folder, partitionBytes="1").rdd.getNumPartitions() == 11
    assert table(spark, folder, partitionBytes="40").rdd.getNumPartitions() in range(4, 9)
    assert table(spark, f"{folder}/none").count() == 0


def test_filters_spare_files(spark, folder):
    os.chmod(f"{folder}/t1.txt", 0)
    os.remove(f"{folder}/t1.txt")
    os.symlink(f"{folder}/gone", f"{folder}/t1.txt")  # can't be opened
    some = table(spark, folder)
    assert {r.name for r in some.filter(F.col("name").endswith(".md")).collect()} == {"t0.md", "t3.md", "t6.md", "deep.md"}
    assert {r.name for r in some.filter(F.col("path").startswith(f"{folder}/below/")).collect()} == {"deep.md"}
    assert {r.name for r in some.filter(F.col("name").isin("t0.md", "t3.md") & (F.col("size") > 0)).collect()} == {"t0.md", "t3.md"}
    etag = some.filter(F.col("name") == "t0.md").first().etag
    assert [r.name for r in some.filter((F.col("etag") == etag) & F.col("name").contains("t")).collect()] == ["t0.md"]


def test_only_filters_on_the_listing_are_taken():
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, StringStartsWith

    reader = landing.Reader(landing.Folder.of({"path": "/x"}))
    given = [EqualTo(("size",), 3), GreaterThan(("path",), "a"), IsNotNull(("name",)), StringStartsWith(("path",), "/x/a")]
    assert [*reader.pushFilters(given)] == given[:3] and len(reader.tests) == 1


def test_a_stream_takes_files_once_over_restarts(spark, folder, tmp_path):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"

    def run():
        stream = spark.readStream.format("landing").option("settleSeconds", 0).load(folder)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.path, r.md5) for r in spark.read.parquet(out).collect())

    batch = lambda: sorted((r.path, r.md5) for r in table(spark, folder).collect())
    assert run() == batch()
    assert run() == batch()  # nothing new
    for k in range(3):
        with open(f"{folder}/late{k}.md", "w") as f:
            f.write(f"late {k}")
    first = batch()
    assert run() == first and len(first) == 14
    with open(f"{folder}/late0.md", "w") as f:
        f.write("written again")
    assert sorted({*first, *batch()}) == run()


def test_files_wait_until_they_have_settled(folder):
    reader = landing.StreamReader(landing.Folder.of({"path": folder, "settleSeconds": "3600"}))
    assert reader.latestOffset() == reader.initialOffset()
    assert landing.Landing({"path": folder}).streamReader(None).folder.settle_s == 2
    with pytest.raises(ValueError, match="path"):
        landing.Folder.of({})
