"""A file for each row: written by tasks, and read as Spark's own readers do."""

import bz2
import gzip

import duckdb
import pytest
from colloquy import schemas
from colloquy.operators import store
from colloquy.plans import flows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def names(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith((".", "_")))


def test_files_are_those_of_sparks_writer(spark, tmp_path):
    given = ["a", "b c", 'q"#%\'*:=?\\\x7f{[]^', "x/y", "é\n", "", None, "same", "same"]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(given)], "id string, n int")
    store.write_each(rows, F.col("id"), f"{tmp_path}/ours")
    rows.select(F.col("id").alias("name"), F.to_json(F.struct("id", "n")).alias("value")).write.partitionBy("name").text(f"{tmp_path}/sparks")
    assert names(tmp_path / "ours") == names(tmp_path / "sparks")
    lines = lambda which: sorted(map(str, spark.read.text(f"{tmp_path}/{which}").collect()))
    assert lines("ours") == lines("sparks") and len(lines("ours")) == len(given)
    assert len([*(tmp_path / "ours" / "name=same").iterdir()]) == 1  # no sums of Hadoop's beside it, for which processes are started
    assert (tmp_path / "ours" / "_SUCCESS").exists() and sorted(p.name for p in tmp_path.iterdir()) == ["ours", "sparks"]


def test_a_folder_is_replaced_whole_or_stays(spark, tmp_path):
    path = f"{tmp_path}/each"
    one = lambda value: F.when(F.col("id") >= 0, F.col("id").cast("string")).otherwise(value)
    store.write_each(spark.range(3), one(F.lit("")), path)
    with pytest.raises(Exception, match="refused"):
        store.write_each(spark.range(-1, 50), one(F.raise_error(F.lit("refused"))), path)
    assert names(tmp_path / "each") == ["name=0", "name=1", "name=2"] and names(tmp_path) == ["each"]
    store.write_each(spark.range(2, 4), one(F.lit("")), path)
    assert names(tmp_path / "each") == ["name=2", "name=3"]
    store.write_each(spark.range(0), one(F.lit("")), path)
    assert names(tmp_path / "each") == [] and store.documents(spark, f"{path}/*").count() == 0


def test_documents_of_folders_are_as_spark_reads_them(spark, tmp_path):
    def put(name, data):
        at = tmp_path / "docs" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data.encode() if isinstance(data, str) else data)

    put("a/one.json", '{\n"meeting_id": "a", "date": "2024-01-02", "title": 7, "participants": ["x", null]}')
    put("a/two.json", '{"meeting_id": "é\U0001f600\\u0000"} ')
    put("b/array.json", '[{"meeting_id": "c"}, {"meeting_id": "d"}]')
    put("b/broken.json", '{"meeting_id": "e"')
    put("b/broken array.json", '[{"meeting_id": "e"')
    put("c/day.json", '{"meeting_id": "f", "date": "soon"}')
    put("c/empty.json", "")
    put("c/blank.json", " \n")
    put("c/text.json", '"text"')
    put("d/utf16.json", '{"meeting_id": "gé"}'.encode("utf-16"))
    put("d/mark.json", b"\xef\xbb\xbf" + b'{"meeting_id": "h"}')
    put("d/bytes.json", b'{"meeting_id": "\xff\xfe"}')
    put("d/packed.json.gz", gzip.compress(b'{"meeting_id": "i"}'))
    put("d/packed.json.bz2", bz2.compress(b'{"meeting_id": "j"}'))
    put("d/_passed.json", '{"meeting_id": "hidden"}')
    put("_passed.json", '{"meeting_id": "hidden"}')
    put("_e/named.json", '{"meeting_id": "m"}')
    put("beside.json", '{"meeting_id": "k"}{"meeting_id": "l"}')
    put("d/deep/er.json", '{"meeting_id": "below"}')
    schema = StructType([*schemas.TRANSCRIPT.fields]).add("_corrupt", "string")
    sparks = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(f"{tmp_path}/docs/*")
    got, wanted = (sorted(map(str, df.collect())) for df in (store.documents(spark, f"{tmp_path}/docs/*"), sparks))
    assert got == wanted and len(got) > 10
    assert store.documents(spark, f"{tmp_path}/docs/*").columns == sparks.columns


def test_turns_that_look_alike_and_nulls(spark, tmp_path):
    odd = [(1, 2, "a|b", "c"), (1, 2, "a", "b|c"), (1, 2, None, "x"), (1, 2, "x", None), (1, 2, "x", ""), (None, 3, "u", "t"), (None, 4, "u", "t"), (5, None, "u", "t"), (1, -2, "/", '\\"\u2028\x00'), *[(9, 9, "r", "s")] * 3]
    at = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(odd, "conv_id bigint, turn bigint, role string, text string").write.parquet(at)
    made = flows.json_documents(spark, str(tmp_path))
    sql = flows.R.sql["json_documents"].replace("FROM conversations", f"FROM '{at}/*.parquet'")
    wanted = duckdb.connect().execute(sql).fetchall()
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, wanted))
    assert made.count() == len(wanted) == 8
