import __spark_entry__ as entry


def test_entry_and_names(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "avg_score" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
