"""Every catalogue query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from colloquy.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


@pytest.fixture(scope="module")
def duck():
    made = duckdb.connect()
    for name in os.listdir(DATA):
        made.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return made


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    assert name in catalogue.ORACLE_SQL
    got = duck.execute(catalogue.ORACLE_SQL[name])
    order = [d[0] for d in got.description]
    assert sorted(order) == columns
    want = sorted(repr([plain(row[order.index(c)]) for c in columns]) for row in got.fetchall())
    assert sorted(repr([plain(row[c]) for c in columns]) for row in df.collect()) == want


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.QUERIES["assessment_status"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    top = catalogue.QUERIES["top_performers"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top and "GreaterThan(c_acctbal,0.0)" in top
