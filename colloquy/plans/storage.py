"""Merges, mappings, schema changes, claims and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import dedup, merge, routing
from colloquy.plans.registry import Registry
from colloquy.sources import table
from colloquy.streaming import upserts

R = Registry()

_TARGET = "(SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)"
_SOURCE = "(SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'N' END AS o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'fresh' END AS o_orderpriority, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0)"
_MERGED = f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority, t.o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS _op
FROM {_TARGET} t FULL JOIN {_SOURCE} s ON t.o_orderkey = s.o_orderkey"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders, key = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"), F.col("o_orderkey")
    source = orders.filter(key % 2 == 0).withColumns({"o_orderstatus": F.when(key % 5 != 0, "N"), "o_orderpriority": F.when(key % 4 != 0, "fresh"), "o_totalprice": F.col("o_totalprice") + 1})
    return orders.filter(key % 3 != 0), source


@R.query(_MERGED)
def merge_client_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(*_sides(spark, sf), "o_orderkey", set_=["o_orderstatus"], coalesce=["o_orderpriority"])


@R.query(_MERGED.replace("CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus", "t.o_orderstatus").replace("t.o_totalprice,", "CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,"))
def merge_talent_keeps_other_domain(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(*_sides(spark, sf), "o_orderkey", set_=["o_totalprice"], coalesce=["o_orderpriority"])


@R.query(f"SELECT count(*) FILTER (_op = 'insert') AS inserted, count(*) FILTER (_op = 'update') AS updated, count(*) FILTER (_op <> 'keep') AS affected FROM ({_MERGED})")
def merge_stats(spark: SparkSession, sf: str) -> DataFrame:
    return merge.stats(merge.merge(*_sides(spark, sf), "o_orderkey", set_=["o_orderstatus"], coalesce=["o_orderpriority"]))


@R.query("""
SELECT coalesce(t.v, s.v) AS variant_name, CASE WHEN s.v IS NOT NULL THEN s.c ELSE t.c END AS canonical_name, CASE WHEN s.v IS NOT NULL THEN s.n ELSE t.n END AS notes,
       CASE WHEN t.v IS NOT NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
       CASE WHEN s.v IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS updated_at,
       CASE WHEN s.v IS NULL THEN 'keep' WHEN t.v IS NULL THEN 'insert' ELSE 'update' END AS _op
FROM (SELECT n_name AS v, n_name AS c, CAST(NULL AS VARCHAR) AS n FROM nation WHERE n_nationkey < 15) t
FULL JOIN (SELECT n_name AS v, 'X' || n_name AS c, 'new' AS n FROM nation WHERE n_nationkey >= 10) s ON t.v = s.v""")
def mapping_upsert_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    nations, at = table(spark, sf, "nation"), lambda d: F.lit(d).cast("timestamp_ntz")
    target = nations.filter("n_nationkey < 15").select(F.col("n_name").alias("variant_name"), F.col("n_name").alias("canonical_name"), F.lit(None).cast("string").alias("notes"), at("2024-01-01").alias("created_at"), at("2024-01-01").alias("updated_at"))
    source = nations.filter("n_nationkey >= 10").select(F.col("n_name").alias("variant_name"), F.concat(F.lit("X"), "n_name").alias("canonical_name"), F.lit("new").alias("notes"))
    return merge.upsert_mapping(target, source, at("2024-02-01"))


@R.query("SELECT c_custkey, c_name FROM customer WHERE NOT coalesce(c_mktsegment = 'BUILDING', false)")
def mapping_delete(spark: SparkSession, sf: str) -> DataFrame:
    return merge.delete(table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@R.query("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), 'client') AS scoring_domain FROM customer")
def backfill_null_update(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("scoring_domain"))
    return merge.backfill(rows, "scoring_domain", F.lit("client"))


@R.query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def schema_evolution_union(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return merge.evolve(old, new)


@R.query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1 AS claimed FROM events")
def claim_first_writer(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return dedup.first_claims(events, ["user_id", "event_type", "day"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "claimed")


@R.query("SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events c WHERE c.user_id = e.user_id AND c.event_type = 'purchase' AND c.value > 90)")
def unclaimed_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    claims = events.select("user_id", F.when((F.col("event_type") == "purchase") & (F.col("value") > 90), "completed").otherwise("failed").alias("status"))
    return dedup.unclaimed(events, claims, ["user_id"]).select("event_id", "user_id")


@R.query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_upsert_final_state(spark: SparkSession, sf: str) -> DataFrame:
    return upserts.replay(spark, f"{sf}/events.parquet", "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@R.query("""
SELECT doc_id, CASE WHEN s IN ('client', 'talent') THEN s END AS route, CASE WHEN coalesce(s, '') = '' THEN 'missing source' WHEN s NOT IN ('client', 'talent') THEN 'unknown source' END AS reject
FROM (SELECT doc_id, lower(trim(CASE doc_id % 5 WHEN 0 THEN ' Client ' WHEN 1 THEN 'talent' WHEN 2 THEN '  ' WHEN 3 THEN source END)) AS s FROM documents)""")
def route_by_source(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(F.col("doc_id") % 5 == 0, " Client ").when(F.col("doc_id") % 5 == 1, "talent").when(F.col("doc_id") % 5 == 2, "  ").when(F.col("doc_id") % 5 == 3, F.col("source"))
    return routing.route(table(spark, sf, "documents").select("doc_id", given.alias("given")), "given").select("doc_id", "route", "reject")


@R.query("SELECT 'cache/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '/m' || event_id || '-gpt-5-mini-' || event_type || '-flag.json' AS key FROM events")
def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(routing.cache_key(F.col("ts").cast("date"), F.concat(F.lit("m"), "event_id"), F.lit("gpt-5-mini"), F.col("event_type"), F.lit("flag")).alias("key"))
