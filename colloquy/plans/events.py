"""Events as they come: claims in a stream's state, arrivals worked into tables, keyed tables under changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import spans, tables
from colloquy.plans.registry import Registry
from colloquy.sources import files, landing, table
from colloquy.streaming import claims, intake

R = Registry()
c = F.col


@R.query("""
WITH e AS (SELECT user_id AS key, CAST(ts AS DATE) AS day, event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'request' END AS kind,
           row_number() OVER w AS rn, count(*) FILTER (event_type = 'error') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS span
           FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)),
f AS (SELECT *, min(CASE WHEN kind = 'request' THEN rn END) OVER (PARTITION BY key, day, span) AS first FROM e),
d AS (SELECT *, min(CASE WHEN kind = 'completed' AND rn > first THEN rn END) OVER (PARTITION BY key, day) AS done FROM f)
SELECT key, day, event_id, kind, CASE WHEN kind = 'request' THEN CASE WHEN rn = first AND (done IS NULL OR rn < done) THEN 'granted' ELSE 'duplicate' END
       WHEN kind = 'completed' THEN CASE WHEN rn = done THEN 'taken' ELSE 'ignored' END
       ELSE CASE WHEN first < rn AND (done IS NULL OR rn < done) THEN 'taken' ELSE 'ignored' END END AS answer FROM d""")
def day_claims(spark: SparkSession, sf: str) -> DataFrame:
    """A claim a user and day, given back by errors and ended by purchases, in three runs of one stream."""
    kind = F.when(c("event_type") == "error", claims.FAILED).when(c("event_type") == "purchase", claims.COMPLETED).otherwise(claims.REQUEST)
    return claims.replay(spark, table(spark, sf, "events"), c("user_id"), kind).select("key", "day", "event_id", "kind", "answer")


def _tried(df: DataFrame) -> DataFrame:
    """Work on events that fails for good on errors, and else twice at most before it succeeds."""
    kind = F.when(c("event_type") == "error", intake.PERMANENT).when(c("attempts") < c("event_id") % 3, intake.TRANSIENT).otherwise(intake.COMPLETED)
    return df.withColumns({"outcome": kind, "error": F.when(kind != intake.COMPLETED, F.concat(F.lit("try "), c("attempts") + 1)), "doubled": c("value") * 2})


@R.query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN event_type <> 'error' THEN event_id % 3 + 1 WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 2 ELSE 1 END AS attempts, CASE WHEN event_type <> 'error' THEN value * 2 END AS doubled,
       CASE WHEN event_type = 'error' THEN 'try ' || (CASE WHEN CAST(ts AS DATE) < DATE '2024-01-16' THEN 2 ELSE 1 END) END AS error
FROM events""")
def event_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Events delivered in two batches, the second of which has all of the first once more, until nothing waits."""
    events = table(spark, sf, "events").withColumn("ts", c("ts").cast("timestamp"))
    run = intake.Intake(spark, files.shared_folder(spark, "pipeline"), events.schema, "event_id", ["ts"], _tried, ["doubled"], buckets=4)
    run.process(events.filter("CAST(ts AS DATE) < DATE '2024-01-16'"), 0)
    run.process(events, 1)
    run.process(events, 1)  # delivered again, as after a failure behind the commit
    run.drain()
    status, results = run.folder.read("status"), run.folder.read("results")
    return status.join(results, "event_id", "left").select("event_id", "status", c("attempts").cast("bigint").alias("attempts"), "doubled", "error")


_TARGET = "(SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0)"
_SOURCE = "(SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN 'N' END AS o_orderstatus, CASE WHEN o_orderkey % 4 <> 0 THEN 'fresh' END AS o_orderpriority, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0)"


@R.query(f"""
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority, CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM {_TARGET} t FULL JOIN {_SOURCE} s ON t.o_orderkey = s.o_orderkey WHERE coalesce(t.o_orderkey, s.o_orderkey) % 7 <> 0""")
def keyed_table_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A table filled under a unique key, merged into by two writers at once, and with rows deleted; refused appends change nothing."""
    orders, key = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"), c("o_orderkey")
    source = orders.filter(key % 2 == 0).withColumns({"o_orderstatus": F.when(key % 5 != 0, "N"), "o_orderpriority": F.when(key % 4 != 0, "fresh"), "o_totalprice": c("o_totalprice") + 1})
    folder = tables.Folder(spark, files.shared_folder(spark, "tables"))
    filled = folder.begin()
    filled.create("orders", "o_orderkey", orders.schema, buckets=8)
    filled.append_unique("orders", orders.filter(key % 3 != 0))
    filled.commit()
    try:
        folder.begin().append_unique("orders", orders.filter(key % 3 == 1))
        raise AssertionError("a known key was taken")
    except tables.Refused:
        pass
    low = F.pmod(F.xxhash64("o_orderkey"), F.lit(8)) < 4  # of other parts than the rest
    writers = [(folder.begin(), source.filter(side)) for side in (low, ~low)]
    for change, rows in writers:
        change.merge("orders", rows, set_=["o_orderstatus"], coalesce=["o_orderpriority"], insert_only=["o_totalprice"])
    for change, _ in writers:
        change.commit()
    gone = folder.begin()
    gone.delete("orders", orders.filter(key % 7 == 0).select("o_orderkey"))
    gone.commit()
    return folder.read("orders")


@R.query("SELECT conv_id, turn, role, text, 'text/plain' AS content_type FROM conversations")
def landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations written as files of JSON lines, in two goes, and streamed from the folder after each."""
    landing.register(spark)
    folder = files.shared_folder(spark, "landing").removeprefix("file:")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    for part in (0, 1):
        turns.filter(c("conv_id") % 2 == part).select(F.to_json(F.struct(*turns.columns)).alias("value")).write.mode("append").text(f"{folder}/in")
        stream = spark.readStream.format("landing").option("settleSeconds", 0).load(f"{folder}/in").filter(c("name").startswith("part-"))
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    lines = spark.read.parquet(f"{folder}/out").select("content_type", F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    return lines.select(F.from_json("line", turns.schema).alias("t"), "content_type").select("t.*", "content_type")


_SPANS = r"SELECT DISTINCT span FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS span FROM benchmark) WHERE length(span) >= 8"


@R.query(f"""
WITH s AS ({_SPANS}), d AS (SELECT doc_id, text, (SELECT count(*) FROM s WHERE contains(lower(d.text), s.span)) AS n FROM documents d)
SELECT doc_id, coalesce(n > 0, false) AS residue, n AS spans, false AS after FROM d""")
def many_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Every long word of the benchmark as a span: how many of them stand in each document, and whether one is left after they are scrubbed."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("span")
    known = table(spark, sf, "benchmark").select(words).distinct().filter("length(span) >= 8").select("span", c("span").alias("category"))
    docs = table(spark, sf, "documents").select("doc_id", "text", c("text").alias("scrubbed"))
    found = spans.found(docs, ["text"], known)
    counted = found.select("doc_id", F.size(F.array_distinct(F.transform(F.coalesce(spans.FOUND + "text", F.array().cast(spans.MATCHES)), lambda m: m["category"]))).cast("bigint").alias("spans"))
    placed = known.select("span", F.lit("x").alias("category"))
    after = spans.residue(spans.scrub(docs.select("doc_id", "scrubbed"), ["scrubbed"], placed), ["scrubbed"], placed).select("doc_id", c("residue").alias("after"))
    return counted.join(after, "doc_id").select("doc_id", (c("spans") > 0).alias("residue"), "spans", "after")
