"""Analytical queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.columns import json_scalar, percent
from colloquy.operators import costs, dedup, names, reports
from colloquy.plans.registry import Registry
from colloquy.sources import table

R = Registry()
AS_OF = "2024-01-31"


@R.query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_wins_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_wins(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


@R.query("SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_keys, count(*) - count(DISTINCT user_id) AS duplicates FROM events")
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_count(table(spark, sf, "events"), "user_id")


@R.query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def uniqueness_violations(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.violations(table(spark, sf, "orders"), "o_custkey")


@R.query("SELECT event_id, ts, user_id, json_extract_string(props, '$.k') AS k FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def recent_top_n(spark: SparkSession, sf: str) -> DataFrame:
    return reports.recent(table(spark, sf, "events").select("event_id", "ts", "user_id", json_scalar("props", "$.k").alias("k")), [F.desc("ts"), F.desc("event_id")], 5)


@R.query("""
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS score, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 7 AND DATE '2024-01-31' AND json_extract_string(props, '$.k') IS NOT NULL
ORDER BY score DESC, value DESC, event_id LIMIT 50""")
def sales_performance_rows(spark: SparkSession, sf: str) -> DataFrame:
    score = json_scalar("props", "$.k").cast("bigint")
    rows = table(spark, sf, "events").filter(reports.since("ts", AS_OF, 7)).select("event_id", "user_id", score.alias("score"), "value").filter("score IS NOT NULL")
    return reports.recent(rows, [F.desc("score"), F.desc("value"), F.asc("event_id")], 50)


@R.query("""
SELECT c_custkey, c_name, count(*) AS meetings, round(avg(o_totalprice), 6) AS avg_score,
       round(count(*) FILTER (o_orderstatus = 'F') * 100.0 / count(*), 1) AS rate, max(o_totalprice) AS best, min(o_totalprice) AS worst
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 HAVING count(*) >= 3""")
def salesperson_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return reports.summary(rows, ["c_custkey", "c_name"], "o_totalprice", F.col("o_orderstatus") == "F", 3, digits=6)


@R.query("""
SELECT count(*) AS assessed, count(*) FILTER (value >= 50) AS qualified, count(*) FILTER (event_type = 'error') AS failed,
       round(avg(value), 2) AS avg_value, count(DISTINCT user_id) AS people
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 30 AND DATE '2024-01-31'""")
def assessment_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").filter(reports.since("ts", AS_OF, 30))
    return rows.agg(F.count(F.lit(1)).alias("assessed"), F.count_if(F.col("value") >= 50).alias("qualified"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(F.avg("value"), 2).alias("avg_value"), F.count_distinct("user_id").alias("people"))


@R.query("SELECT l_linenumber, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM lineitem GROUP BY 1")
def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.distribution(table(spark, sf, "lineitem"), "l_linenumber")


@R.query("SELECT source, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM documents GROUP BY 1")
def domain_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.distribution(table(spark, sf, "documents"), "source")


@R.query("""
SELECT count(*) AS total, count(*) FILTER (quality = 1) AS quality_passed, count(*) FILTER (toxic = 0) AS clean_passed,
       count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars >= 500) AS long_enough
FROM documents JOIN labels USING (doc_id)""")
def criteria_pass_rates(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    c = F.col
    return reports.pass_rates(rows, {"quality_passed": c("quality") == 1, "clean_passed": c("toxic") == 0, "english": c("lang") == "en", "long_enough": c("n_chars") >= 500})


@R.query("""
SELECT count(*) AS total, count(*) FILTER (l_linenumber >= 3) AS qualified, count(*) FILTER (l_linenumber >= 4) AS high,
       count(*) FILTER (l_linenumber >= 4) * 100.0 / count(*) > 50 AS lenient FROM lineitem""")
def leniency_flag(spark: SparkSession, sf: str) -> DataFrame:
    n, score = F.count(F.lit(1)), F.col("l_linenumber")
    return table(spark, sf, "lineitem").agg(n.alias("total"), F.count_if(score >= 3).alias("qualified"), F.count_if(score >= 4).alias("high"), (percent(F.count_if(score >= 4), n) > 50).alias("lenient"))


@R.query("""
SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_type, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing,
       value >= 50 AS qualified FROM events WHERE value >= 30 ORDER BY value DESC, event_id LIMIT 100""")
def review_export(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").filter("value >= 30").orderBy(F.desc("value"), "event_id").limit(100)
    return rows.select("event_id", F.col("ts").cast("date").alias("day"), "user_id", "event_type", json_scalar("props", "$.k").alias("k"), json_scalar("props", "$.missing").alias("missing"), (F.col("value") >= 50).alias("qualified"))


@R.query("SELECT doc_id, length(text) AS text_chars FROM documents WHERE text IS NOT NULL AND length(text) > 1000 AND source IS NOT NULL")
def long_text_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").filter("text IS NOT NULL AND length(text) > 1000 AND source IS NOT NULL").select("doc_id", F.length("text").cast("bigint").alias("text_chars"))


@R.query("""
SELECT count(*) AS recent_rows, CASE WHEN count(*) = 0 THEN 'alert' ELSE 'ok' END AS status
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 3 AND DATE '2024-01-31'""")
def ingestion_health(spark: SparkSession, sf: str) -> DataFrame:
    return reports.health(table(spark, sf, "events"), "ts", AS_OF)


ALIASES = [("GERMANY", "DACH"), ("FRANCE", "France SAS"), ("NATION_3", "Nation Three"), ("NATION_7", "Nation Seven"), ("CHINA", "PRC")]
_CASE = "CASE n_name " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ALIASES) + " ELSE n_name END"


def _aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALIASES, "variant_name string, canonical_name string")


@R.query(f"SELECT n_nationkey, n_name, {_CASE} AS client FROM nation")
def normalized_view(spark: SparkSession, sf: str) -> DataFrame:
    return names.canonical(table(spark, sf, "nation"), "n_name", _aliases(spark), "client", exact=True).select("n_nationkey", "n_name", "client")


@R.query(f"SELECT {_CASE} AS client, count(*) AS meetings, round(avg(c_acctbal), 8) AS avg_balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def normalized_counts(spark: SparkSession, sf: str) -> DataFrame:
    nations = names.canonical(table(spark, sf, "nation"), "n_name", _aliases(spark), "client", exact=True)
    rows = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("client").agg(F.count(F.lit(1)).alias("meetings"), F.round(F.avg("c_acctbal"), 8).alias("avg_balance"))


@R.query(f"""
SELECT {_CASE} AS client, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F' AND o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 200""")
def qualified_by_client(spark: SparkSession, sf: str) -> DataFrame:
    nations = names.canonical(table(spark, sf, "nation"), "n_name", _aliases(spark), "client", exact=True)
    rows = table(spark, sf, "orders").filter("o_orderstatus = 'F' AND o_totalprice > 100000").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return reports.recent(rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("client", "o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 200)


@R.query("SELECT lower(trim(s_name)) AS variant_name, min(n_name) AS canonical_name, count(*) AS variants FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def mappings_list(spark: SparkSession, sf: str) -> DataFrame:
    """An alias table as it is looked up: variants by their key, the least canonical name of each."""
    pairs = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("variant_name"), F.col("n_name").alias("canonical_name"))
    return names.lookup(pairs).select(F.col("__variant").alias("variant_name"), F.col("__canonical").alias("canonical_name"), "variants")


@R.query("""
WITH w AS (SELECT event_type, CAST(ts AS DATE) - CAST(dayofweek(ts) AS INT) AS week, round(avg(value), 2) AS avg_score FROM events GROUP BY 1, 2)
SELECT event_type, week, avg_score, lag(avg_score) OVER o AS previous, round(avg_score - lag(avg_score) OVER o, 2) AS change
FROM w WINDOW o AS (PARTITION BY event_type ORDER BY week)""")
def weekly_trend_lag(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weekly_trend(table(spark, sf, "events"), "event_type", "ts", "value")


def _gap(column: str, target: float) -> str:
    return f"SELECT '{column}' AS criterion, round(avg({column}), 4) AS avg_score, min({column}) AS min_score, max({column}) AS max_score, round(count(*) FILTER ({column} < {target}) * 100.0 / count({column}), 2) AS pct_below FROM lineitem"


@R.query(" UNION ALL ".join(_gap(c, 0.05) for c in ("l_quantity", "l_discount", "l_tax")))
def skill_gap_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return reports.skill_gaps(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], 0.05)


@R.query("SELECT c_name AS client, c_acctbal AS score FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 3")
def top_performers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter("c_acctbal > 0").orderBy(F.desc("c_acctbal"), "c_custkey").limit(3).select(F.col("c_name").alias("client"), F.col("c_acctbal").alias("score"))


@R.query("""
SELECT event_type, round(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 3) AS avg_score, count(*) AS n
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 30 AND DATE '2024-01-31' GROUP BY 1 ORDER BY 2, 1""")
def coaching_priorities(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").filter(reports.since("ts", AS_OF, 30))
    return rows.groupBy("event_type").agg(F.round(F.avg(json_scalar("props", "$.k").cast("double")), 3).alias("avg_score"), F.count(F.lit(1)).alias("n")).orderBy("avg_score", "event_type")


@R.query("SELECT event_id, CAST(ts AS DATE) AS day, event_type, value, json_extract_string(props, '$.k') AS k FROM events WHERE user_id = 7 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-31' - 90 AND DATE '2024-01-31'")
def individual_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").filter(F.col("user_id") == 7).filter(reports.since("ts", AS_OF, 90))
    return rows.select("event_id", F.col("ts").cast("date").alias("day"), "event_type", "value", json_scalar("props", "$.k").alias("k"))


@R.query("""
SELECT conv_id, list_contains(roles, 'system') AS has_system, len(roles) > 1 AS is_dialogue, roles[1] AS first_role
FROM (SELECT conv_id, list(role ORDER BY turn) AS roles FROM conversations GROUP BY 1)""")
def array_predicates(spark: SparkSession, sf: str) -> DataFrame:
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda r: r["role"])
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(roles.alias("roles"))
    return rows.select("conv_id", F.array_contains("roles", "system").alias("has_system"), (F.size("roles") > 1).alias("is_dialogue"), F.get("roles", F.lit(0)).alias("first_role"))


_PRICES = "(VALUES " + ", ".join(f"('{m}', {k}, CAST({i} AS DOUBLE), CAST({o} AS DOUBLE))" for k, (m, (i, o)) in enumerate(costs.PRICES.items())) + ") AS p(prefix, ord, rate_in, rate_out)"
_MODELS = ["gpt-5-mini", "gpt-4o-2024-08-06", "gpt-5-mini-snapshot", "gpt-5-x", "unknown-model", "o1-mini", "gpt-4o-mini-2024"]
_MODEL_SQL = "CASE conv_id % 7 " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(_MODELS)) + " END"
_CALLS = f"(SELECT conv_id, turn, {_MODEL_SQL} AS model, length(text) AS tokens_in, length(role) AS tokens_out FROM conversations)"
_COSTED = f"""
SELECT c.*, p.prefix, round(tokens_in * rate_in / 1000 + tokens_out * rate_out / 1000, 9) AS cost
FROM {_CALLS} c LEFT JOIN (SELECT m.model, max_by(prefix, length(prefix)) AS prefix FROM (SELECT DISTINCT model FROM {_CALLS}) m JOIN {_PRICES} ON starts_with(m.model, prefix) GROUP BY 1) h ON c.model = h.model
LEFT JOIN {_PRICES} ON p.prefix = h.prefix"""


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    model = F.element_at(F.array(*[F.lit(m) for m in _MODELS]), (F.col("conv_id") % 7 + 1).cast("int"))
    return table(spark, sf, "conversations").select("conv_id", "turn", model.alias("model"), F.length("text").cast("bigint").alias("tokens_in"), F.length("role").cast("bigint").alias("tokens_out"))


def _costed(spark: SparkSession, sf: str) -> DataFrame:
    rated = costs.by_longest_prefix(_calls(spark, sf), costs.prices(spark))
    return rated.withColumn("cost", costs.cost(F.col("tokens_in"), F.col("tokens_out"), F.col("rate_in"), F.col("rate_out"), 9)).drop("rate_in", "rate_out")


@R.query(_COSTED)
def cost_estimate(spark: SparkSession, sf: str) -> DataFrame:
    return _costed(spark, sf)


@R.query(f"SELECT model, count(*) AS calls, CAST(sum(tokens_in) AS BIGINT) AS tokens_in, round(sum(cost), 8) AS cost FROM ({_COSTED}) GROUP BY 1")
def cost_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _costed(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.round(F.sum("cost"), 8).alias("cost"))


@R.query(f"SELECT prefix, model, count(*) AS calls, round(sum(cost), 8) AS cost FROM ({_COSTED}) GROUP BY GROUPING SETS ((prefix, model), (prefix), ())")
def cost_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    _costed(spark, sf).createOrReplaceTempView("costed_calls")
    return spark.sql("SELECT prefix, model, count(*) AS calls, round(sum(cost), 8) AS cost FROM costed_calls GROUP BY GROUPING SETS ((prefix, model), (prefix), ())")


@R.query(f"SELECT model, min_by(prefix, ord + CASE WHEN prefix = model THEN -100 ELSE 0 END) AS config FROM (SELECT DISTINCT model FROM {_CALLS}) LEFT JOIN {_PRICES} ON starts_with(model, prefix) GROUP BY 1")
def model_config_first_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return costs.by_first_prefix(_calls(spark, sf), costs.prices(spark))


@R.query("""
SELECT model, count(*) AS runs, count(score) AS succeeded, round(count(score) * 100.0 / count(*), 2) AS success_rate, round(avg(score), 3) AS avg_score, count(*) FILTER (score >= 3) AS qualified
FROM (SELECT m.model, CASE WHEN (doc_id + m.k) % 5 = 0 THEN NULL ELSE (doc_id * (m.k + 1)) % 6 END AS score FROM documents CROSS JOIN (VALUES ('a', 0), ('b', 1), ('c', 2)) AS m(model, k)) GROUP BY 1""")
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for k, m in enumerate("abc")])
    runs = table(spark, sf, "documents").select("doc_id", F.explode(models).alias("m")).select("doc_id", "m.*")
    return reports.compare_models(runs.withColumn("score", F.when((F.col("doc_id") + F.col("k")) % 5 != 0, (F.col("doc_id") * (F.col("k") + 1)) % 6)))


@R.query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")


@R.query("""
SELECT count(*) AS meetings, count(*) FILTER (l_linenumber = 5) AS perfect, count(*) FILTER (l_linenumber >= 4) AS high,
       round(avg(l_linenumber), 2) AS average, count(DISTINCT l_suppkey) AS clients FROM lineitem""")
def executive_summary(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("l_linenumber")
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("meetings"), F.count_if(score == 5).alias("perfect"), F.count_if(score >= 4).alias("high"), F.round(F.avg(score), 2).alias("average"), F.count_distinct("l_suppkey").alias("clients"))


@R.query("""
SELECT row_number() OVER (ORDER BY score DESC, o_custkey) AS rank, o_custkey, score
FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS score FROM orders GROUP BY 1) ORDER BY score DESC, o_custkey LIMIT 20""")
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    scores = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("score"))
    top = reports.recent(scores, [F.desc("score"), F.asc("o_custkey")], 20)  # ranks only the rows that are shown
    return top.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "o_custkey", "score"))).alias("rows")).select(F.posexplode("rows").alias("pos", "r")).select((F.col("pos") + 1).cast("bigint").alias("rank"), "r.o_custkey", "r.score")


@R.query("""
SELECT doc_id, text_chars, kind, label FROM (
SELECT d.doc_id, length(text) AS text_chars, source AS kind, l.quality AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
JOIN (SELECT DISTINCT conv_id FROM conversations) c ON d.doc_id = c.conv_id)""")
def results_left_sales(spark: SparkSession, sf: str) -> DataFrame:
    docs, calls = table(spark, sf, "documents"), table(spark, sf, "conversations").select("conv_id").distinct()
    got = docs.join(calls, F.col("doc_id") == F.col("conv_id")).join(table(spark, sf, "labels").select(F.col("doc_id").alias("labelled"), "quality"), F.col("doc_id") == F.col("labelled"), "left")
    return got.select("doc_id", F.length("text").cast("bigint").alias("text_chars"), F.col("source").alias("kind"), F.col("quality").alias("label"))
