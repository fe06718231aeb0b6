"""Reports over a fact table; each is one scan, with dates relative to a given day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions.columns import percent, week_start


def recent(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows by a total order: a top-k, never a full sort."""
    return df.orderBy(*order).limit(n)


def since(column: str, as_of: str, days: int) -> Column:
    """Dates from `days` before as_of on, to as_of."""
    return F.col(column).cast("date").between(F.date_sub(F.lit(as_of).cast("date"), days), F.lit(as_of).cast("date"))


def distribution(df: DataFrame, by: str) -> DataFrame:
    """Rows and percent of all by value. The total sums the values' counts and is one row, broadcast, so no task gathers all values."""
    grouped = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = grouped.agg(F.sum("n").alias("__total"))
    return grouped.join(F.broadcast(total)).withColumn("pct", F.round(F.col("n") * F.lit(100.0) / F.col("__total"), 2)).drop("__total")


def pass_rates(df: DataFrame, criteria: dict[str, Column]) -> DataFrame:
    """How many rows pass each criterion, of how many."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in criteria.items()])


def summary(df: DataFrame, keys: list[str], score: str, qualified: Column, least: int = 1, digits: int = 1) -> DataFrame:
    """By person: meetings, mean score, rate, best and worst; people with at least `least` meetings."""
    n = F.count(F.lit(1))
    got = df.groupBy(*keys).agg(n.alias("meetings"), F.round(F.avg(score), digits).alias("avg_score"), F.round(percent(F.count_if(qualified), n), 1).alias("rate"), F.max(score).alias("best"), F.min(score).alias("worst"))
    return got.filter(F.col("meetings") >= least)


def weekly_trend(df: DataFrame, key: str, day: str, score: str) -> DataFrame:
    """Mean score by key and week (from Sunday), the week before, and the change."""
    weeks = df.groupBy(key, week_start(F.col(day)).alias("week")).agg(F.round(F.avg(score), 2).alias("avg_score"))
    before = F.lag("avg_score").over(Window.partitionBy(key).orderBy("week"))
    return weeks.withColumn("previous", before).withColumn("change", F.round(F.col("avg_score") - F.col("previous"), 2))


def skill_gaps(df: DataFrame, criteria: list[str], target: float) -> DataFrame:
    """Mean, least, most and percent below target of each criterion: one scan, unpivoted, one aggregate."""
    long = df.select(F.expr(f"stack({len(criteria)}, {', '.join(f'{c!r}, CAST({c} AS DOUBLE)' for c in criteria)}) AS (criterion, score)"))
    return long.groupBy("criterion").agg(F.round(F.avg("score"), 4).alias("avg_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.round(percent(F.count_if(F.col("score") < target), F.count("score")), 2).alias("pct_below"))


def health(df: DataFrame, day: str, as_of: str, days: int = 3) -> DataFrame:
    """One row: how many rows the last days brought, and ok or alert."""
    n = df.filter(since(day, as_of, days)).agg(F.count(F.lit(1)).alias("recent_rows"))
    return n.withColumn("status", F.when(F.col("recent_rows") == 0, "alert").otherwise("ok"))


def label_counts(df: DataFrame, labels: str, known: DataFrame) -> DataFrame:
    """How often each known label occurs in an array column, those that never do with 0."""
    counted = df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return known.join(counted, "label", "left").select("label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def compare_models(results: DataFrame) -> DataFrame:
    """By model: runs, successes and their rate, mean score of successes, qualified."""
    n, good = F.count(F.lit(1)), F.count("score")
    return results.groupBy("model").agg(n.alias("runs"), good.alias("succeeded"), F.round(percent(good, n), 2).alias("success_rate"), F.round(F.avg("score"), 3).alias("avg_score"), F.count_if(F.col("score") >= 3).alias("qualified"))
