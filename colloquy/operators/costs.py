"""Prices of model calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.names import mapping_side

# USD per 1000 tokens (in, out).
PRICES = {
    "gpt-5": (0.00125, 0.01000),
    "gpt-5-mini": (0.00025, 0.00200),
    "gpt-5-nano": (0.00005, 0.00040),
    "gpt-5-pro": (0.01500, 0.12000),
    "gpt-5-chat-latest": (0.00025, 0.00200),
    "gpt-4o": (0.00250, 0.01000),
    "gpt-4o-mini": (0.00015, 0.00060),
    "o1-preview": (0.01500, 0.06000),
    "o1-mini": (0.00300, 0.01200),
}


def prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, k, i, o) for k, (m, (i, o)) in enumerate(PRICES.items())], "prefix string, ord int, rate_in double, rate_out double")


def _matching(models: DataFrame, table: DataFrame, choice: Column) -> DataFrame:
    """Models that begin with a prefix of the table, with the chosen one: each name is cut to every length that prefixes
    have, and the cuts are joined by equality."""
    lengths = sorted(r[0] for r in table.select(F.length("prefix").alias("n")).filter("n IS NOT NULL").distinct().collect())
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("model"))
    cuts = models.select("model", F.explode(F.transform(fitting, lambda n: F.left("model", n))).alias("prefix"))
    return cuts.join(table, "prefix").groupBy("model").agg(choice.alias("hit"))


def by_longest_prefix(calls: DataFrame, table: DataFrame) -> DataFrame:
    """calls with the rates of the longest prefix of their model (an exact name is the longest); null if none.

    The prefix join runs over the distinct models only."""
    # the list of distinct models is broadcast only if it is short
    hits = _matching(calls.select("model").distinct(), table, F.max_by(F.struct("prefix", "rate_in", "rate_out"), F.length("prefix")))
    return calls.join(mapping_side(hits), "model", "left").select(*calls.columns, "hit.prefix", "hit.rate_in", "hit.rate_out")


def by_first_prefix(models: DataFrame, table: DataFrame) -> DataFrame:
    """For each model its own entry, else the first of the table's order that it begins with."""
    rank = F.struct((F.col("prefix") != F.col("model")).alias("inexact"), "ord")
    known = models.select("model").distinct()
    return known.join(_matching(known, table, F.min_by("prefix", rank)), "model", "left").select("model", F.col("hit").alias("config"))


def cost(tokens_in: Column, tokens_out: Column, rate_in: Column, rate_out: Column, digits: int = 6) -> Column:
    return F.round(tokens_in * rate_in / 1000 + tokens_out * rate_out / 1000, digits)


def tokens(input_: Column, output: Column, prompt: Column, completion: Column) -> Column:
    """Token counts of either response shape, if both of its fields are there; else (0, 0)."""
    pair = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("tokens_in"), b.alias("tokens_out")))
    zero = F.struct(F.lit(0).cast("bigint").alias("tokens_in"), F.lit(0).cast("bigint").alias("tokens_out"))
    return F.coalesce(pair(input_, output), pair(prompt, completion), zero)
