"""Latest-wins dedup, duplicate counts, uniqueness and claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: list[str], order: list[str] | list[Column]) -> DataFrame:
    """The latest row of each key, by columns that together are unique in it: an aggregate that combines before its
    shuffle, so a key of very many rows is no single task's sort.

    For other orders give Columns (the first row is kept); they are ranked in a window, which sorts all rows of a key
    in one task.
    """
    if all(isinstance(c, str) for c in order):
        last = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__last"))
        return last.select(*[F.col("__last").getField(c).alias(c) for c in df.columns])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; null keys count as rows, not as keys."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_keys"), (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"))


def violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that a unique index would refuse."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def first_claims(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row, and whether it is the first to claim its key, by columns that tell all rows of a key apart.

    The firsts are found by an aggregate that combines before its shuffle, so a key that very many rows
    claim is no single task's sort; Spark can split the join."""
    firsts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("__first"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(firsts, same).select(*df.columns, F.struct(*order).eqNullSafe(F.col("__first")).alias("claimed"))


def unclaimed(df: DataFrame, claims: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key no earlier claim blocks; failed claims don't block."""
    blocking = claims.filter(F.col("status").isin("pending", "processing", "completed"))
    return df.join(blocking.select(*keys).distinct(), keys, "left_anti")
