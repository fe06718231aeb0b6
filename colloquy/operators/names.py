"""Canonical names, services and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What services are called.
FIT_ALIASES = {"talent": "Access", "access": "Access", "evolve": "Transform", "transform": "Transform", "ventures": "Ventures", "venture": "Ventures"}

#: Alias tables up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def mapping_side(mappings: DataFrame, rows: int | None = None) -> DataFrame:
    """An alias table for a join: broadcast if its size is known to be small."""
    rows = mappings.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(mappings) if rows <= BROADCAST_ROWS else mappings


def _key(exact: bool):
    return (lambda c: F.col(c)) if exact else (lambda c: F.lower(F.trim(c)))


def lookup(mappings: DataFrame, *, exact: bool = False) -> DataFrame:
    """An alias table by key: __variant, __canonical (of several the least), and how many variants have the key."""
    rows = mappings.select(_key(exact)("variant_name").alias("__variant"), F.col("canonical_name").alias("__canonical"))
    return rows.groupBy("__variant").agg(F.min("__canonical").alias("__canonical"), F.count(F.lit(1)).alias("variants"))


def canonical(df: DataFrame, column: str, mappings: DataFrame, out: str, *, exact: bool = False) -> DataFrame:
    """df with `out`: the canonical name of `column`, or the name itself where no alias is known.

    Keys are compared trimmed and in lower case, or as they are (`exact`)."""
    key = _key(exact)
    side = lookup(mappings, exact=exact).drop("variants")
    return df.join(mapping_side(side), key(column) == F.col("__variant"), "left").withColumn(out, F.coalesce("__canonical", column)).drop("__variant", "__canonical")


def services(names: Column) -> Column:
    """Known services under their present names, each once, in order."""
    alias = F.create_map(*[F.lit(x) for pair in FIT_ALIASES.items() for x in pair])
    return F.array_distinct(F.filter(F.transform(names, lambda n: F.try_element_at(alias, F.lower(F.trim(n)))), lambda n: n.isNotNull()))


def in_vocabulary(labels: Column, vocabulary: list[str], k: int = 5) -> Column:
    """Labels of the vocabulary, in order, the first k; repeats stay."""
    return F.slice(F.filter(labels, lambda x: x.isin(vocabulary)), 1, k)


def labels(services_: Column, fit_labels: Column) -> Column:
    return F.when(F.size(services_) > 0, services_).otherwise(fit_labels)
