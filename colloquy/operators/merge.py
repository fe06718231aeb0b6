"""MERGE on plain tables, with a policy for each column, and the other changes of rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy import schemas


def merge(target: DataFrame, source: DataFrame, key: str, *, set_: Iterable[str] = (), coalesce: Iterable[str] = (), insert_only: Iterable[str] = ()) -> DataFrame:
    """target after source is merged into it, with `_op` (insert, update or keep).

    `set_` columns take the source's value, null too; `coalesce` ones keep the target's where the source is
    null; `insert_only` ones are set on insert alone; all others keep their value and are null on insert.
    A matched key that occurs twice in source is an error, as in a warehouse; unmatched ones are all inserted.
    Null keys match nothing.
    """
    set_, coalesce, insert_only = set(set_), set(coalesce), set(insert_only)
    # null keys match nothing, and would all meet in one task of the join
    t = target.filter(F.col(key).isNotNull()).withColumn("__in_target", F.lit(True))
    given = [c for c in source.columns if c != key]
    s = source.filter(F.col(key).isNotNull()).select(F.col(key).alias("__key"), *[F.col(c).alias(f"__s_{c}") for c in given], F.lit(True).alias("__in_source"))
    times = s.groupBy(F.col("__key").alias("__counted")).agg(F.count(F.lit(1)).alias("__times")).filter("__times > 1")
    s = s.join(times, F.col("__key") == F.col("__counted"), "left").drop("__counted")
    both = t.join(s, t[key] == s["__key"], "full_outer")
    matched = F.col("__in_target").isNotNull() & F.col("__in_source").isNotNull()
    came = F.col("__in_source").isNotNull()

    def column(c: str) -> Column:
        if c == key:
            return F.coalesce(t[key], "__key").alias(c)
        new = F.col(f"__s_{c}") if c in given else F.lit(None).cast(target.schema[c].dataType)
        if c in set_:
            return F.when(came, new).otherwise(t[c]).alias(c)
        if c in coalesce:
            return F.coalesce(new, t[c]).alias(c)
        if c in insert_only:
            return F.when(F.col("__in_target").isNotNull(), t[c]).otherwise(new).alias(c)
        return t[c]

    twice = F.raise_error(F.lit("MERGE: a target row matches several source rows")).cast("string")
    op = F.when(matched & (F.col("__times") > 1), twice).when(matched, "update").when(came, "insert").otherwise("keep")
    merged = both.select(*[column(c) for c in target.columns], op.alias("_op"))
    written = {key, *set_, *coalesce, *insert_only} & {key, *given}
    inserted = source.filter(F.col(key).isNull()).select(*[(F.col(c) if c in written else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in target.columns], F.lit("insert").alias("_op"))
    kept = target.filter(F.col(key).isNull()).withColumn("_op", F.lit("keep"))
    return merged.unionByName(kept).unionByName(inserted)


def merge_client(target: DataFrame, source: DataFrame) -> DataFrame:
    """The client domain's upsert: talent columns stay, the three texts aren't overwritten by null."""
    return merge(target, source.withColumn("scoring_domain", F.lit("client")), "meeting_id", set_=schemas.SHARED + schemas.CLIENT_ONLY, coalesce=schemas.TEXTS)


def merge_talent(target: DataFrame, source: DataFrame) -> DataFrame:
    """The talent domain's upsert: client columns stay."""
    return merge(target, source.withColumn("scoring_domain", F.lit("talent")), "meeting_id", set_=schemas.SHARED + schemas.TALENT_ONLY, coalesce=schemas.TEXTS)


def merge_by_domain(target: DataFrame, source: DataFrame, domain: str) -> DataFrame:
    if domain not in ("client", "talent"):
        raise ValueError(f"unknown scoring domain: {domain!r}")
    return (merge_client if domain == "client" else merge_talent)(target, source)


def upsert_mapping(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Alias rows: a known variant keeps its created_at."""
    stamped = source.withColumns({"created_at": now, "updated_at": now})
    return merge(target, stamped, "variant_name", set_=("canonical_name", "notes", "updated_at"), insert_only=("created_at",))


def delete(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition isn't true; null doesn't delete."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def backfill(target: DataFrame, column: str, value: Column) -> DataFrame:
    return target.withColumn(column, F.coalesce(column, value))


def stats(merged: DataFrame) -> DataFrame:
    """How many rows a merge inserted and updated."""
    count = lambda op: F.count_if(F.col("_op") == op)
    return merged.agg(count("insert").alias("inserted"), count("update").alias("updated"), (count("insert") + count("update")).alias("affected"))


def evolve(table: DataFrame, other: DataFrame) -> DataFrame:
    """Union by name; columns that either lacks are added as null."""
    return table.unionByName(other, allowMissingColumns=True)


def missing_columns(have: DataFrame, want) -> list[str]:
    """Names in the schema `want` that the table lacks, in its order."""
    known = {c.lower() for c in have.columns}
    return [f.name for f in want.fields if f.name.lower() not in known]


def add_columns(table: DataFrame, want) -> DataFrame:
    return table.withColumns({c: F.lit(None).cast(want[c].dataType) for c in missing_columns(table, want)})


def relax(schema, names: Iterable[str]):
    """The schema with the named columns nullable; also the names changed, already nullable, and missing."""
    from pyspark.sql.types import StructField, StructType

    names = set(names)
    fields = [StructField(f.name, f.dataType, f.nullable or f.name in names, f.metadata) for f in schema.fields]
    changed = [f.name for f in schema.fields if f.name in names and not f.nullable]
    already = [f.name for f in schema.fields if f.name in names and f.nullable]
    return StructType(fields), changed, already, sorted(names - set(schema.names))
