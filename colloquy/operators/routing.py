"""Routing by metadata, guards of keys, and updates of metadata maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOMAINS = ("client", "talent")


def source_of(metadata: Column) -> Column:
    return F.lower(F.trim(metadata))


def route(df: DataFrame, column: str, domains: tuple[str, ...] = DOMAINS) -> DataFrame:
    """df with `route` (one of the domains or null) and `reject`: why there is none. Both errors are permanent."""
    source = source_of(F.col(column))
    known = source.isin(*domains)
    why = F.when(F.coalesce(source, F.lit("")) == "", "missing source").when(~known, "unknown source")
    return df.withColumns({"route": F.when(known, source), "reject": why})


def poison_key(identity: Column, stem: Column, note_id: Column) -> Column:
    """Ids that are empty, or only a temporary file's stem without a note id of their own."""
    return F.coalesce(F.trim(identity) == "", F.lit(True)) | (note_id.isNull() & F.coalesce(identity == stem, F.lit(False)))


def without_source(metadata: Column) -> Column:
    return F.trim(F.lower(F.coalesce(F.try_element_at(metadata, F.lit("source")), F.lit("")))) == ""


def with_entry(metadata: Column, key: str, value: Column) -> Column:
    """The map with one entry set and the others kept."""
    kept = F.map_filter(F.coalesce(metadata, F.create_map().cast("map<string,string>")), lambda k, _: k != key)
    return F.map_concat(kept, F.create_map(F.lit(key), value))


def cache_key(day: Column, meeting: Column, model: Column, source: Column, variant: Column | None = None) -> Column:
    parts = [meeting, model, source, *([variant] if variant is not None else [])]
    return F.concat(F.lit("cache/"), F.date_format(day, "yyyy-MM-dd"), F.lit("/"), F.concat_ws("-", *parts), F.lit(".json"))
