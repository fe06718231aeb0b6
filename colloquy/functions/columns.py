"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it, and for no element of an array anew."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def scalar(got: Column) -> Column:
    """What was found in JSON if it is a scalar, else null."""
    return F.when(~F.coalesce(F.substring(F.ltrim(got), 1, 1).isin("[", "{"), F.lit(False)), got)


def json_scalar(json: Column | str, path: str) -> Column:
    """A scalar at a JSON path; null for objects, arrays and JSON null."""
    return scalar(F.get_json_object(json, path))


def json_array(json: Column | str, path: str) -> Column:
    """An array of strings at a JSON path; empty for anything else."""
    return F.coalesce(F.from_json(F.get_json_object(json, path), "array<string>"), F.array().cast("array<string>"))


def week_start(day: Column) -> Column:
    """The Sunday on or before a date."""
    return F.date_sub(day.cast("date"), F.dayofweek(day) - 1)


def safe_int(text: Column) -> Column:
    """Whole numbers as bigint, all else null."""
    return F.when(F.trim(text).rlike(r"^[+-]?\d{1,18}$"), F.trim(text).cast("bigint"))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text with an offset as `...Z`, to the second; null if it is none."""
    return F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_date(text: Column, default: Column | None = None) -> Column:
    """The calendar date a timestamp text begins with (its own offset's day), else `default`."""
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    return day if default is None else F.coalesce(day, default)


def clamp_score(value: Column, most: int = 3) -> Column:
    """Numbers cut to whole ones from 0 to `most`; what is no number is 0."""
    return F.least(F.lit(most), F.greatest(F.lit(0), F.coalesce(value.cast("int"), F.lit(0))))


def first_words(text: Column, n: int = 25) -> Column:
    """The first n words, joined by one space; null if there is none. What follows them isn't looked at."""
    cut = F.regexp_extract(text, rf"^\s*+((?:\S++\s++){{0,{n - 1}}}\S++)", 1)
    return F.nullif(F.regexp_replace(cut, r"\s+", " "), F.lit(""))


def first_k(array: Column, k: int) -> Column:
    return F.slice(array, 1, k)


def joined(array: Column) -> Column:
    """An array as one CSV field."""
    return F.concat_ws("; ", array)


def ellipsis(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def file_safe(name: Column, n: int = 100) -> Column:
    return F.substring(F.translate(name, "/\\", "__"), 1, n)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part * F.lit(100.0) / whole)


def bands(value: Column, steps: list[tuple[float, str]], rest: str) -> Column:
    """The label of the first step that value reaches."""
    return reduce(lambda out, step: F.when(value >= step[0], step[1]).otherwise(out), reversed(steps), F.lit(rest))


def first_class(text: Column, classes: list[tuple[str, tuple[str, ...]]]) -> Column:
    """The first class one of whose words the text contains, in lower case; else null."""
    low = F.lower(text)
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [low.contains(w) for w in words]), name) for name, words in classes])


def literal_pattern(text: Column) -> Column:
    """A regular expression that matches `text` itself, whatever the case."""
    return F.concat(F.lit("(?iu)\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
