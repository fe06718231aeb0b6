"""Deterministic scoring: totals, bands, coaching, plausibility and invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions.columns import bands, first_k

# Bands of the total of eight scores from 0 to 3, and what is said of them.
RATINGS = [(20, "Excellent"), (16, "Good"), (12, "Developing")]
RATING_REST = "Needs Improvement"
COACHING = [
    (20, "Excellent meeting performance. Focus on maintaining consistency and mentoring others."),
    (16, "Good meeting performance. A few areas to refine for excellence."),
    (12, "Developing skills. Focus on the improvement areas below for your next meeting."),
]
COACHING_REST = "Significant coaching opportunity. Review the fundamentals and consider shadowing a senior colleague."
CRITERIA = ("Introduction", "Discovery", "Scoping", "Solution", "Commercial", "Case Studies", "Next Steps", "Strategic Context")


def total(scores: Column) -> Column:
    return F.aggregate(scores, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def total_qualified(scores: Column, least: int = 2) -> Column:
    return F.size(F.filter(scores, lambda x: x >= least))


def sections_qualified(sections: list[Column], threshold: int = 3) -> tuple[Column, Column]:
    """How many sections qualify, and whether that is enough."""
    n = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(False)).cast("int") for s in sections])
    return n, n >= threshold


def rating(score: Column) -> Column:
    return bands(score, RATINGS, RATING_REST)


def coaching(score: Column) -> Column:
    return bands(score, COACHING, COACHING_REST)


def strengths(scores: Column, names: tuple[str, ...] = CRITERIA, k: int = 3) -> Column:
    """The first k criteria with the full score, in order of criteria."""
    return _named(scores, names, lambda s: s == 3, k)


def improvements(scores: Column, names: tuple[str, ...] = CRITERIA, k: int = 3) -> Column:
    """The first k criteria with 0 or 1, in order of criteria."""
    return _named(scores, names, lambda s: s <= 1, k)


def _named(scores: Column, names: tuple[str, ...], keep, k: int) -> Column:
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("name"), scores.alias("score"))
    return first_k(F.transform(F.filter(pairs, lambda p: keep(p["score"])), lambda p: p["name"]), k)


def plausible(period: Column, amounts: list[Column], bounds: dict[str, tuple[float, float]]) -> Column:
    """Whether all amounts lie in the period's band; null without an amount or a band."""
    band = reduce(lambda out, b: F.when(period == b[0], F.struct(F.lit(b[1][0]).alias("lo"), F.lit(b[1][1]).alias("hi"))).otherwise(out), bounds.items(), F.lit(None).cast("struct<lo:double,hi:double>"))
    given = F.filter(F.array(*amounts), lambda a: a.isNotNull())
    return F.when((F.size(given) > 0) & band.isNotNull(), F.forall(given, lambda a: a.between(band["lo"], band["hi"])))


def clear_unless(condition: Column, columns: list[str]) -> dict[str, Column]:
    """Columns nulled where the condition isn't met (null counts as met)."""
    return {c: F.when(F.coalesce(condition, F.lit(True)), F.col(c)) for c in columns}


def outcome(cached: Column, claimed: Column, error: Column, transient: Column) -> Column:
    """cached, duplicate, completed, transient or permanent, of one attempt."""
    return F.when(cached, "cached").when(~claimed, "duplicate").when(error.isNull(), "completed").when(transient, "transient").otherwise("permanent")


def is_transient(kind: Column, status: Column) -> Column:
    """Errors worth another try: of connection or time, and statuses 429 and 5xx."""
    return kind.isin("timeout", "connection") | F.coalesce((status == 429) | status.between(500, 599), F.lit(False))
