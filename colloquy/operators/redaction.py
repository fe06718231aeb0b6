"""Redaction of sensitive spans: one pass, the bounded loop, and the check for residue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.columns import literal_pattern


def scrub(text: Column, span: Column, placeholder: Column) -> Column:
    """text without the span: every exact place whatever the case, else its words with anything between them."""
    words = F.array_join(F.transform(F.filter(F.split(span, r"(?U)\W+"), lambda w: w != ""), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "\\W+")
    exact = literal_pattern(span)
    some = F.coalesce(F.trim(span) != "", F.lit(False))
    loose = F.when(F.regexp_replace(span, r"(?U)\W+", "") != "", F.regexp_replace(text, F.concat(F.lit("(?iuU)"), words), placeholder)).otherwise(text)
    return F.when(~some, text).when(F.contains(F.lower(text), F.lower(span)), F.regexp_replace(text, exact, placeholder)).otherwise(loose)


def scrub_all(text: Column, flags: Column) -> Column:
    """text without the spans of all flags (category, span), in order."""
    return F.aggregate(flags, text, lambda out, f: scrub(out, f["span"], F.concat(F.lit("[REDACTED:"), f["category"], F.lit("]"))))


def dictionary_detector(terms: dict[str, tuple[str, ...]], confidence: float = 0.95) -> Callable[[Column], Column]:
    """A stand-in for a model: flags (category, span, confidence) for known terms that stand in a text."""

    def detect(text: Column) -> Column:
        found = [F.when(F.lower(text).contains(t), F.struct(F.lit(c).alias("category"), F.lit(t).alias("span"), F.lit(confidence).alias("confidence"))) for c, ts in terms.items() for t in ts]
        return F.array_compact(F.array(*found))

    return detect


def residue(text: Column, spans: Column) -> Column:
    """Whether one of the spans still stands in the text."""
    return F.exists(spans, lambda s: F.coalesce(F.lower(text).contains(F.lower(s)), F.lit(False)))


def redact(df: DataFrame, text: str, detect: Callable[[Column], Column], *, mode: str = "redact", rounds: int = 5, floor: float = 0.7, on_failure: str = "drop", without: Callable[[Column, Column], Column] = scrub_all) -> DataFrame:
    """df with `text` redacted (by `without`, which takes the flags' spans out), `status` and `rounds`; detection and scrubbing repeat until no flag reaches the floor.

    Rows that still have one after `rounds` are dropped, or keep their text with status redact_fallback. The
    rounds are unrolled into one plan, so a row meets no driver loop.
    """
    if mode == "flag":
        return df.withColumns({"status": F.lit("flag"), "rounds": F.lit(0)})
    unsure = lambda s: F.exists(s["flags"], lambda f: f["confidence"] >= floor)
    made = lambda t, n: F.struct(t.alias("text"), n.alias("rounds"), detect(t).alias("flags"))

    def once_more(s: Column) -> Column:
        # a text that holds no sure flag is clean, and is left as it is
        scrubbed = _let(without(s["text"], s["flags"]), lambda t: made(t, s["rounds"] + 1))
        return F.when(unsure(s), scrubbed).otherwise(s)

    state = made(F.col(text), F.lit(0))
    for _ in range(rounds):
        state = _let(state, once_more)
    # a generator rather than a filter, which would be pushed down and work the rounds out once more
    kept = F.array(state) if on_failure == "fallback" else F.filter(F.array(state), lambda s: ~F.coalesce(unsure(s), F.lit(False)))
    done = df.withColumn("__state", F.explode(kept))
    dirty = F.coalesce(unsure(F.col("__state")), F.lit(False))
    status = F.when(dirty, "redact_fallback").otherwise("redacted")
    return done.withColumns({"status": status, "rounds": F.col("__state.rounds"), text: F.when(dirty, F.col(text)).otherwise(F.col("__state.text"))}).drop("__state")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
