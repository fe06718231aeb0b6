"""Very many spans at once: found in one pass over each text, whatever their number.

The spans are one automaton (Aho-Corasick) for each PIECE of them, built once a worker from a broadcast list of bounded
size. A text runs through each piece once and gathers what it finds; then, of all matches, the leftmost is taken, of
several there the longest, and the search goes on behind it. So the work is the text's length times the number of
pieces, not of spans, and nothing of a text is held but its matches.

* Case doesn't matter. Characters whose lower case is several are compared as they are.
* Spans of white space alone and null spans are none; of spans alike but for case the least category counts.
* Null texts stay null. Only the named columns are rewritten; others go along, whatever their names.
* An empty table of spans changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spans of one automaton.
PIECE = 100_000
FOUND = "__found_"
MATCHES = "array<struct<start:int,end:int,category:string>>"


def lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def best(matches: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Leftmost matches, the longest of those that begin together, none into another."""
    out, end = [], 0
    for start, stop, category in sorted(matches, key=lambda m: (m[0], -m[1], m[2])):
        if start >= end:
            out.append((start, stop, category))
            end = stop
    return out


def _pieces(spans: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The spans in lists of PIECE at most, each once; one list is on the driver at a time."""
    low = spans.select(F.col("span"), "category").filter("trim(span) != ''")
    known = low.groupBy(F.lower("span").alias("low")).agg(F.min(F.struct("category", "span")).alias("s")).select("s.span", "s.category")
    n = known.count()
    parts = max(1, -(-n // PIECE)) if n else 0
    numbered = known.withColumn("part", F.pmod(F.xxhash64("span"), F.lit(max(parts, 1))))
    for k in range(parts):
        yield [(lower(r.span), r.category) for r in numbered.filter(F.col("part") == k).collect()]


@lru_cache(2)
def _automaton(number: int, shared):
    import ahocorasick

    made = ahocorasick.Automaton()
    for span, category in shared.value:
        made.add_word(span, (len(span), category))
    made.make_automaton()
    return made


def found(df: DataFrame, columns: list[str], spans: DataFrame) -> DataFrame:
    """df with an array of matches (start, end, category) for each of the columns, named FOUND + column: all that stand
    there, overlapping ones too."""
    out = df.withColumns({FOUND + c: F.when(F.col(c).isNotNull(), F.array().cast(MATCHES)) for c in columns})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    names = out.columns
    for number, piece in enumerate(_pieces(spans)):
        shared = df.sparkSession.sparkContext.broadcast(piece)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(number, shared)
            for batch in batches:
                made = {n: batch.column(k) for k, n in enumerate(names)}
                for c in columns:
                    here = []
                    for text, before in zip(made[c].to_pylist(), made[FOUND + c].to_pylist()):
                        hits = [] if text is None else [{"start": end + 1 - n, "end": end + 1, "category": category} for end, (n, category) in automaton.iter(lower(text))]
                        here.append(None if text is None else before + hits)
                    made[FOUND + c] = pa.array(here, batch.schema.field(FOUND + c).type)
                yield pa.RecordBatch.from_arrays([made[n] for n in names], names)

        out = out.mapInArrow(run, schema)
    return out


def scrub(df: DataFrame, columns: list[str], spans: DataFrame) -> DataFrame:
    """df with every span in the columns replaced by [REDACTED:category], leftmost and longest first."""

    names = df.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            for c in columns:
                texts = []
                for text, hits in zip(made[c].to_pylist(), made[FOUND + c].to_pylist()):
                    parts, at = [], 0
                    for start, end, category in best([(h["start"], h["end"], h["category"]) for h in hits or []]):
                        parts += [text[at:start], f"[REDACTED:{category}]"]
                        at = end
                    texts.append(None if text is None else "".join([*parts, text[at:]]))
                made[c] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([made[n] for n in names], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return found(df, columns, spans).mapInArrow(rewrite, schema)


def residue(df: DataFrame, columns: list[str], spans: DataFrame) -> DataFrame:
    """df with `residue`: whether a span still stands in one of the columns."""
    some = F.lit(False)
    for c in columns:
        some = some | F.coalesce(F.size(FOUND + c) > 0, F.lit(False))
    return found(df, columns, spans).withColumn("residue", some).drop(*[FOUND + c for c in columns])
