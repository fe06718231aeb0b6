"""Many spans in one pass, against the loop over spans."""

import re
import time

import numpy as np
import pytest

from colloquy.operators import spans

RNG = np.random.default_rng(11)
SCHEMA = "k int, a string, b string, residue_ string"


def loop(text, known):
    """The leftmost, longest span at a time, by trying all."""
    if text is None:
        return None
    out, at, low = [], 0, spans.lower(text)
    while at < len(text):
        here = sorted(((-len(s), c) for s, c in known if s and low.startswith(spans.lower(s), at)))
        if here:
            out.append(f"[REDACTED:{here[0][1]}]")
            at += -here[0][0]
        else:
            out.append(text[at])
            at += 1
    return "".join(out)


@pytest.mark.parametrize("piece", [100_000, 2])
def test_equals_the_loop(spark, monkeypatch, piece):
    monkeypatch.setattr(spans, "PIECE", piece)
    known = [("Ab", "x"), ("abc", "y"), ("bcd", "z"), ("cd", "x"), ("D", "w"), (" e", "v"), ("ÜBER", "u"), ("a.c", "t"), ("[", "s"), ("\\", "r")]
    alphabet = [*"abcdABCD e.[\\", "über", "Über", "İ", "ß", "\n", "日本"]
    texts = ["".join(RNG.choice(alphabet, RNG.integers(0, 30))) for _ in range(200)]
    rows = [(k, t, texts[-k], "x") for k, t in enumerate(texts)] + [(900, None, "", "x"), (901, "", None, "x")]
    table = spark.createDataFrame([*known, (" ", "no"), (None, "no"), ("AB", "y")], "span string, category string")
    got = {r.k: r for r in spans.scrub(spark.createDataFrame(rows, SCHEMA), ["a", "b"], table).collect()}
    assert got[0].__fields__ == ["k", "a", "b", "residue_"]
    assert all((got[k].a, got[k].b) == (loop(a, known), loop(b, known)) for k, a, b, _ in rows)
    left = {r.k: r.residue for r in spans.residue(spark.createDataFrame(rows, SCHEMA), ["a", "b"], table).collect()}
    assert all(left[k] == any(spans.lower(s) in spans.lower(t or "") for s, _ in known for t in (a, b)) for k, a, b, _ in rows)


def test_no_span_changes_nothing(spark):
    none = spark.createDataFrame([], "span string, category string")
    frame = spark.createDataFrame([(1, "a", None, "x")], SCHEMA)
    assert [tuple(r) for r in spans.scrub(frame, ["a", "b"], none).collect()] == [(1, "a", None, "x")]
    assert not spans.residue(frame, ["a"], none).first().residue


def test_time_does_not_grow_with_the_spans(spark):
    texts = [" ".join(f"w{n}" for n in RNG.integers(0, 40_000, 3000)) for _ in range(60)]
    frame = spark.createDataFrame([(k, t, None, "x") for k, t in enumerate(texts)], SCHEMA).repartition(2).cache()
    seconds = {}
    for n in (10, 10_000):
        known = [(f"w{2 * k + 20_000} ", "n") for k in range(n)]
        table = spark.createDataFrame(known, "span string, category string").cache()
        table.count()
        spans.scrub(frame, ["a"], table).count()
        began = time.time()
        got = {r.k: r.a for r in spans.scrub(frame, ["a"], table).collect()}
        seconds[n] = time.time() - began
        names = {s for s, _ in known}
        want = {k: re.sub(r"w\d+ ", lambda m: "[REDACTED:n]" if m[0] in names else m[0], t) for k, t in enumerate(texts)}
        assert got == want
    assert seconds[10_000] < 4 * seconds[10] + 2
