"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths measure how many of a text's characters stand inside
n-grams of words, or lines, that the text holds twice or more.

* Empty or null texts have no word and fail the rule on length.
* Very long texts are measured whole; memory grows with the longest text alone.
* Repeated rows are measured each on its own; an empty table gives an empty result.
* Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """A text is kept unless it breaks one; shares are of the characters in words."""

    min_words: int = 10
    #: Percent of words inside 5-word windows found twice or more.
    max_repeat_percent: int = 20
    #: Share of characters inside lines found twice or more.
    max_line_share: float = 0.30
    #: By n: share of characters inside n-word windows found twice or more.
    max_gram_share: dict[int, float] = field(default_factory=lambda: {5: 0.25, 7: 0.22, 10: 0.20})
    #: Characters of `[#*$%&|<>]` for each word.
    max_symbols_per_word: float = 0.30


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, line_share double, gram_share double"


def measure_slice(part: T.Slice, rules: Rules) -> dict[str, np.ndarray]:
    starts, ends, text = part.spans(T.NOT_SPACE)
    n_words = part.per_text(text)
    chars = part.sums(T.LEADS[part.buf], starts, ends)
    word_chars = part.per_text(text, chars)
    symbols = part.sums(SYMBOLS[part.buf], part.offs[:-1], part.offs[1:])

    salt = T.mix64(np.arange(1, part.n + 1, dtype=T.U64))  # equal n-grams of two texts differ
    l_starts, l_ends, l_text = part.lines()
    first = np.searchsorted(starts, l_starts)  # the first word at or after each line's start
    worded = first < np.searchsorted(starts, l_ends)
    l_starts, l_ends, l_text = l_starts[worded], l_ends[worded], l_text[worded]
    twice, earlier = T.repeated(part.hashes(l_starts, l_ends) ^ salt[l_text])
    n_dup_lines = part.per_text(l_text[earlier])
    word_total = np.concatenate([[0], np.cumsum(chars)])
    of_line = word_total[np.searchsorted(starts, l_ends)] - word_total[np.searchsorted(starts, l_starts)]
    line_chars = part.per_text(l_text[twice], of_line[twice])

    words = part.hashes(starts, ends)
    n_repeat, failing, worst = np.zeros(part.n, np.int64), np.zeros(part.n, bool), np.zeros(part.n)
    most = np.maximum(word_chars, 1)
    for n in sorted({5, *rules.max_gram_share}):
        at = np.flatnonzero(T.whole(text, n))
        twice, _ = T.repeated(T.gram_hashes(words, n)[at] ^ salt[text[at]]) if len(at) else (np.zeros(0, bool), None)
        inside = T.covered(at[twice], n, len(words))
        if n == 5:
            n_repeat = part.per_text(text[inside])
        if n in rules.max_gram_share:
            share = part.per_text(text[inside], chars[inside]) / most
            failing |= share > rules.max_gram_share[n]
            worst = np.maximum(worst, share)
    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    line_share = line_chars / most
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat,
        "base_failed": base_failed, "kept": ~(base_failed | failing | (line_share > rules.max_line_share) | (symbols > rules.max_symbols_per_word * n_words)), "line_share": line_share, "gram_share": worst,
    }


def measure(docs: DataFrame, rules: Rules = Rules(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id and MEASURES."""
    return T.map_texts(docs, id_col, text_col, MEASURES, lambda: lambda part, _: measure_slice(part, rules))


def keep(docs: DataFrame, rules: Rules = Rules(), *, text_col: str = "text") -> DataFrame:
    """The rows of docs that break no rule, with all their columns."""
    bound_batches(docs.sparkSession)

    def kept(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, bool), *(measure_slice(part, rules)["kept"] for part in T.slices(texts))]))

    return docs.filter(F.arrow_udf(kept, "boolean")(F.col(f"`{text_col}`")))
