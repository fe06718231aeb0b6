"""Words, lines and rolling hashes of whole texts, by numpy over Arrow's own buffers.

Every function works on the bytes of many texts at once (a `Slice`), so no Python loop runs over
words. The 64-bit hashes are polynomial ones over a fixed byte table, then mixed; they don't depend
on the process, the machine or the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.scratch import bound_batches

U64 = np.uint64
#: Texts are taken together up to so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Hashes are summed up over so many bytes or words at a time.
BLOCK = 1 << 18

_MULTIPLIER = U64(0x9E3779B97F4A7C15 | 5)
_WORD_MULTIPLIER = U64(0xD1342543DE82EF95)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's last steps)."""
    x = np.array(x, dtype=U64)
    with np.errstate(over="ignore"):
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def _inverse(m: int) -> int:
    return pow(int(m), -1, 1 << 64)


class _Powers:
    """Polynomial hashes of spans of values: sums of value[start + k] * base**k modulo 2**64.

    Powers of the base and of its inverse are kept for BLOCK places; longer values are taken block by block, so
    that what is held besides the values themselves doesn't grow with them."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.up, self.down = (self._table(b) for b in (base, U64(_inverse(base))))

    @staticmethod
    def _table(base: np.uint64) -> np.ndarray:
        steps = np.full(BLOCK + 1, base, U64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            return np.cumprod(steps, dtype=U64)

    def spans(self, n: int, values: Callable[[int, int], np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of n values, of which values(a, b) gives some: the hash of each span."""
        with np.errstate(over="ignore"):
            if n <= BLOCK:
                sums = np.zeros(n + 1, U64)
                np.cumsum(values(0, n) * self.up[:n], dtype=U64, out=sums[1:])
                return (sums[ends] - sums[starts]) * self.down[starts]
            where = np.concatenate([starts, ends])
            order = np.argsort(where, kind="stable")
            sorted_, found = where[order], np.zeros(len(where), U64)
            total, scale = U64(0), U64(1)
            shifts = np.ones(n // BLOCK + 1, U64)
            shifts[1:] = self.down[BLOCK]
            shifts = np.cumprod(shifts, dtype=U64)
            for a in range(0, n + 1, BLOCK):
                b = min(n, a + BLOCK)
                sums = np.zeros(b - a + 1, U64)
                np.cumsum(values(a, b) * self.up[: b - a], dtype=U64, out=sums[1:])
                lo, hi = np.searchsorted(sorted_, [a, a + BLOCK])
                found[order[lo:hi]] = total + scale * sums[sorted_[lo:hi] - a]
                total, scale = total + scale * sums[-1], scale * self.up[b - a]
            first, last = found[: len(starts)], found[len(starts) :]
            return (last - first) * self.down[starts % BLOCK] * shifts[starts // BLOCK]


_BYTE_POWERS, _WORD_POWERS = _Powers(_MULTIPLIER), _Powers(_WORD_MULTIPLIER)
BYTES = mix64(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
BYTES_LOWER = BYTES.copy()
BYTES_LOWER[65:91] = BYTES[97:123]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, letters, and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: The first byte of each character in UTF-8.
LEADS = (np.arange(256) & 0xC0) != 0x80


class Slice:
    """Some consecutive texts: `buf` has their bytes, text k is buf[offs[k]:offs[k + 1]]."""

    def __init__(self, lo: int, buf: np.ndarray, offs: np.ndarray):
        self.lo, self.buf, self.offs, self.n = lo, buf, offs, len(offs) - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each run of bytes b with inside[b]; runs end where texts end."""
        at = inside[self.buf]
        before, after = np.empty_like(at), np.empty_like(at)
        if len(at):
            before[0] = after[-1] = False
            before[1:], after[:-1] = at[:-1], at[1:]
            cuts = self.offs[1:-1]
            before[cuts[cuts < len(at)]] = False
            after[cuts[cuts > 0] - 1] = False
        starts, ends = np.flatnonzero(at & ~before), np.flatnonzero(at & ~after) + 1
        return starts, ends, self.text_of(starts)

    def text_of(self, where: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offs, where, side="right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each line, split at line feeds; an empty text has one empty line."""
        feeds = np.flatnonzero(self.buf == 10)
        starts = np.concatenate([self.offs[:-1], feeds + 1])
        text = np.concatenate([np.arange(self.n), self.text_of(feeds)])
        order = np.lexsort((starts, text))
        starts, text = starts[order], text[order]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        last = np.ones(len(text), bool)
        last[:-1] = text[1:] != text[:-1]
        ends[last] = self.offs[1:][text[last]]
        return starts, ends, text

    def hashes(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
        """A 64-bit hash of the bytes of each span; spans may overlap."""
        sums = _BYTE_POWERS.spans(len(self.buf), lambda a, b: table[self.buf[a:b]], starts, ends)
        with np.errstate(over="ignore"):
            return mix64(sums + (ends - starts).astype(U64))

    def sums(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of values (one a byte), the sum over each span."""
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(values, dtype=np.int64, out=total[1:])
        return total[ends] - total[starts]

    def per_text(self, text: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        out = np.bincount(text, weights=weights, minlength=self.n)
        return out if weights is None else np.rint(out).astype(np.int64)


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the word hashes of each span."""
    return mix64(_WORD_POWERS.spans(len(words), lambda a, b: words[a:b], starts, ends))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive word hashes, whatever text they belong to."""
    starts = np.arange(max(0, len(words) - n + 1))
    return span_hashes(words, starts, starts + n)


def whole(text_of_word: np.ndarray, n: int) -> np.ndarray:
    """Whether the n words from each start on belong to one text."""
    if len(text_of_word) < n:
        return np.zeros(0, bool)
    return text_of_word[n - 1 :] == text_of_word[: len(text_of_word) - n + 1]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether it occurs earlier."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, earlier


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` positions lie in a window of n that begins at one of starts."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + n, total), -1)
    return np.cumsum(edges[:-1]) > 0


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column, null as empty, in slices of about `limit` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield Slice(lo, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str, make: Callable[[], Callable[[Slice, pa.RecordBatch], dict]], limit: int = SLICE_BYTES) -> DataFrame:
    """Rows (id, columns of `schema`) of what `make()(slice, batch)` returns for each slice of texts.

    Only the two columns reach Python, under names of our own, so others may be called anything.
    `make` runs once a task and may load what it needs there.
    """
    bound_batches(df.sparkSession)
    pairs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = pairs.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            ids = batch.column(0)
            for part in slices(batch.column(1), limit):
                got = work(part, batch)
                yield pa.RecordBatch.from_arrays([ids.slice(part.lo, part.n), *(got[x] if isinstance(got[x], pa.Array) else pa.array(got[x]) for x in names)], ["doc_id", *names])

    return pairs.mapInArrow(run, f"doc_id {id_type}, {schema}")


def map_groups(df: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """What `work` makes of rows that stand in order of `keys`, in tables of some whole groups each.

    A group is held by one task, so groups must be bounded; tables hold about a batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            same = np.ones(held.num_rows, bool)
            for key in keys:
                same &= np.asarray(pc.fill_null(pc.equal(held[key], held[key][-1]), False))
            done = held.num_rows - int(same.sum())
            if done:
                yield from work(held.slice(0, done).combine_chunks()).to_batches()
                held = held.slice(done)
        if held is not None:
            yield from work(held.combine_chunks()).to_batches()

    bound_batches(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def binaries(values: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A binary array whose row k is the bytes of values[offs[k]:offs[k + 1]]."""
    ends = pa.py_buffer((np.asarray(offs, np.int64) * values.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, ends, pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def word_counts(column: pa.Array) -> pa.Array:
    """Of each text its number of words, null: 0."""
    return pa.array(np.concatenate([np.zeros(0, np.int64), *(p.per_text(p.spans(NOT_SPACE)[2]) for p in slices(column))]).astype(np.int64))
