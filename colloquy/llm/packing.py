"""Packing by powers of two: no sequence crosses a document, and none is padded.

A document's ids are cut by the binary digits of their number: as many pieces of the longest length as fit, then
one for each digit of the rest, longest first. Every piece is a sequence of its own, whose length is a power of
two; sequences of one length are a bucket, and a batch is taken from one bucket. Sequences are numbered bucket by
bucket without gaps: each task counts its own pieces of each length, and the counts of the tasks (a row for each
task and length) give the offsets. So a range of sequence ids is a run of sequences of equal length.

Ids are the library's. Byte-level BPE merges only inside the tokens of its first split, and that split always
ends in places such as between a letter and something that isn't one; texts are cut there, each distinct piece is encoded
once, and what is held is bounded however long a text is. Only characters whose class hasn't changed since
Unicode 3.2 make a cut, so it doesn't depend on the library's version of Unicode. A tokenizer whose split isn't
that one encodes whole texts.

* Null texts count as empty; an empty text is its end id alone, one sequence of length 1.
* Texts are encoded whole, however long; rows are packed each on its own, repeated ones too; ties don't arise.
* The strings of special tokens are ordinary text, as a document can't be allowed to say them.
* An empty table gives an empty result. Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches, cut

MOST = 2048
END = 1
#: Distinct pieces of text that a worker keeps, and their bytes.
KEPT, KEPT_BYTES = 1 << 20, 32 << 20

#: Classes of characters; a mark is punctuation or a symbol.
LETTER, NUMBER, MARK, BLANK, BREAK = 1, 2, 3, 4, 5


@lru_cache(1)
def _classes() -> np.ndarray:
    """The class of each code point, where Unicode 3.2 and this Python agree on it, else 0."""
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER, "P": MARK, "S": MARK}
    for cp in range(0x10000):
        old, new = unicodedata.ucd_3_2_0.category(chr(cp)), unicodedata.category(chr(cp))
        out[cp] = kinds.get(new[0], 0) if old[0] == new[0] else 0
    out[ord(" ")], out[[9, 10, 13]] = BLANK, BREAK
    return out


def text_cuts(part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which texts begin or a token of the split surely ends, and the end of all; how many each text has.

    A token ends between a letter and anything else, a mark and white space, a mark that isn't an apostrophe and a
    letter, and a single line break (or a tab) and a letter or mark; of several, the last is split off by what follows."""
    points = np.frombuffer(part.buf.tobytes().decode().encode("utf-32-le"), "<u4")
    kind = _classes()[points]
    left, right = kind[:-1], kind[1:]
    ends = (left == LETTER) & (right > LETTER) | (left == MARK) & ((right >= BLANK) | (right == LETTER) & (points[:-1] != 39))
    ends[1:] |= (left[1:] == BREAK) & ((right[1:] == LETTER) | (right[1:] == MARK)) & (left[:-1] > 0) & (left[:-1] <= MARK)
    is_cut = np.zeros(len(part.buf) + 1, bool)
    is_cut[np.flatnonzero(T.LEADS[part.buf])[1:][ends]] = True
    is_cut[part.offs] = True
    cuts = np.flatnonzero(is_cut)
    return cuts, np.diff(np.searchsorted(cuts, part.offs))


class Ids:
    """Ids of texts by the tokenizer file at `path`, and which pieces of text have which."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path) as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.by_pieces = model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec["normalizer"] and not model.get("dropout")
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.forget()

    def forget(self, least: int = 0) -> None:
        """Keeps the pieces that were used so often; least 0 forgets all."""
        if not least:
            self.number: dict[bytes, int] = {}
            self.ids, self.ends, self.uses, self.held = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64), 0
            return
        keep = self.uses >= least
        size = np.diff(self.ends)
        pieces = [x for x, k in zip(self.number, keep.tolist()) if k]
        self.ids, self.ends = self.ids[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(size[keep])])
        self.number, self.uses, self.held = dict(zip(pieces, itertools.count())), np.zeros(len(pieces), np.int64), sum(map(len, pieces))

    def _learn(self, new: list[bytes]) -> None:
        ids, sizes = [self.ids], []
        for lo in range(0, len(new), 1024):
            some = [x.decode() for x in new[lo : lo + 1024]]
            if self.by_pieces:  # as given pieces of one text
                found = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
                ids.append(np.array(found.ids, np.uint32))
                sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
            else:
                found = [e.ids for e in self.library.encode_batch(some, add_special_tokens=False)]
                ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32))
                sizes.append(np.array([*map(len, found)]))
        self.ids, self.ends = np.concatenate(ids), np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.held += sum(map(len, new))

    def __call__(self, part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and where each text's begin and end."""
        cuts, n = text_cuts(part) if self.by_pieces else (np.unique(part.offs), np.minimum(np.diff(part.offs), 1))
        spans = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(part.buf))])
        spans = spans.dictionary_encode()
        pieces, spot = spans.dictionary.to_pylist(), spans.indices.to_numpy()
        if len(self.number) > KEPT or self.held > KEPT_BYTES:
            self.forget(2)
            if len(self.number) > KEPT // 2 or self.held > KEPT_BYTES // 2:
                self.forget()
        known = np.fromiter(map(self.number.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        if len(unknown := np.flatnonzero(known < 0)):
            known[unknown] = len(self.number) + np.arange(len(unknown))
            self._learn([pieces[k] for k in unknown.tolist()])
        self.uses[known] += np.bincount(spot, minlength=len(known))
        which = known[spot]
        first, size = self.ends[which], self.ends[which + 1] - self.ends[which]
        total = np.concatenate([[0], np.cumsum(size)])
        where = np.arange(total[-1]) - np.repeat(total[:-1] - first, size)
        return self.ids[where], total[np.concatenate([[0], np.cumsum(n)])]


@lru_cache(4)
def _tokenizer(path: str) -> Ids:
    return Ids(path)


def binary_pieces(lengths: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents of some lengths: each piece's document, start and length; `most` is a power of two."""
    digits = most >> np.arange(1, most.bit_length())
    whole = lengths // most
    counts = np.concatenate([whole[:, None], (lengths % most)[:, None] // digits % 2], axis=1)
    sizes = np.concatenate([[most], digits])
    doc, kind = (x.ravel() for x in np.broadcast_arrays(np.arange(len(lengths))[:, None], np.arange(len(sizes))))
    doc, length = np.repeat(doc, counts.ravel()), np.repeat(sizes[kind], counts.ravel())
    ends = np.cumsum(length)
    before = np.concatenate([[0], np.cumsum(lengths)])[doc]
    return doc, ends - length - before, length


def _running(values: np.ndarray, seen: dict[int, int]) -> np.ndarray:
    """For each value how often it was seen before, here and in calls before."""
    out = np.empty(len(values), np.int64)
    for v in np.unique(values).tolist():
        at = np.flatnonzero(values == v)
        out[at] = seen.get(v, 0) + np.arange(len(at))
        seen[v] = seen.get(v, 0) + len(at)
    return out


def pieces(docs: DataFrame, path: str, *, most: int = MOST, end: int = END, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (or null without with_ids), ids_crc32, doc_tokens, and the
    task that made it with its number among that task's pieces of this length."""
    if most < 1 or most & (most - 1):
        raise ValueError("the longest sequence must be a power of two")
    bound_batches(docs.sparkSession)
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = pairs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seen, part_id = _tokenizer(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            for part in T.slices(batch.column(1), 1 << 20):
                found, offs = tokenizer(part)
                ids = np.insert(found, offs[1:], end).astype("<u4")  # each document's, then its end
                lengths = np.diff(offs) + 1
                doc, start, length = binary_pieces(lengths, most)
                at = np.concatenate([[0], np.cumsum(length)])
                raw = memoryview(ids.view(np.uint8))
                crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())), np.int64, len(length))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))) if with_ids else pa.nulls(len(length), pa.list_(pa.int32()))
                made = [batch.column(0).slice(part.lo, part.n).take(pa.array(doc)), start, length, lists, crc, lengths[doc], np.full(len(doc), part_id), _running(length, seen)]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in made], names)

    return pairs.mapInArrow(run, f"doc_id {id_type}, start bigint, length bigint, ids array<int>, ids_crc32 bigint, doc_tokens bigint, part bigint, place bigint")


def pack(docs: DataFrame, path: str, **how) -> DataFrame:
    """`pieces` as sequences: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset (always 0)."""
    made = cut(pieces(docs, path, **how), "pieces")
    # a row for each task and length; a window holds those of one length, or one row a length
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("length").agg(F.sum("n").alias("n"))
    shorter = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", F.coalesce(F.sum("n").over(shorter), F.lit(0)).alias("first"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(first, "length").select("part", "length", (F.col("first") + F.col("before")).alias("first"))
    numbered = made.join(offsets, ["part", "length"])
    return numbered.select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", (F.col("first") + F.col("place")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Writes sequences with a folder for each length, in order of their numbers; long buckets are many files."""
    sequences.repartitionByRange("sequence_id").sortWithinPartitions("sequence_id").write.partitionBy("length").parquet(path)
