"""Language ID by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary, all of them in lower case, are the units, and every single byte is
one. Each language has a probability for each piece, learned by expectation maximisation on words of a
bounded sample of labelled rows; a word's probability is the sum over all its segmentations into pieces, by
the forward algorithm. A text is given the language with the largest product of prior and word
probabilities; the score is that language's posterior.

A word is a run without white space, of any length: sums are carried from byte to byte, with a scale of their
own, and only as many bytes back as the longest piece has. So a text without spaces is one lattice. Where no piece
spans a place, its sum is that of what is before times that of what is behind; long words are cut there, which changes
nothing, and their parts are walked side by side.

* The sample: about SAMPLE rows of each language, by a hash of the id. Priors come from all labelled rows.
  Rows with a null language teach nothing. Each language is learned by a task of its own and is a file in the
  shared folder; texts are scored by BLOCK_LANGUAGES languages at a time. The driver holds a name and a count
  for each language.
* Null texts, and texts without a letter, are `und` with score 0; so is all if nothing could be learned.
* Ties go to the language first in order. Texts are scored whole; what a worker holds grows with the longest.
* Only id, text and (to learn) language are read, so other columns may have any name. Repeated rows are
  predicted alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.eliasfano import load, save, to_bytes
from colloquy.llm.scratch import bound_batches, new_path, store_uri

SAMPLE = 600
BLOCK_LANGUAGES = 64
ROUNDS = 4
SMOOTHING = 0.02
#: Cells (a byte of a word) that are worked on at a time.
CELLS = 1 << 18
#: Sums are scaled anew every so many bytes.
RESCALE = 16
#: Words of more bytes are cut where no piece spans.
LONG = 32

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
_UP = T._BYTE_POWERS.up


class Table:
    """Numbers of byte strings, found by a rolling hash: -1 for what begins no key, 0 for what only begins some."""

    SHIFT = T.U64(64 - 18)

    def __init__(self, keys: list[bytes], first: int):
        numbers = {key[:k]: 0 for key in keys for k in range(1, len(key))} | {key: first + k for k, key in enumerate(keys)}
        hashes = np.zeros(len(numbers), T.U64)
        for k, key in enumerate(numbers):
            values = np.frombuffer(key, np.uint8)
            with np.errstate(over="ignore"):
                hashes[k] = (T.BYTES_LOWER[values] * _UP[: len(key)]).sum(dtype=T.U64) + T.U64(len(key))
        hashes = T.mix64(hashes)
        bucket = (hashes >> self.SHIFT).astype(np.int64)
        self.count = np.bincount(bucket, minlength=1 << 18).astype(np.uint8)
        self.known, self.number = np.zeros((int(self.count.max(initial=1)), 1 << 18), T.U64), np.zeros((int(self.count.max(initial=1)), 1 << 18), np.int32)
        order = np.argsort(bucket, kind="stable")
        rank = np.arange(len(order)) - np.searchsorted(bucket[order], bucket[order])
        self.known[rank, bucket[order]], self.number[rank, bucket[order]] = hashes[order], np.fromiter(numbers.values(), np.int32)[order]

    def find(self, sums: np.ndarray, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            hashes = T.mix64(sums + T.U64(length))
        bucket = (hashes >> self.SHIFT).astype(np.int64)
        out, left = np.full(len(hashes), -1, np.int32), np.arange(len(hashes))
        for k, (known, number) in enumerate(zip(self.known, self.number)):
            left = left[self.count[bucket[left]] > k]
            hit = left[known[bucket[left]] == hashes[left]]
            out[hit] = number[bucket[hit]]
        return out


class Pieces:
    """The vocabulary in lower case; number 0 is no piece, 1 the mark of a word's start."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = (library.id_to_piece(k) for k in range(library.get_piece_size()) if not (library.is_control(k) or library.is_unknown(k) or library.is_byte(k)))
        inner, initial = {bytes([k]) for k in range(256)}, set()
        for text in texts:
            if data := text.lstrip("▁").encode().lower():
                (initial if text.startswith("▁") else inner).add(data)
        self.size = 2 + len(inner) + len(initial)
        self.longest = max(map(len, inner | initial))
        self.inner, self.initial = Table(sorted(inner), 2), Table(sorted(initial), 2 + len(inner))

    def arcs(self, buf: np.ndarray, starts: np.ndarray, size: np.ndarray, a: int, b: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of words, longest first: for each length of a piece the places from byte a to b where one begins, with
        its word and number, in order of place."""
        alive = np.searchsorted(-size, -np.arange(a, b), side="left")  # words of more bytes
        place = np.repeat(np.arange(a, b), alive)
        word = np.arange(len(place)) - np.repeat(np.cumsum(alive) - alive, alive)
        return self._grown(self.inner, buf, starts, size, place, word)

    def first_arcs(self, buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for pieces that hold the mark of the word's start and begin there."""
        return self._grown(self.initial, buf, starts, size, np.zeros(len(size), np.int64), np.arange(len(size)))

    def _grown(self, table: Table, buf: np.ndarray, starts: np.ndarray, size: np.ndarray, place: np.ndarray, word: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sums, out = np.zeros(len(place), T.U64), []
        at = starts[word] + place
        last = starts[word] + size[word]
        for length in range(1, self.longest + 1):
            fits = at < last
            place, word, sums, at, last = (x[fits] for x in (place, word, sums, at, last))
            with np.errstate(over="ignore"):
                sums = sums + T.BYTES_LOWER[buf[at]] * _UP[length - 1]
            number = table.find(sums, length)
            hit = number > 0
            out.append((place[hit], word[hit], number[hit]))
            more = number >= 0
            place, word, sums, at, last = (x[more] for x in (place, word, sums, at + 1, last))
            if not len(place):
                break
        return out


def blocks(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of places that hold about CELLS of the words, longest first."""
    a, width = 0, int(size.max(initial=0))
    while a < width:
        alive = int(np.searchsorted(-size, -a, side="left"))
        b = min(width, a + max(RESCALE, CELLS // max(alive, 1)))
        yield a, b
        a = b


@dataclass
class Parts:
    """Words, cut where no piece spans: spans of a buffer, longest first, each with its word and whether it begins it."""

    starts: np.ndarray
    size: np.ndarray
    word: np.ndarray
    begins: np.ndarray

    def some(self, lo: int, hi: int) -> Parts:
        return Parts(self.starts[lo:hi], self.size[lo:hi], self.word[lo:hi], self.begins[lo:hi])


def parts(pieces: Pieces, buf: np.ndarray, starts: np.ndarray, size: np.ndarray) -> Parts:
    """Of words that don't overlap, longest first: those longer than LONG in parts, the others whole."""
    whole = Parts(starts, size, np.arange(len(size)), np.ones(len(size), bool))
    n = int(np.searchsorted(-size, -LONG, side="left"))
    if not n:
        return whole
    edges, inner = np.zeros(len(buf) + 1, np.int32), np.zeros(len(buf) + 1, np.int32)
    np.add.at(inner, starts[:n] + 1, 1)
    np.add.at(inner, starts[:n] + size[:n], -1)
    for lo, hi in _groups(size[:n]):
        own = starts[lo:hi], size[lo:hi]
        for found in (pieces.first_arcs(buf, *own), *(pieces.arcs(buf, *own, a, b) for a, b in blocks(own[1]))):
            for length, (place, word, _) in enumerate(found, 1):
                if length > 1:
                    np.add.at(edges, own[0][word] + place + 1, 1)
                    np.add.at(edges, own[0][word] + place + length, -1)
    cuts = np.flatnonzero((np.cumsum(inner[:-1]) > 0) & (np.cumsum(edges[:-1]) == 0))
    order = np.argsort(starts[:n])
    word = np.concatenate([whole.word, order[np.searchsorted(starts[:n][order], cuts, side="right") - 1]])
    begins = np.concatenate([whole.begins, np.zeros(len(cuts), bool)])
    start = np.concatenate([starts, cuts])
    order = np.argsort(start, kind="stable")
    start, word, begins = start[order], word[order], begins[order]
    end = starts[word] + size[word]
    same = np.flatnonzero(word[1:] == word[:-1])
    end[same] = start[same + 1]
    order = np.argsort(start - end, kind="stable")
    return Parts(start[order], (end - start)[order], word[order], begins[order])


def forward(pieces: Pieces, buf: np.ndarray, starts: np.ndarray, size: np.ndarray, theta: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """log probability [word, language] of words or parts of them, longest first, all segmentations together;
    theta[piece, language]. `begins` says which begin a word; all, if it isn't given."""
    rows, out = pieces.longest + 1, np.zeros((len(size), theta.shape[1]))
    alpha, scale = np.zeros((rows, *out.shape)), np.zeros(out.shape)  # alpha[place % rows]: of all that ends there
    alpha[0] = theta[1] if begins is None else np.where(begins[:, None], theta[1], 1.0)
    initial = np.arange(len(size)) if begins is None else np.flatnonzero(begins)
    for length, (_, word, number) in enumerate(pieces.first_arcs(buf, starts[initial], size[initial]), 1):
        alpha[length, initial[word]] += theta[number]
    ends = np.searchsorted(-size, -np.arange(int(size.max(initial=0)) + 2), side="left")  # words of more bytes than k
    for a, b in blocks(size):
        found = [(np.searchsorted(place, np.arange(a, b + 1)), word, number) for place, word, number in pieces.arcs(buf, starts, size, a, b)]
        for k in range(a, b):
            here, n = alpha[k % rows], ends[k]
            if k and k % RESCALE == 0:
                most = here[:n].copy()
                alpha[:, :n] /= most
                scale[:n] += np.log(most)
            for length, (cuts, word, number) in enumerate(found, 1):
                if (lo := cuts[k - a]) < (hi := cuts[k - a + 1]):
                    own = word[lo:hi]
                    alpha[(k + length) % rows, own] += here[own] * theta[number[lo:hi]]
            here[:] = 0
            if (done := ends[k + 1]) < n:  # words of k + 1 bytes
                out[done:n] = np.log(alpha[(k + 1) % rows, done:n]) + scale[done:n]
    return out


def expected(pieces: Pieces, buf: np.ndarray, starts: np.ndarray, size: np.ndarray, weight: np.ndarray, theta: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """Expected uses of each piece in one language (theta[piece]), by forward and backward sums over words or parts, longest first."""
    rows, n_words, width = pieces.longest + 1, len(size), int(size.max(initial=0))
    alpha, scale = np.zeros((width + rows, n_words)), np.zeros((width // RESCALE + 1, n_words))
    begins = np.ones(n_words, bool) if begins is None else begins
    initial = np.flatnonzero(begins)
    first = [(initial[word], number) for _, word, number in pieces.first_arcs(buf, starts[initial], size[initial])]
    alpha[0] = np.where(begins, theta[1], 1.0)
    for length, (word, number) in enumerate(first, 1):
        alpha[length, word] += theta[number]
    ends = np.searchsorted(-size, -np.arange(width + 1), side="left")
    whole, log_whole = np.zeros(n_words), np.zeros(n_words)
    ranges = list(blocks(size))
    arcs = lambda a, b: [(np.searchsorted(place, np.arange(a, b + 1)), word, number) for place, word, number in pieces.arcs(buf, starts, size, a, b)]
    for a, b in ranges:
        found = arcs(a, b)
        for k in range(a, b):
            n = ends[k]
            if k and k % RESCALE == 0:
                most = alpha[k, :n].copy()
                alpha[k : k + rows, :n] /= most
                scale[k // RESCALE] = scale[k // RESCALE - 1]
                scale[k // RESCALE, :n] += np.log(most)
            for length, (cuts, word, number) in enumerate(found, 1):
                if (lo := cuts[k - a]) < (hi := cuts[k - a + 1]):
                    own = word[lo:hi]
                    alpha[k + length, own] += alpha[k, own] * theta[number[lo:hi]]
    last = (size - 1) // RESCALE  # the scale that a word's whole sum is in
    whole, log_whole = alpha[size, np.arange(n_words)], scale[last, np.arange(n_words)]
    log_whole = np.log(whole) + log_whole
    beta, behind = np.zeros((rows, n_words)), np.zeros(n_words)
    uses = np.zeros(len(theta))
    for a, b in reversed(ranges):
        found = arcs(a, b)
        for k in range(b - 1, a - 1, -1):
            n, more = ends[k], ends[k + 1] if k + 1 <= width else 0
            beta[(k + 1) % rows, more:n] = 1  # words of k + 1 bytes end there
            here = np.zeros(n_words)
            share = weight[:n] * np.exp(scale[k // RESCALE, :n] + behind[:n] - log_whole[:n]) * alpha[k, :n]
            for length, (cuts, word, number) in enumerate(found, 1):
                if (lo := cuts[k - a]) < (hi := cuts[k - a + 1]):
                    own, which = word[lo:hi], number[lo:hi]
                    through = theta[which] * beta[(k + length) % rows, own]
                    here[own] += through
                    np.add.at(uses, which, through * share[own])
            beta[k % rows] = here
            if k and k % RESCALE == 0:
                most = here[:n].copy()
                beta[:, :n] /= most
                behind[:n] += np.log(most)
    share = weight * np.exp(behind - log_whole)
    for length, (word, number) in enumerate(first, 1):
        np.add.at(uses, number, theta[number] * beta[length % rows, word] * share[word])
    uses[1] = (theta[1] * beta[0] * share)[begins].sum()
    uses[0] = 0
    return uses


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log
    files: list[str] = field(default_factory=list)  # theta[piece] of each language
    path: str = ""

    def theta(self, lo: int, hi: int) -> np.ndarray:
        """theta[piece, language] of some languages."""
        return np.stack([load(uri)["theta"] for uri in self.files[lo:hi]], axis=1)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word in lower case, times) of (language, text) rows, added up by slice."""
    for batch in batches:
        languages = batch.column(0).dictionary_encode()
        codes = np.asarray(languages.indices)
        for part in T.slices(batch.column(1)):
            starts, ends, text = part.spans(T.NOT_SPACE)
            lower = part.buf.copy()
            lower[(lower >= 65) & (lower < 91)] += 32
            key = part.hashes(starts, ends, T.BYTES_LOWER) ^ T.mix64(codes[part.lo + text] + 1)
            _, at, n = np.unique(key, return_index=True, return_counts=True)
            words = [lower[starts[k] : ends[k]].tobytes() for k in at]
            yield pa.RecordBatch.from_arrays([languages.dictionary.take(pa.array(codes[part.lo + text[at]])), pa.array(words, pa.binary()), pa.array(n)], ["lang", "word", "n"])


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of words, longest first, that have CELLS or are one word."""
    lo = 0
    while lo < len(sizes):
        hi = min(len(sizes), lo + max(1, CELLS // int(sizes[lo])))
        yield lo, hi
        lo = hi


def _maximise(pieces: Pieces, words: pa.Array, times: np.ndarray) -> np.ndarray:
    theta = np.full(pieces.size, 1 / (pieces.size - 1))
    theta[0] = 0
    words = words.cast(pa.large_binary())
    offs = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    buf = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size = np.diff(offs)
    order = np.lexsort((offs[:-1], -size))
    cut = parts(pieces, buf, offs[:-1][order], size[order])
    times = times[order].astype(float)[cut.word]
    for _ in range(ROUNDS):
        uses = sum((expected(pieces, buf, some.starts, some.size, times[lo:hi], theta, some.begins) for lo, hi in _groups(cut.size) for some in [cut.some(lo, hi)]), np.zeros(pieces.size))
        theta = (uses + SMOOTHING) / (uses[1:].sum() + SMOOTHING * (len(uses) - 1))
        theta[0] = 0
    return theta


def fit(labelled: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from rows with a language; see above for the sample."""
    spark = labelled.sparkSession
    bound_batches(spark)
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL")
    counts = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    languages = [c[0] for c in counts]
    if not counts:
        return Model([], np.zeros(0))
    folder = store_uri(spark, new_path(spark, "languages"))
    facts = F.broadcast(spark.createDataFrame([(language, k, min(1.0, SAMPLE / n)) for k, (language, n) in enumerate(counts)], "lang string, no int, share double"))
    drawn = F.pmod(F.xxhash64(F.lit(5), F.col("doc_id")), F.lit(1_000_000)) < F.col("share") * 1_000_000
    sample = rows.join(facts, "lang").filter(drawn).select(F.col("no").cast("string").alias("lang"), "text")

    def learn(words: pa.Table) -> pa.Table:
        no, pieces = words["lang"][0].as_py(), Pieces(path)
        save(f"{folder}/{no}", to_bytes({"theta": _maximise(pieces, words["word"].combine_chunks(), words["n"].to_numpy())}))
        return pa.table({"no": pa.array([int(no)], pa.int32())})

    words = sample.mapInArrow(_words, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    learned = {r.no for r in words.groupBy("lang").applyInArrow(learn, "no int").collect()}
    if len(learned) < len(languages):  # languages of whose sample no text has a word: all pieces alike
        n_pieces = Pieces(path).size
        save(f"{folder}/none", to_bytes({"theta": np.concatenate([[0.0], np.full(n_pieces - 1, 1 / (n_pieces - 1))])}))
    files = [f"{folder}/{k}" if k in learned else f"{folder}/none" for k in range(len(languages))]
    return Model(languages, np.log([n for _, n in counts]) - np.log(sum(n for _, n in counts)), files, path)


def _score(part: T.Slice, model: Model, pieces: Pieces, thetas: Callable[[int, int], np.ndarray]) -> dict:
    starts, ends, text = part.spans(T.NOT_SPACE)
    logs = np.tile(model.prior, (part.n, 1))
    if len(starts):
        _, at, word = np.unique(part.hashes(starts, ends, T.BYTES_LOWER), return_index=True, return_inverse=True)
        size = ends[at] - starts[at]
        order = np.argsort(-size, kind="stable")
        at, size, place = at[order], size[order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        word, cut = place[word], parts(pieces, part.buf, starts[at], size)
        for first in range(0, len(model.languages), BLOCK_LANGUAGES):
            theta = thetas(first, first + BLOCK_LANGUAGES)
            of_part = np.concatenate([forward(pieces, part.buf, some.starts, some.size, theta, some.begins) for lo, hi in _groups(cut.size) for some in [cut.some(lo, hi)]])
            for k in range(theta.shape[1]):
                of_word = np.bincount(cut.word, of_part[:, k], minlength=len(size))
                logs[:, first + k] += np.bincount(text, of_word[word], minlength=part.n)
    letters = part.sums(LETTER[part.buf], part.offs[:-1], part.offs[1:]) > 0
    for k in np.flatnonzero(~letters & (part.offs[1:] > part.offs[:-1])):
        letters[k] = any(c.isalpha() for c in part.buf[part.offs[k] : part.offs[k + 1]].tobytes().decode())
    best = logs.argmax(axis=1)
    posterior = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    return {"lang_pred": pa.array(np.where(letters, np.array(model.languages, object)[best], "und"), pa.string()), "score": np.where(letters, posterior, 0.0)}


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, lang_pred, score."""

    def make():
        if not model.languages:
            return lambda part, _: {"lang_pred": pa.array(["und"] * part.n, pa.string()), "score": np.zeros(part.n)}
        pieces = Pieces(model.path)
        thetas = model.theta
        if len(model.languages) <= BLOCK_LANGUAGES:  # one block is read once
            only = model.theta(0, BLOCK_LANGUAGES)
            thetas = lambda lo, hi: only
        return lambda part, _: _score(part, model, pieces, thetas)

    return T.map_texts(docs, id_col, text_col, "lang_pred string, score double", make)


def held_out(id_col: str, parts: int) -> Column:
    """Whether the CRC-32 of the id as text (null: empty) leaves no remainder."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == 0
