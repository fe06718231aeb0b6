"""Language-model scoring by an Elias-Fano n-gram trie.

Level 1 holds every training word, sorted by hash; a word's place is its number. A node of a higher level
is a context (a node one level below) followed by a word; a level is cut into parts by ranges of contexts,
hot contexts also by word. A part stores its contexts' monotone pointers, its successors' numbers
relative to their context, and its counts, as Elias-Fano sequences, and each discounted probability as a
byte. Parts are files in the shared folder, mapped by the workers; a lookup is a successor search within
the context's range.

Probabilities interpolate by absolute discounting: an n-gram seen `c` times after a context seen `t`
times has (c - DISCOUNT) / t, and what the kept ones leave is spread by the probabilities one level below;
level 1 is the base, (c + 0.1) / (N + 0.1 * (V + 1)). All n-grams are kept; a caller may ask for `cutoffs`,
which only leaves more to the level below.

Counts are gathered over all training texts: each task adds up its own n-grams before they are shuffled,
packed by part. Parts grow in number with the corpus, so that each is built by a task from about PART_TOKENS
tokens; beyond MAX_PARTS of a level (about 2 * 10**12 tokens) they grow in size, as the driver holds SLOTS
numbers for each. A worker opens a part when a text asks for it, and holds a bounded number of them.

* Null texts count as empty and hold one token, the end. Texts are scored whole, repeated rows each.
* Unknown words take the base's share of an unseen word, and no context. With no training text, that is
  the only word.
* Ties don't arise. Very long texts are taken whole; what a worker holds grows with the longest one.
* Only id and text are read, so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.eliasfano import U64, Cache, EliasFano, load, save, to_bytes
from colloquy.llm.scratch import MOST_BYTES, bound_batches, new_path, store_uri, tidy

DISCOUNT = 0.75
CUTOFFS = (1, 1, 1)
PART_TOKENS = 1 << 21
#: Texts for each part of the words, which are cut before any token has been counted.
PART_TEXTS = 4000
MAX_PARTS = 1 << 20
SLOTS = 16
#: Pairs of a context and a word are one number as long as they fit in so many bits, else two.
KEY_BITS = 64
PAIR = np.dtype([("context", U64), ("word", U64)])
#: Texts taken together, in bytes: a whole Arrow batch, as more of them ask a part more at a time.
SLICE = 2 * MOST_BYTES
HELD_KEYS = 3_000_000
END = T.mix64(np.array([0xE0D], U64))[0]
SEQUENCES = ("keys", "totals", "pointers", "successors")
#: A probability p is kept as the byte round(-STEPS * log10(p)).
STEPS = 32
CHANCES = 10.0 ** (np.arange(256) / -STEPS)


@dataclass
class Level:
    """Where a level's parts are; all of it is bounded by MAX_PARTS."""

    uris: list[str]
    kept: np.ndarray  # nodes by part
    slots: np.ndarray  # contexts' tokens by part and slot
    tokens: int = 0
    masses: dict[int, str] = field(default_factory=dict)  # by the first part of a split slot: what all its parts keep
    first_part: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # by slot of the level below
    splits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def bases(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.kept)])

    @property
    def nodes(self) -> int:
        return int(self.kept.sum())


def slot_of(level: Level, nodes: np.ndarray) -> np.ndarray:
    """Slots group a part's nodes in SLOTS runs; the node after the last (a text's begin) has its own."""
    bases = level.bases
    part = np.minimum(np.searchsorted(bases, nodes, side="right") - 1, len(level.kept))
    size = np.append(level.kept, 1)[part]
    return part * SLOTS + np.where(part < len(level.kept), (nodes - bases[part]) * SLOTS // size, 0)


def slot_nodes(level: Level, slot: int) -> tuple[int, int]:
    """The first node of a slot, and the first of the next."""
    part, nth = divmod(slot, SLOTS)
    if part == len(level.kept):
        return level.nodes, level.nodes + 1
    base, size = int(level.bases[part]), int(level.kept[part])
    return base + -(-nth * size // SLOTS), base + -(-(nth + 1) * size // SLOTS)


def deal(slots: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Consecutive slots to parts of about equal tokens; a slot with more is split by word. Also the slots of each part."""
    goal, first, splits, spans, filled = max(1, -(-int(slots.sum()) // parts)), np.zeros(len(slots), np.int64), np.ones(len(slots), np.int64), [], 0
    for k, n in enumerate(slots.tolist()):
        if n > goal:
            first[k], splits[k] = len(spans), -(-n // goal)
            spans += [(k, k + 1)] * int(splits[k])
            filled = goal
        elif not spans or filled + n > goal:
            first[k], filled = len(spans), n
            spans.append((k, k + 1))
        else:
            first[k], filled = len(spans) - 1, filled + n
            spans[-1] = (spans[-1][0], k + 1)
    return first, splits, spans


def pairs(contexts: np.ndarray, words: np.ndarray, nodes: int, n_words: int, key_bits: int) -> np.ndarray:
    """Contexts (below `nodes`) and words (up to n_words) as keys that sort by context, then word."""
    bits = (n_words + 1).bit_length()
    if bits + nodes.bit_length() <= key_bits:
        return (contexts.astype(U64) << U64(bits)) | words.astype(U64)
    out = np.empty(len(contexts), PAIR)
    out["context"], out["word"] = contexts, words
    return out


def unpaired(keys: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The contexts and words of pairs."""
    if keys.dtype == PAIR:
        return keys["context"].astype(np.int64), keys["word"].astype(np.int64)
    bits = U64((n_words + 1).bit_length())
    return (keys >> bits).astype(np.int64), (keys & ((U64(1) << bits) - U64(1))).astype(np.int64)


class Trie:
    """The levels as a worker sees them; parts are opened as they are asked for."""

    def __init__(self, levels: list[Level], n_texts: int, key_bits: int = KEY_BITS):
        self.levels, self.n_texts, self.key_bits, self.cache = levels, n_texts, key_bits, Cache()
        self.bits = max(1, len(levels[0].uris)).bit_length() - 1
        self.begin = levels[0].nodes
        self.families = []  # of each split slot: its first part, and the part after its last
        for level in levels[1:]:
            hot = np.flatnonzero(level.splits > 1)
            self.families.append((level.first_part[hot], level.first_part[hot] + level.splits[hot]))

    def part(self, order: int, k: int) -> dict | None:
        """A part's sequences and arrays, or None if it has no n-gram."""
        uri = self.levels[order - 1].uris[k]
        return uri and self.cache(uri, lambda a: {name: EliasFano.of(a, name) for name in SEQUENCES if f"{name}.meta" in a} | {name: a[name] for name in ("span", "bytes", "mass") if name in a})

    def kept(self, order: int, k: int) -> tuple[int, np.ndarray] | None:
        """The first context of a part, and the share that each one's n-grams keep, in all parts of a split slot together."""
        first, last = self.families[order - 2]
        at = int(np.searchsorted(first, k, side="right")) - 1
        if at >= 0 and k < last[at]:
            uri = self.levels[order - 1].masses.get(int(first[at]))
            return uri and self.cache(uri, lambda a: (int(a["span"][0]), a["mass"]))
        held = self.part(order, k)
        return held and (int(held["span"][0]), held["mass"])

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Words' numbers, -1 for unknown ones."""
        at, back = np.unique(hashes, return_inverse=True)
        out, bases = np.full(len(at), -1, np.int64), self.levels[0].bases
        part = (at >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(at), np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held := self.part(1, p := int(part[lo])):
                found = held["keys"].find(_inside(at[lo:hi], self.bits))
                out[lo:hi] = np.where(found >= 0, found + bases[p], -1)
        return out[back]

    def count(self, order: int, nodes: np.ndarray) -> np.ndarray:
        """How often the n-grams of known nodes were seen; of the begin: the number of texts."""
        level, out = self.levels[order - 1], np.full(len(nodes), self.n_texts, np.int64)
        part, bases = np.searchsorted(level.bases, nodes, side="right") - 1, level.bases
        by_part = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[by_part], prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = by_part[lo:hi]
            if (p := int(part[own[0]])) < len(level.kept):
                totals, k = self.part(order, p)["totals"], nodes[own] - bases[p]
                out[own] = (totals.access(k + 1) - totals.access(k)).astype(np.int64)
        return out

    def step(self, order: int, contexts: np.ndarray, words: np.ndarray, only_nodes: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of n-grams (context, word), -1 for unknown: node or -1, discounted probability, and the share left to the
        level below (these two as if nothing were known, where only nodes are asked for)."""
        level, below = self.levels[order - 1], self.levels[order - 2]
        node, probability, rest = np.full(len(contexts), -1, np.int64), np.zeros(len(contexts)), np.ones(len(contexts))
        known = np.flatnonzero((contexts >= 0) & (words >= 0)) if only_nodes else np.flatnonzero(contexts >= 0)
        if not len(known) or not len(level.uris):
            return node, probability, rest
        # each n-gram once, in order, so that a context is looked up once and memory is read in order
        unknown = self.begin  # no word has this number
        asked, back = np.unique(pairs(contexts[known], np.where(words[known] < 0, unknown, words[known]), below.nodes + 1, self.begin, self.key_bits), return_inverse=True)
        context, word = unpaired(asked, self.begin)
        head = np.flatnonzero(np.diff(context, prepend=-1))
        size = np.diff(np.append(head, len(context)))
        slot = slot_of(below, context[head])
        part = np.repeat(level.first_part[slot], size) + np.where(word == unknown, 0, word) * np.repeat(level.splits[slot], size) // (self.begin + 1)
        order_ = None
        if (part[1:] < part[:-1]).any():  # only where slots are split by word
            order_ = np.argsort(part, kind="stable")
            context, word, part = context[order_], word[order_], part[order_]
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        a_node, a_probability, a_rest = np.full(len(asked), -1, np.int64), np.zeros(len(asked)), np.ones(len(asked))
        for begin, end in zip(cuts[:-1], cuts[1:]):
            p = int(part[begin])
            kept = self.kept(order, p)
            if kept is None:
                continue
            head = np.flatnonzero(np.diff(context[begin:end], prepend=-1))
            size = np.diff(np.append(head, end - begin))
            at = context[begin + head] - kept[0]
            mass = kept[1][at]
            if not only_nodes:
                a_rest[begin:end] = np.repeat(1 - mass, size)
            held = self.part(order, p)
            if held is None:
                continue
            some, own = mass > 0, np.arange(begin, end)
            if not some.all():  # contexts that nothing follows
                at, size, own = at[some], size[some], own[np.repeat(some, size)]
            lo, hi = held["pointers"].access(at).astype(np.int64), held["pointers"].access(at + 1).astype(np.int64)
            first = _base(held["successors"], lo) + U64(1)
            found = held["successors"].find(word[own].astype(U64) + np.repeat(first, size), np.repeat(lo, size), np.repeat(hi, size))
            hit = np.flatnonzero(found >= 0)
            a_node[own[hit]] = found[hit] + level.bases[p]
            if not only_nodes:
                a_probability[own[hit]] = CHANCES[held["bytes"][found[hit]]]
        if order_ is not None:
            back = np.argsort(order_)[back]
        node[known] = a_node[back]
        if not only_nodes:
            probability[known], rest[known] = a_probability[back], a_rest[back]
        return node, probability, rest


def _inside(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes & U64((1 << (64 - bits)) - 1) if bits else hashes


def _base(successors: EliasFano, lo: np.ndarray) -> np.ndarray:
    """The value before each context's range; its own values are relative to that."""
    out = np.zeros(len(lo), U64)
    some = np.flatnonzero(lo > 0)
    out[some] = successors.access(lo[some] - 1)
    return out


class Tokens:
    """The tokens of a slice's texts, each text's end included."""

    def __init__(self, part: T.Slice):
        starts, ends, text = part.spans(T.NOT_SPACE)
        n = part.per_text(text) + 1
        self.n = n
        self.last = np.cumsum(n) - 1
        self.first = self.last - n + 1
        self.hashes = np.full(int(n.sum()), END, U64)
        self.hashes[np.arange(len(starts)) + text] = part.hashes(starts, ends, T.BYTES_LOWER)
        self.text = np.repeat(np.arange(part.n), n)

    def before(self, values: np.ndarray, begin: int) -> np.ndarray:
        """The value of the token before each; of a text's first token: begin."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = begin
        return out


def _walk(trie: Trie, tokens: Tokens, order: int, only_nodes: bool = False) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Numbers of the tokens; and for each level from 2 to `order` what Trie.step says of each token after its context."""
    words = trie.number(tokens.hashes)
    steps, context = [], tokens.before(words, trie.begin)
    for level in range(2, order + 1):
        steps.append(trie.step(level, context, words, only_nodes))
        context = tokens.before(steps[-1][0], -1)
    return words, steps


# --- counting ----------------------------------------------------------------------------------------


def _count(docs: DataFrame, make: Callable[[], Callable[[T.Slice], np.ndarray]], part_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """The keys that make()(slice) gives, added up in each task, by part_of(keys): rows (part, once, keys, counts)."""

    def pack(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        parts = part_of(keys)
        order = np.argsort(parts, kind="stable")
        keys, parts, n = keys[order], parts[order], n[order]
        cuts = np.flatnonzero(np.diff(parts, prepend=-1, append=-1))
        rows = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            once = n[lo:hi] == 1
            rows.append((int(parts[lo]), keys[lo:hi][once].tobytes(), keys[lo:hi][~once].tobytes(), n[lo:hi][~once].astype(np.uint32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["part", "once", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, held, size = make(), [], 0
        for batch in batches:
            for part in T.slices(batch.column(0), SLICE):
                held.append(work(part))
                size += len(held[-1])
                if size > HELD_KEYS:
                    yield from pack(held)
                    held, size = [], 0
        if size:
            yield from pack(held)

    return docs.mapInArrow(run, "part int, once binary, keys binary, counts binary")


def _merged(rows: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    join = lambda name, kind: np.frombuffer(b"".join(x.as_buffer() for x in rows[name]), kind)
    once, keys, counts = join("once", kind), join("keys", kind), join("counts", np.uint32)
    keys, n = np.concatenate([once, keys]), np.concatenate([np.ones(len(once), np.int64), counts.astype(np.int64)])
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def _slots(counts: np.ndarray) -> bytes:
    """Tokens in each of the SLOTS runs of a part's nodes."""
    which = np.arange(len(counts)) * SLOTS // max(len(counts), 1)
    return np.bincount(which, counts, minlength=SLOTS).astype(np.int64).tobytes()


def _totals(counts: np.ndarray) -> EliasFano:
    total = np.concatenate([[0], np.cumsum(counts)]).astype(U64)
    return EliasFano.build(total, int(total[-1]))


BUILT = "part int, kept bigint, tokens bigint, slots binary, uri string"


def _row(part: int, kept: int, tokens: int, slots: bytes, uri: str) -> pa.Table:
    return pa.table({"part": pa.array([part], pa.int32()), "kept": [kept], "tokens": [tokens], "slots": pa.array([slots], pa.binary()), "uri": [uri]})


def _level(rows: list, parts: int) -> Level:
    kept, slots, uris = np.zeros(parts, np.int64), np.zeros((parts, SLOTS), np.int64), [None] * parts
    for r in rows:
        kept[r.part], slots[r.part], uris[r.part] = r.kept, np.frombuffer(r.slots, np.int64), r.uri
    return Level(uris, kept, slots, sum(r.tokens for r in rows))


@dataclass
class Model:
    levels: list[Level]
    n_texts: int
    key_bits: int = KEY_BITS

    @property
    def tokens(self) -> int:
        return self.levels[0].tokens

    @property
    def words(self) -> int:
        return self.levels[0].nodes


def train(docs: DataFrame, *, text_col: str = "text", cutoffs: tuple[int, ...] = CUTOFFS, key_bits: int = KEY_BITS) -> Model:
    """Counts all texts of docs and writes the trie's levels to the shared folder."""
    spark, texts = docs.sparkSession, docs.select(F.col(text_col).alias("text"))
    bound_batches(spark)
    folder = store_uri(spark, new_path(spark, "lm"))
    with tidy(spark):
        n_texts = docs.count()
        levels = [_words(texts, min(MAX_PARTS.bit_length() - 1, max(4, (n_texts // PART_TEXTS).bit_length())), folder)]
        for order in range(2, len(cutoffs) + 1):
            below = levels[-1]
            slots = np.append(below.slots.ravel(), np.append(n_texts if order == 2 else 0, np.zeros(SLOTS - 1, np.int64)))
            parts = int(min(MAX_PARTS, max(1, slots.sum() // PART_TOKENS)))
            levels.append(_next_level(texts, levels, n_texts, order, cutoffs[order - 1], *deal(slots, parts), folder, order < len(cutoffs), key_bits))
    return Model(levels, n_texts, key_bits)


def _words(texts: DataFrame, bits: int, folder: str) -> Level:
    def words():
        return lambda part: Tokens(part).hashes

    def top_bits(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - bits)).astype(np.int64)

    def build(rows: pa.Table) -> pa.Table:
        part, (keys, n) = rows["part"][0].as_py(), _merged(rows, U64)
        uri = f"{folder}/1-{part}"
        save(uri, to_bytes({"keys": EliasFano.build(_inside(keys, bits), 1 << (64 - bits)), "totals": _totals(n)}))
        return _row(part, len(keys), int(n.sum()), _slots(n), uri)

    return _level(_count(texts, words, top_bits).groupBy("part").applyInArrow(build, BUILT).collect(), 1 << bits)


def _next_level(texts: DataFrame, levels: list[Level], n_texts: int, order: int, cutoff: int, first: np.ndarray, splits: np.ndarray, spans: list[tuple[int, int]], folder: str, is_context: bool, key_bits: int) -> Level:
    below, n_words = levels[-1], levels[0].nodes
    kind = pairs(np.zeros(0, np.int64), np.zeros(0, np.int64), below.nodes + 1, n_words, key_bits).dtype

    def grams():
        trie = Trie(levels, n_texts, key_bits)

        def work(part: T.Slice) -> np.ndarray:
            tokens = Tokens(part)
            numbers, steps = _walk(trie, tokens, order - 1, only_nodes=True)
            contexts = tokens.before(numbers, trie.begin) if order == 2 else tokens.before(steps[-1][0], -1)
            at = np.flatnonzero((contexts >= 0) & (numbers >= 0))
            return pairs(contexts[at], numbers[at], below.nodes + 1, n_words, key_bits)

        return work

    def part_of(keys: np.ndarray) -> np.ndarray:
        context, word = unpaired(keys, n_words)
        slot = slot_of(below, context)
        return first[slot] + word * splits[slot] // (n_words + 1)

    def build(rows: pa.Table) -> pa.Table:
        trie = Trie(levels, n_texts, key_bits)
        part, (keys, n) = rows["part"][0].as_py(), _merged(rows, kind)
        keep = n >= cutoff
        keys, n = keys[keep], n[keep]
        lo, hi = slot_nodes(below, spans[part][0])[0], slot_nodes(below, spans[part][1] - 1)[1]
        contexts, words = unpaired(keys, n_words)
        words = words.astype(U64)
        heads, sizes = np.unique(contexts, return_counts=True)
        share = (n - DISCOUNT) / np.repeat(trie.count(order - 1, heads), sizes)
        mass = np.zeros(hi - lo, np.float32)
        mass[heads - lo] = np.add.reduceat(share, np.cumsum(sizes) - sizes) if len(heads) else 0
        pointers = np.zeros(hi - lo + 1, np.int64)
        pointers[heads - lo + 1] = sizes
        pointers = np.cumsum(pointers)
        # successors count from the last one of the context before, so all of them rise
        lasts = (words[np.cumsum(sizes) - 1] + U64(1)) if len(heads) else words
        bases = np.cumsum(np.concatenate([np.zeros(1, U64), lasts[:-1]]), dtype=U64) if len(heads) else words
        rising = words + U64(1) + np.repeat(bases, sizes)
        made = {"span": np.array([lo, hi]), "pointers": EliasFano.build(pointers, len(keys)), "successors": EliasFano.build(rising, int(rising[-1]) if len(rising) else 1), "bytes": np.clip(np.rint(-STEPS * np.log10(share)), 0, 255).astype(np.uint8), "mass": mass}
        if is_context:
            made["totals"] = _totals(n)
        uri = f"{folder}/{order}-{part}"
        save(uri, to_bytes(made))
        return _row(part, len(keys), int(n.sum()), _slots(n), uri)

    level = _level(_count(texts, grams, part_of).groupBy("part").applyInArrow(build, BUILT).collect(), len(spans))
    level.first_part, level.splits = first, splits
    level.masses = _masses(texts, level, folder, order)
    return level


def _masses(texts: DataFrame, level: Level, folder: str, order: int) -> dict[int, str]:
    """Of each split slot, what its parts keep of each context, added up by a task of its own; by the slot's first part."""
    hot = [(int(level.first_part[s]), [u for u in level.uris[level.first_part[s] : level.first_part[s] + level.splits[s]] if u]) for s in np.flatnonzero(level.splits > 1)]
    hot = [(first, uris) for first, uris in hot if uris]
    if not hot:
        return {}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, uris in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, span = 0, None
                for uri in uris:
                    arrays = load(uri)
                    total, span = total + arrays["mass"].astype(np.float64), arrays["span"]
                save(f"{folder}/{order}-mass-{first}", to_bytes({"span": span, "mass": total.astype(np.float32)}))
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([f"{folder}/{order}-mass-{first}"])], ["first", "uri"])

    rows = texts.sparkSession.createDataFrame(hot, "first bigint, uris array<string>").repartition(len(hot))
    return {r.first: r.uri for r in rows.mapInArrow(add, "first bigint, uri string").collect()}


# --- scoring -----------------------------------------------------------------------------------------

SCORED = "n_tokens bigint, n_known bigint, base_score double, score double"


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id and SCORED (log10 probabilities of the whole text)."""
    levels, n_texts, key_bits = model.levels, model.n_texts, model.key_bits
    whole = model.tokens + 0.1 * (model.words + 1)

    def make():
        trie = Trie(levels, n_texts, key_bits)

        def work(part: T.Slice, _) -> dict:
            tokens = Tokens(part)
            words, steps = _walk(trie, tokens, len(levels))
            counts = np.zeros(len(words), np.int64)
            known = np.flatnonzero(words >= 0)
            distinct, back = np.unique(words[known], return_inverse=True)
            counts[known] = trie.count(1, distinct)[back]
            base = (counts + 0.1) / whole
            chance = base
            for _, own, rest in steps:
                chance = own + rest * chance
            add = lambda x: np.bincount(tokens.text, x, minlength=part.n)
            return {"n_tokens": tokens.n, "n_known": np.rint(add(counts > 0)).astype(np.int64), "base_score": add(np.log10(base)), "score": add(np.log10(chance))}

        return work

    return T.map_texts(docs, id_col, text_col, SCORED, make, SLICE)
