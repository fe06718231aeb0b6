"""MinHash near-dedup with sequential Bayesian verification.

A document's set is its distinct word shingles. Documents with one set are a class, and only one of each
class goes on; digests find the classes, and sets that share a digest are compared whole. Signatures of
BANDS * ROWS minima are cut into bands; documents that share a band's values meet in a bucket. At similarity
0.8 a pair shares no band with probability (1 - 0.8**5)**40, about 1e-7.

Candidates are pairs of a bucket, and no others. They are compared in batches of their signatures; a pair is
dropped once the posterior probability (uniform prior) of reaching the threshold falls below MISS. Only the
survivors' full sets are fetched, and compared exactly.

No bucket is expanded into rows for its pairs. First every member meets one other, the least id of all its
buckets, and the components of the verified links are found. A bucket that then holds several components is
open; its members outside its largest component are strays. Each open bucket draws PIVOTS members of its
largest component, and each stray meets as many of these at most, those with which it shares the most buckets.
What is open after that first passes an exact prefix filter: of members whose rarest shingles no other component has,
as in families that share a boilerplate and no more, none can have a link left, and none is looked at again. The others
are compared in full: strays meet a bucket's others in blocks of BLOCK by BLOCK members, of which a hot bucket has
many. A block compares signatures first; only members with a surviving pair go on to a second pass with their full
sets, in the same blocks. A pair belongs to the first bucket it shares; pairs within a component are skipped, as are
those that a block has linked meanwhile, so a block gives fewer links than it has members. The work left is strays
times the others of their open buckets, for members that share rare shingles with another component without being
similar to it.

* Null or empty texts, and those without a word, have an empty set and link with nothing; a text with
  fewer words than a shingle has one shingle, its whole sequence. Texts are read whole.
* Rows that repeat an id are one document, whose component is that of all its texts.
* Rows with a null id link with nothing; their component is null and they are kept.
* Ties: a pair at exactly the threshold is linked; of equal matches the lesser id is tested first, which
  doesn't show in the result.
* An empty table gives an empty result. Only id and text are read, so other columns may have any name;
  `keep` returns all columns unchanged.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.graph import components
from colloquy.llm.scratch import bound_batches, cut, drop

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
BATCH = 25
MISS = 1e-8
BLOCK = 128
PIVOTS = 4
#: Pairs of signatures that a worker compares at a time.
PAIRS = 1 << 17

_RNG = np.random.Generator(np.random.Philox(7))
_A = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.int64) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.int64).astype(np.uint32)
_BAND_WEIGHTS = T.mix64(np.arange(1, ROWS + 1, dtype=T.U64)) | T.U64(1)


@dataclass(frozen=True)
class Similar:
    """Links pairs whose sets of `words`-word shingles share at least percent/100 of their union."""

    words: int = 5
    percent: int = 80


def shingles(part: T.Slice, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as sorted hashes, one text after the other, and where each text's begin and end."""
    starts, ends, text = part.spans(T.NOT_SPACE)
    word = part.hashes(starts, ends, T.BYTES_LOWER)
    at = np.flatnonzero(T.whole(text, words))
    grams, owner = T.gram_hashes(word, words)[at] if len(at) else np.zeros(0, T.U64), text[at]
    n_words = part.per_text(text)
    if words > 1 and (short := np.flatnonzero((n_words > 0) & (n_words < words))).size:
        first = np.cumsum(n_words) - n_words
        whole = [T.gram_hashes(word[first[k] : first[k] + n_words[k]], int(n_words[k]))[0] for k in short]
        grams, owner = np.concatenate([grams, T.mix64(np.array(whole, T.U64) + T.U64(1))]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(part.n + 1))


def signatures(grams: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """HASHES minima of each text's shingles, 16 bits of each; zeros for an empty set."""
    out = np.zeros((len(offs) - 1, HASHES), np.uint16)
    full = np.flatnonzero(offs[1:] > offs[:-1])
    if len(full):
        x = (grams >> T.U64(32)).astype(np.uint32)
        begins = offs[:-1][full]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                least = np.minimum.reduceat(x * _A[k] + _B[k], begins)
                out[full, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def digests(grams: np.ndarray, offs: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums of each text's shingles; another seed gives others."""
    out = []
    for k in (2 * seed, 2 * seed + 1):
        sums = np.zeros(len(grams) + 1, T.U64)
        with np.errstate(over="ignore"):
            np.cumsum(T.mix64(grams ^ T.mix64(np.full(1, k + 1))[0]), dtype=T.U64, out=sums[1:])
            out.append((sums[offs[1:]] - sums[offs[:-1]]).view(np.int64))
    return out[0], out[1]


def _binary(signature: np.ndarray) -> pa.Array:
    return T.binaries(signature.ravel(), np.arange(len(signature) + 1) * HASHES)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), HASHES)


KEY = ["n_shingles", "h1", "h2"]


def _sketch(words: int, seed: int, sets: bool):
    """KEY of each text, with its signature or its whole set."""

    def work(part: T.Slice, _) -> dict:
        grams, offs = shingles(part, words)
        h1, h2 = digests(grams, offs, seed)
        more = {"grams": T.binaries(grams, offs)} if sets else {"signature": _binary(signatures(grams, offs))}
        return {"n_shingles": np.diff(offs), "h1": h1, "h2": h2} | more

    return lambda: work


def _band_values(signature: np.ndarray) -> np.ndarray:
    """The bucket of each signature's each band."""
    values = signature.reshape(-1, BANDS, ROWS).astype(T.U64) + T.U64(1)
    with np.errstate(over="ignore"):
        return T.mix64((values * _BAND_WEIGHTS).sum(axis=2, dtype=T.U64) + T.mix64(np.arange(BANDS, dtype=T.U64))).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, signature) to a row for each band: (bucket, band, rep)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            rows = batch.slice(lo, 2048)
            keys = _band_values(_matrix(rows.column(1)))
            bands = np.tile(np.arange(BANDS, dtype=np.int8), rows.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(bands), rows.column(0).take(pa.array(np.repeat(np.arange(rows.num_rows), BANDS)))], ["bucket", "band", "rep"])


def least_matches(percent: int) -> list[tuple[int, int]]:
    """After n hashes: the fewest matches with which the posterior of similarity >= percent/100 isn't below MISS."""
    p, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < MISS:  # P(J >= p | m of n) = P(Binomial(n + 1, p) <= m), with a uniform prior
            m += 1
            tail += math.comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of signatures that no batch prunes, and how many of their hashes match."""
    alive, matches, seen = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in bounds:
        matches = matches + (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, seen = alive[keep], matches[keep], n
    return alive, matches


def _pruned(how: Similar):
    """Rows (a, b, their signatures) to the pairs that survive."""
    bounds = least_matches(how.percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                rows = batch.slice(lo, 2048)
                yield rows.select([0, 1]).take(pa.array(survivors(_matrix(rows.column(2)), _matrix(rows.column(3)), bounds)[0]))

    return run


def _verified(how: Similar):
    """Rows (a, b, their full sets as sorted hashes) to (a, b, whether they are similar)."""

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= how.percent * (len(x) + len(y) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [similar(np.frombuffer(x.as_py(), T.U64), np.frombuffer(y.as_py(), T.U64)) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


ROLE = ("bucket", "i", "j", "as_stray", "is_stray", "band", "rep", "comp")


class _Block:
    """Rows of whole blocks of open buckets: strays (as_stray) and the others that they meet, by number."""

    def __init__(self, rows: pa.Table):
        number = lambda c: pc.rank(rows[c], tiebreaker="dense").to_numpy().astype(np.int64)
        self.rep, self.comp, self.band = number("rep"), number("comp"), rows["band"].to_numpy()
        self.is_stray, self.signature = rows["is_stray"].to_numpy(), _matrix(rows["signature"].combine_chunks())
        keys = np.stack([rows[c].to_numpy() for c in ("bucket", "i", "j")])
        self.group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
        as_stray = rows["as_stray"].to_numpy()
        self.left, self.right = np.flatnonzero(as_stray), np.flatnonzero(~as_stray)

    def pairs(self, bounds: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Surviving pairs (stray, other) of different components that share this bucket first, PAIRS compared at a time."""
        left, right = self.left, self.right
        first, last = (np.searchsorted(self.group[right], self.group[left], side) for side in ("left", "right"))
        total, lo = np.cumsum(last - first), 0
        while lo < len(left):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, side="right")))
            n = last[lo:hi] - first[lo:hi]
            x = np.repeat(left[lo:hi], n)
            y = right[np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[lo:hi], n)]
            # two strays meet twice, in two blocks; one of them counts
            open_ = (self.comp[x] != self.comp[y]) & (~self.is_stray[y] | (self.rep[x] < self.rep[y]))
            x, y = x[open_], y[open_]
            alive, _ = survivors(self.signature[x], self.signature[y], bounds)
            x, y = x[alive], y[alive]
            same = (self.signature[x] == self.signature[y]).reshape(-1, BANDS, ROWS).all(axis=2)
            here = same[np.arange(len(x)), self.band[x]] & (same.argmax(axis=1) == self.band[x])
            yield x[here], y[here]
            lo = hi


def _asking(how: Similar):
    """Rows of blocks to those with a surviving pair, without signatures."""
    bounds = least_matches(how.percent)

    def work(rows: pa.Table) -> pa.Table:
        block, wanted = _Block(rows), np.zeros(rows.num_rows, bool)
        for x, y in block.pairs(bounds):
            wanted[x] = wanted[y] = True
        return rows.select(ROLE).filter(pa.array(wanted))

    return work


def _linking(how: Similar):
    """Rows of blocks with their full sets to verified links; pairs that are joined by links before aren't compared."""
    bounds = least_matches(how.percent)

    def work(rows: pa.Table) -> pa.Table:
        block, links = _Block(rows), []
        sets = [np.frombuffer(x.as_py(), T.U64) for x in rows["grams"]]
        joined = block.comp + block.group * (int(block.comp.max()) + 1)  # components, block by block
        for xs, ys in block.pairs(bounds):
            order = np.argsort(xs, kind="stable")
            for x, y in zip(*(np.split(z[order], np.flatnonzero(np.diff(xs[order])) + 1) for z in (xs, ys))):
                y = y[joined[y] != joined[x[0]]] if len(x) else y
                if not len(y):
                    continue
                x = x[0]
                sizes = np.array([len(sets[k]) for k in y])
                values = np.concatenate([sets[k] for k in y])
                spot = np.minimum(np.searchsorted(sets[x], values), len(sets[x]) - 1)
                shared = np.add.reduceat((sets[x][spot] == values).astype(np.int64), np.cumsum(sizes) - sizes)
                for other in y[100 * shared >= how.percent * (sizes + len(sets[x]) - shared)].tolist():
                    if joined[other] != joined[x]:
                        links.append((x, other))
                        joined[joined == joined[other]] = joined[x]
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": rows["rep"].take(pa.array(ends[:, 0])), "b": rows["rep"].take(pa.array(ends[:, 1]))})

    return work


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, comp, full set) to a row for each shingle."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            sets = [np.frombuffer(x.as_py(), np.int64) for x in rows.column(2)]
            sizes = np.array([len(x) for x in sets], np.int64)
            at = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets))], ["rep", "comp", "size", "gram"])


def _able(open_: DataFrame, of_reps: DataFrame, how: Similar) -> DataFrame:
    """Those of some members that may still be similar to one of another component, by a prefix filter: (rep), a table of `cut`.

    Take all shingles in one order. Two sets that share percent/100 of their union share a shingle among the first
    n - ceil(percent * n / 100) + 1 of each. The order here has those first that only one component has, then the
    others from rare to common; only the latter can be shared with another component."""
    comp_type = open_.schema["comp"].dataType.simpleString()
    members = open_.select("rep", "comp").distinct()
    rows = cut(members.join(of_reps.hint("merge"), "rep").select("rep", "comp", "grams").mapInArrow(_shingle_rows, f"rep {comp_type}, comp {comp_type}, size bigint, gram bigint"), "shingles")
    several = lambda r: r.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high").select("gram", "n")
    spread = cut(several(rows), "spread")
    # (a row for each document, with its own shingles)
    mine = rows.join(spread.hint("merge"), "gram").groupBy("rep", "comp", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    own = F.col("size") - F.size("grams")
    room = F.col("size") - F.floor((how.percent * F.col("size") + 99) / 100) + 1 - own
    first = cut(mine.filter(room > 0).select("rep", "comp", F.explode(F.slice("grams", F.lit(1), room.cast("int"))["gram"]).alias("gram")), "first")
    met = cut(several(first), "met")
    able = cut(first.join(met.select("gram").hint("merge"), "gram", "left_semi").select("rep").distinct(), "able")
    drop(rows, spread, first, met)
    return able


def assign(docs: DataFrame, how: Similar = Similar(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    for seed in itertools.count():  # another seed only where two sets share both digests
        sketches = cut(T.map_texts(texts, "doc_id", "text", "n_shingles bigint, h1 bigint, h2 bigint, signature binary", _sketch(how.words, seed, False)), "sketches")
        linkable = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = cut(linkable.groupBy(*KEY).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n")), "classes")

        banded = classes.select("rep", "signature").mapInArrow(_bands, f"bucket bigint, band tinyint, rep {id_type}")
        # (aggregates are written before the joins, which then are of two plain shuffles; Spark can split a hot bucket's)
        shared = cut(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("least")).filter("n > 1").select("bucket", "least"), "shared")
        members = cut(banded.join(shared, "bucket").select("bucket", "band", "rep", "least"), "members")
        drop(shared)

        # full sets of all that have a candidate or a copy
        copies = linkable.join(classes.filter("n > 1").select(*KEY), KEY, "left_semi").select("doc_id", F.lit(True).alias("copy"))
        needed = cut(members.select(F.col("rep").alias("doc_id"), F.lit(False).alias("copy")).unionByName(copies).groupBy("doc_id").agg(F.max("copy").alias("copy")), "needed")
        asked = texts.join(needed.hint("merge"), "doc_id").select(F.struct("doc_id", "copy").alias("doc_id"), "text")
        sets = T.map_texts(asked, "doc_id", "text", "n_shingles bigint, h1 bigint, h2 bigint, grams binary", _sketch(how.words, seed, True))
        facts = cut(sets.select("doc_id.*", *KEY, "grams").filter("n_shingles > 0"), "facts")
        drop(needed)
        contents = facts.filter("copy").groupBy(*KEY, "grams").agg(F.count(F.lit(1)).alias("n")).groupBy(*KEY).agg(F.count(F.lit(1)).alias("contents"))
        if contents.filter("contents > 1").isEmpty():
            break
        drop(sketches, classes, members, facts)
    of_reps = facts.select(F.col("doc_id").alias("rep"), "grams")
    marks = cut(classes.select("rep", "signature").join(members.select("rep").distinct(), "rep", "left_semi"), "marks")

    def candidates(pairs: DataFrame) -> DataFrame:
        side = lambda end, x: marks.select(F.col("rep").alias(end), F.col("signature").alias(x)).hint("merge")
        return pairs.join(side("a", "s1"), "a").join(side("b", "s2"), "b").select("a", "b", "s1", "s2").mapInArrow(_pruned(how), f"a {id_type}, b {id_type}")

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda end, x: of_reps.select(F.col("rep").alias(end), F.col("grams").alias(x)).hint("merge")
        met = pairs.join(side("a", "g1"), "a").join(side("b", "g2"), "b").select("a", "b", "g1", "g2")
        return met.mapInArrow(_verified(how), f"a {id_type}, b {id_type}, linked boolean").filter("linked").select("a", "b").distinct()

    def join(links: DataFrame) -> None:
        """Joins components by verified links, a table that is removed."""
        nonlocal comps
        before, links = comps, cut(links, "linked")
        if before is None:
            comps = components(links.unionByName(same))
        elif not links.isEmpty():
            comps = components(links.unionByName(before.select(F.col("id").alias("a"), F.col("least").alias("b"))))
            drop(before)
        drop(links)

    def opened(some: DataFrame) -> DataFrame:
        """Those of some members whose bucket holds several components, with what the bucket is cut into."""
        placed = some.select("bucket", "band", "rep").join(comps.select(F.col("id").alias("rep"), F.col("least").alias("comp")), "rep", "left").select("bucket", "band", "rep", F.coalesce("comp", "rep").alias("comp"))
        counted = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
        mixed = counted.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
        mixed = cut(mixed.select("bucket", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("n") - F.col("top")) / BLOCK).cast("int").alias("stray_blocks")), "mixed")
        made = cut(placed.join(mixed, "bucket").withColumn("is_stray", F.col("comp") != F.col("largest")).drop("largest"), "open")
        drop(mixed)
        return made

    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    # rows of one id with several sets are one document
    several = linkable.groupBy("doc_id").agg(F.min(F.struct(*KEY)).alias("low"), F.max(F.struct(*KEY)).alias("high")).filter("low != high").select("doc_id")
    same = linkable.join(several, "doc_id").join(classes, KEY).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comps = None
    join(verify(candidates(members.groupBy("rep").agg(F.min("least").alias("least")).filter("least != rep").select(*ordered("least", "rep")))))

    open_ = opened(members)
    drawn = F.array_distinct(F.array(*[F.max_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(PIVOTS)]))
    pivots = cut(open_.filter("NOT is_stray").groupBy("bucket").agg(drawn.alias("pivots")), "pivots")
    shared = open_.filter("is_stray").join(pivots, "bucket").select("rep", F.explode("pivots").alias("pivot")).groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("n"))
    # (a stray is in BANDS buckets at most, so this list is short)
    most = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("n", "pivot")))), 1, PIVOTS)
    met = shared.groupBy("rep").agg(most.alias("most")).select("rep", F.explode("most").alias("m")).select(*ordered("rep", "m.pivot")).distinct()
    join(verify(candidates(met)))

    open_left = opened(open_)
    able = _able(open_left, of_reps, how)
    still = cut(open_left.join(able.hint("merge"), "rep", "left_semi").select("bucket", "band", "rep", "comp", "is_stray"), "still")
    sizes = still.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.ceil(F.count_if("is_stray") / BLOCK).cast("int").alias("stray_blocks"), (F.min("comp") != F.max("comp")).alias("mixed"))
    sizes = cut(sizes.filter("mixed AND stray_blocks > 0").drop("mixed"), "sizes")
    left = still.join(sizes, "bucket")
    every, own = lambda n: F.sequence(F.lit(0), F.col(n) - 1), lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    # (each role is one entry of an array, so that signatures are joined and dealt out once)
    other = F.transform(every("stray_blocks"), lambda j: F.struct(own("blocks").alias("i"), j.alias("j"), F.lit(False).alias("as_stray")))
    stray = F.when(F.col("is_stray"), F.transform(every("blocks"), lambda i: F.struct(i.alias("i"), own("stray_blocks").alias("j"), F.lit(True).alias("as_stray"))))
    roles = F.explode(F.concat(other, F.coalesce(stray, F.array().cast("array<struct<i:int,j:int,as_stray:boolean>>"))))
    rows = left.join(marks, "rep").select("bucket", "band", "rep", "comp", "is_stray", "signature", roles.alias("r"))
    blocks = rows.select("bucket", "r.i", "r.j", "r.as_stray", "is_stray", "band", "rep", "comp", "signature")
    role_type = f"bucket bigint, i int, j int, as_stray boolean, is_stray boolean, band tinyint, rep {id_type}, comp {id_type}"
    asking = cut(T.map_groups(blocks, ["bucket", "i", "j"], role_type, _asking(how)), "asking")
    sets = of_reps.join(asking.select("rep").distinct(), "rep", "left_semi").join(marks, "rep")
    join(T.map_groups(asking.join(sets.hint("merge"), "rep"), ["bucket", "i", "j"], f"a {id_type}, b {id_type}", _linking(how)))
    drop(members, facts, marks, open_, pivots, open_left, able, still, sizes, asking)

    named = classes.select(*KEY, "rep").join(comps, F.col("rep") == F.col("id"), "left").select(*KEY, F.coalesce("least", "rep").alias("component_id"))
    joined = sketches.drop("signature").join(named, KEY, "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep(docs: DataFrame, how: Similar = Similar(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs but those of documents whose group has a document with a smaller id."""
    dropped = cut(assign(docs, how, id_col=id_col, text_col=text_col).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "dropped")
    return docs.join(dropped, docs[id_col] == dropped["__gone"], "left_anti")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) > 1 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END)) AS k FROM w),
c AS (SELECT k, min(doc_id) AS rep FROM s WHERE len(k) > 0 GROUP BY k),
e AS (SELECT rep, len(k) AS n, unnest(k) AS g FROM c),
l AS (SELECT a.rep AS a, b.rep AS b FROM e a JOIN e b ON a.g = b.g AND a.rep < b.rep AND 80 * a.n <= 100 * b.n AND 80 * b.n <= 100 * a.n
      GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT rep AS id, rep AS place FROM c UNION SELECT r.id, y.b FROM reach r JOIN both_ways y ON y.a = r.place),
least AS (SELECT id, min(place) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(s.k) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, s.doc_id = coalesce(component_id, s.doc_id) AS kept
FROM s LEFT JOIN c ON s.k = c.k LEFT JOIN least ON least.id = c.rep
"""
