"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is hashed into blocks. Its target fixes how often it is passed over whole, and which blocks a
last partial pass draws, in permuted order, as long as they fit; the first that doesn't is drawn in part:
documents in hash order up to the first that doesn't fit, then the largest that still do. So a source's quota
is an exact number of blocks. The tree halves the output shards again and again, each time dealing the
remaining block quotas of all sources to the two halves by a multivariate hypergeometric draw. A shard's leaf
says how many blocks of each source it gets; the shards take disjoint runs of each source's permuted blocks,
and shuffle their documents locally.

The driver holds one row for each source and each block (at most about MAX_BLOCKS and one for each source, as
blocks grow with the corpus); both tables are broadcast up to BROADCAST_ROWS rows and joined by a shuffle
beyond. Documents stay distributed, and a hot source is only more blocks. Draws follow from the seed and the
documents alone, so reruns agree.

* A null text has size 0, and a null source is a source of its own, the last in order.
* A document of size 0 adds nothing to any target; it is drawn as its block is.
* Rows that agree in id and text are drawn alike, and count as one where a block is drawn in part; null ids
  don't matter. Ties of hashes are such rows. Very long texts are counted whole. An empty table gives an empty
  mix.
* All columns of docs stay, whatever their names: ours are dropped, and begin with `__mix_`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches, cut

BROADCAST_ROWS = 200_000
MAX_BLOCKS = 65_536
BLOCK_WORDS = 20_000
SHARD_WORDS = 1 << 22


def cycle(weights: tuple[float, ...]):
    """Weights for sources in order of code points, null last: the given ones, repeating."""
    return lambda sources: [weights[k % len(weights)] for k in range(len(sources))]


def targets(sizes: np.ndarray, weights: np.ndarray, total: float, most: float) -> np.ndarray:
    """Shares of `total` by weight; none above `most` times its size, what is over shared again by weight."""
    caps, out, free = most * sizes.astype(float), np.zeros(len(sizes)), np.ones(len(sizes), bool)
    total = min(total, caps.sum())
    while free.any():
        share = (total - caps[~free].sum()) / weights[free].sum()
        over = free & (share * weights > caps)
        if not over.any():
            out[free] = share * weights[free]
            break
        free &= ~over
    return np.where(free, out, caps)


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Block counts (shard, source) that add up to the quotas, dealt down a binary tree of shards."""
    if shards == 1:
        return quotas[None]
    left = shards // 2
    n = int(round(quotas.sum() * left / shards))
    drawn = rng.multivariate_hypergeometric(quotas, n, method="marginals") if n else np.zeros_like(quotas)
    return np.concatenate([split_tree(drawn, left, rng), split_tree(quotas - drawn, shards - left, rng)])


@dataclass
class Mix:
    """A plan: `sources` and `blocks` are small tables on the driver, `sized` one row for each document."""

    sources: pd.DataFrame  # source, no, words, target, n_blocks, cutoff
    blocks: pd.DataFrame  # no, block, shards (of whole draws), part (the shard of the partial draw, or null)
    sized: DataFrame
    extras: DataFrame  # no, key: what a partial draw takes besides the keys up to its cutoff
    n_extras: int
    shards: int
    seed: int


def _key(docs: DataFrame, id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _side(table: DataFrame, rows: int) -> DataFrame:
    """A table of so many rows for a join."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _placed(rows: DataFrame, sources: DataFrame, n: int, source: str, key: str, names: dict[str, str]) -> DataFrame:
    """rows with the columns of their source (a table of n rows) and the document's block."""
    facts = _side(sources.select(F.col("source").alias("__mix_at"), *[F.col(k).alias(v) for k, v in names.items()]), n)
    return rows.join(facts, rows[source].eqNullSafe(facts["__mix_at"])).drop("__mix_at").withColumn("__mix_block", F.pmod(F.xxhash64(key, F.lit(1)), F.col(names["n_blocks"])).cast("int"))


def _last_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a source's last block (one row a key): the last key in hash order before the first that doesn't fit (not an
    extra), and of the others the largest that do, one after the other; at last one more if that is nearer to the room."""
    rows = rows.sort_values("key")
    keys, sizes, room = rows["key"].to_numpy(), rows["size"].to_numpy(), int(rows["room"].iloc[0])
    n = int(np.searchsorted(np.cumsum(sizes), room, side="right"))
    left, taken = room - int(sizes[:n].sum()), []
    rest = np.arange(n, len(keys))
    rest = rest[sizes[rest] > 0]
    rest = rest[np.argsort(-sizes[rest], kind="stable")]  # largest first
    own, at = sizes[rest], 0
    while left and (at := max(at, int(np.searchsorted(-own, -left)))) < len(rest):  # the next that fits, and all after it up to the first that doesn't
        run = int(np.searchsorted(np.cumsum(own[at:]), left, side="right"))
        taken.append(np.arange(at, at + run))
        left -= int(own[at : at + run].sum())
        at += run
    free = np.ones(len(rest), bool)
    for run in taken:
        free[run] = False
    if left and free.any() and own[last := int(np.flatnonzero(free)[-1])] - left < left:
        free[last] = False
    extras = keys[rest[~free]]
    found = np.concatenate([keys[n - 1 : n], extras])
    return pd.DataFrame({"no": int(rows["no"].iloc[0]), "key": found, "extra": np.arange(len(found)) >= min(n, 1)})


def plan(docs: DataFrame, weigh, *, budget: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """How docs are to be mixed. `weigh` gives a weight for each source of a list in order of code points,
    null last; `budget` is in all sizes; no document is taken more than `most` times."""
    spark = docs.sparkSession
    bound_batches(spark)
    count = F.arrow_udf(T.word_counts, "bigint")
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count(F.col(text_col)).alias("size"), _key(docs, id_col, text_col, seed).alias("key")), "sized")
    rows = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    names, words = [r.source for r in rows], np.array([r.words for r in rows], np.int64)
    weights = np.array(weigh(names), float)
    target = targets(words, weights, budget * words.sum(), most) if len(rows) else np.zeros(0)
    per_block = max(BLOCK_WORDS, words.sum() / MAX_BLOCKS)
    n_blocks = np.maximum(1, np.ceil(words / per_block)).astype(np.int64)
    kind = f"source {docs.schema[source_col].dataType.simpleString()}, no int, n_blocks bigint"
    facts = spark.createDataFrame(list(zip(names, range(len(rows)), n_blocks.tolist())), kind)
    placed = _placed(sized, facts, len(rows), "source", "key", {"no": "no", "n_blocks": "n_blocks"})

    # whole and partial draws of blocks; at most MAX_BLOCKS rows and one more for each source
    held = {(r.no, r["__mix_block"]): r.words for r in placed.groupBy("no", "__mix_block").agg(F.sum("size").alias("words")).collect()}
    draws, edges = [], []  # (no, block, is whole) in each source's permuted order
    for no in range(len(rows)):
        passes, order = int(target[no] // words[no]) if words[no] else 0, np.arange(n_blocks[no])
        left = target[no] - passes * words[no]
        for k in range(passes + 1):
            permuted = order[np.argsort(T.mix64(T.mix64(order) ^ T.U64(seed + 1009 * k)) ^ T.mix64(np.full(1, no))[0], kind="stable")]
            edge = None
            for block in permuted.tolist():
                size = held.get((no, block), 0)
                if k < passes:
                    draws.append((no, block, True))
                elif size > left:
                    edge = block if edge is None else edge
                elif size:
                    draws.append((no, block, True))
                    left -= size
            if edge is not None and left >= 0.5:
                draws.append((no, edge, False))
                edges.append((no, edge, int(round(left))))
    edge_rows = spark.createDataFrame(edges, "no int, __mix_block int, room bigint")
    inside = placed.join(_side(edge_rows, len(edges)), ["no", "__mix_block"]).groupBy("no", "key", "room").agg(F.sum("size").alias("size"))
    last = cut(inside.groupBy("no").applyInPandas(_last_block, "no int, key bigint, extra boolean"), "last")
    cutoffs = {r.no: r.key for r in last.filter("NOT extra").collect()}  # one a source
    extras = last.filter("extra").select("no", "key")

    total = float(target.sum())
    shards = max(math.ceil(total / SHARD_WORDS), min(math.ceil(total / (SHARD_WORDS >> 5)), 128), 1)
    quotas = np.bincount([d[0] for d in draws], minlength=len(rows)).astype(np.int64)
    leaves = split_tree(quotas, shards, np.random.Generator(np.random.Philox(seed))) if len(rows) else np.zeros((shards, 0), np.int64)
    ends = np.cumsum(leaves, axis=0)
    by_block: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
    seen = [0] * len(rows)
    for no, block, full in draws:
        shard = int(np.searchsorted(ends[:, no], seen[no], side="right"))
        seen[no] += 1
        by_block.setdefault((no, block), ([], []))[0 if full else 1].append(shard)
    blocks = pd.DataFrame([(no, block, whole, part[0] if part else None) for (no, block), (whole, part) in by_block.items()], columns=["no", "block", "shards", "part"])
    sources = pd.DataFrame({"source": names, "no": range(len(rows)), "words": words, "target": target, "n_blocks": n_blocks, "cutoff": pd.Series([cutoffs.get(k) for k in range(len(rows))], dtype=object)})
    return Mix(sources, blocks, sized, extras, extras.count(), shards, seed)


def _drawn(rows: DataFrame, mix: Mix, source: str, key: str) -> DataFrame:
    """rows with the columns __mix_shards (one entry a draw), __mix_words and __mix_target."""
    spark = rows.sparkSession
    kind = rows.schema[source].dataType.simpleString()
    s = mix.sources
    facts = spark.createDataFrame([(r.source, int(r.no), int(r.words), float(r.target), int(r.n_blocks), None if pd.isna(r.cutoff) else int(r.cutoff)) for r in s.astype(object).itertuples()], f"source {kind}, no int, words bigint, target double, n_blocks bigint, cutoff bigint")
    names = {c: f"__mix_{c}" for c in ("no", "words", "target", "n_blocks", "cutoff")}
    blocks = spark.createDataFrame([(int(r.no), int(r.block), list(r.shards), None if pd.isna(r.part) else int(r.part)) for r in mix.blocks.astype(object).itertuples()], "__mix_no int, __mix_block int, __mix_whole array<int>, __mix_part int")
    placed = _placed(rows, facts, len(s), source, key, names).join(_side(blocks, len(mix.blocks)), ["__mix_no", "__mix_block"], "left")
    extras = mix.extras.select(F.col("no").alias("__mix_no"), F.col("key").alias(key), F.lit(True).alias("__mix_extra"))
    placed = placed.join(_side(extras, mix.n_extras), ["__mix_no", key], "left")
    part = F.col("__mix_part").isNotNull() & (F.coalesce(F.col(key) <= F.col("__mix_cutoff"), F.lit(False)) | F.coalesce("__mix_extra", F.lit(False)))
    none = F.array().cast("array<int>")
    return placed.withColumn("__mix_shards", F.concat(F.coalesce("__mix_whole", none), F.when(part, F.array("__mix_part")).otherwise(none)))


def taken(mix: Mix) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, the words that the mix takes of it, and the shards
    that the tree deals it to, one for each draw."""
    return _drawn(mix.sized, mix, "source", "key").select("doc_id", "size", F.col("__mix_words").alias("source_size"), F.col("__mix_target").alias("target"), (F.col("size") * F.size("__mix_shards")).alias("taken"), F.col("__mix_shards").alias("shards"))


def mixed(docs: DataFrame, mix: Mix, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of docs, each as often as it is drawn, by shard and shuffled in it."""
    keyed = docs.withColumn("__mix_key", _key(docs, id_col, text_col, mix.seed))
    rows = _drawn(keyed, mix, source_col, "__mix_key").select(*[F.col(f"`{c}`") for c in docs.columns], "__mix_key", F.posexplode("__mix_shards").alias("__mix_copy", "__mix_shard"))
    dealt = rows.repartitionById(mix.shards, "__mix_shard").sortWithinPartitions("__mix_shard", F.xxhash64("__mix_key", "__mix_copy", F.lit(mix.seed)))
    return dealt.select(*[F.col(f"`{c}`") for c in docs.columns])
