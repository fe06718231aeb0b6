"""A Merkle manifest of a dataset: a digest for each row, a tree of them for each group, a tree over the groups' roots.

Rows are sorted over ranges by (group, order) and kept as the partitions of that sort (a checkpoint). How many rows
of each group a partition holds gives, summed over the partitions before it, each row's place in its group; that
table has a row for each partition and one more for each group. Every partition then builds the largest complete
aligned subtrees that lie in it. What is ragged at its edges, a few nodes a level, goes on as nodes (group, level,
place). These are dealt out by the coordinate of the node that stands ROUND levels above, so one round finishes ROUND
levels, with at most FAN**ROUND nodes for each task's unit; a tree of 10**10 rows takes four. On the way back each round's siblings are put
before those of the rounds above, and a last pass deals rows out by their subtree, builds it again and returns each
row's proof.

A leaf is the sha256 (lowercase hex, as all digests) of a row's fields; a node is the sha256 of its FAN children's
hex digests, the last of a level having fewer; a group of one row is its leaf. A proof is the siblings' digests from
the leaf to its group's root and on to the root, left to right, as one string of 64 digits each.

* Nulls are fields of their own (`-`), so a null isn't an empty text. A null group is the first group, null
  order keys come first. Groups are ordered bytewise.
* Rows that tie in group and order are ordered by their digests; rows alike in all take neighbouring places.
* Texts are hashed whole. An empty table gives an empty result.
* Only the named columns are read, under names of our own, so others may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches, cut, drop, shared_dir

FAN = 3
ROUND = 6
#: Rows of a partition of the sort, and so of a subtree, at most about; small tables have a few partitions.
PART_ROWS, LEAST_ROWS = 1 << 17, 1 << 11
#: A proof's lower levels are put together for FAN**RUN rows at a time.
RUN = 7


def field(value: Column) -> Column:
    """A field's text: `-` if it is null, else its bytes in UTF-8, `:`, and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def combine(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def raised(nodes: list[str], levels: int) -> list[list[str]]:
    """Nodes that begin at a run's edge, and the levels above them."""
    rows = [nodes]
    for _ in range(levels):
        below = rows[-1]
        rows.append([combine(below[k : k + FAN]) for k in range(0, len(below), FAN)])
    return rows


def _others(row: list[str], k: int) -> str:
    first = k - k % FAN
    return "".join(row[first:k] + row[k + 1 : first + FAN])


def _spread(rows: list[list[str]], tails: list[str]) -> list[str]:
    """What follows the top row's nodes in a proof, carried down to the lowest row's."""
    for row in rows[-2::-1]:
        tails = [_others(row, k) + tails[k // FAN] for k in range(len(row))]
    return tails


def _proofs(rows: list[list[str]], tail: str) -> Iterator[list[str]]:
    """Proofs of the lowest row's nodes, in runs of FAN**RUN."""
    low = min(RUN, len(rows) - 1)
    for k, below in enumerate(_spread(rows[low:], [tail])):
        parts = [row[k * FAN ** (low - at) : (k + 1) * FAN ** (low - at)] for at, row in enumerate(rows[: low + 1])]
        yield _spread(parts, [below])


def fold(digest: str, place: int, n: int, siblings: str, at: int = 0) -> tuple[str, int]:
    """The root over a leaf at `place` of n, by its siblings from character `at` on; and where those end."""
    while n > 1:
        first = place - place % FAN
        own, size = 64 * (place - first), 64 * (min(FAN, n - first) - 1)
        run = siblings[at : at + size]
        digest = hashlib.sha256((run[:own] + digest + run[own:]).encode()).hexdigest()
        at, place, n = at + size, place // FAN, -(-n // FAN)
    return digest, at


def _by_group(rows: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table], Iterator[pa.Table]]) -> DataFrame:
    """What `work` makes of each group of rows; the groups must stand together in their partitions, and be bounded."""
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            edges = np.zeros(batch.num_rows, bool)
            for column in (batch.column(k) for k in map(batch.schema.get_field_index, keys)):
                coded = column.dictionary_encode().indices.to_numpy()
                edges[1:] |= coded[1:] != coded[:-1]
            cuts = [0, *np.flatnonzero(edges).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if held and (a or any(held[0].column(k)[0] != batch.column(k)[a] for k in keys)):
                    for made in work(pa.Table.from_batches(held).combine_chunks()):
                        yield from made.to_batches()
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            for made in work(pa.Table.from_batches(held).combine_chunks()):
                yield from made.to_batches()

    return rows.mapInArrow(run, schema)


def _dealt(rows: DataFrame, keys: list[str], then: list[str], schema: str, work: Callable[[pa.Table], Iterator[pa.Table]]) -> DataFrame:
    return _by_group(rows.repartition(*keys).sortWithinPartitions(*keys, *then), keys, schema, work)


def _subtree(rows: pa.Table) -> Iterator[pa.Table]:
    """Leaves of one complete subtree, in order, to its top."""
    top = raised(rows["leaf"].to_pylist(), rows["level"][0].as_py())[-1][0]
    yield rows.slice(0, 1).select(["grp", "n", "level", "spot"]).append_column("digest", pa.array([top]))


def _climb(rows: pa.Table) -> Iterator[pa.Table]:
    """All nodes below one node, of any levels: that node, and for each of the given ones its siblings on the way there."""
    given = list(zip(rows["level"].to_pylist(), rows["spot"].to_pylist(), rows["digest"].to_pylist()))
    upto, above = rows["up_level"][0].as_py(), rows["up_spot"][0].as_py()
    levels: list[dict[int, str]] = [{} for _ in range(upto + 1)]
    for level, spot, digest in given:
        levels[level][spot] = digest
    runs = []
    for level in range(upto):
        below: dict[int, list[int]] = {}
        for spot in sorted(levels[level]):
            below.setdefault(spot // FAN, []).append(spot)
        runs.append(below)
        for parent, spots in below.items():
            levels[level + 1][parent] = combine([levels[level][s] for s in spots])
    tails = [{above: ""}]
    for level in range(upto - 1, -1, -1):
        tails.append({s: "".join(levels[level][o] for o in spots if o != s) + tails[-1][parent] for parent, spots in runs[level].items() for s in spots})
    tails.reverse()
    same = lambda value, n: pa.array([value] * n)
    k, n = rows.num_rows, rows["n"][0].as_py()
    yield pa.table({
        "grp": same(rows["grp"][0].as_py(), k + 1), "n": same(n, k + 1), "level": pa.array([*(x[0] for x in given), upto], pa.int32()), "spot": pa.array([*(x[1] for x in given), above], pa.int64()),
        "digest": pa.array([*[None] * k, levels[upto][above]], pa.string()), "up_level": pa.array([*[upto] * k, None], pa.int32()), "up_spot": pa.array([*[above] * k, None], pa.int64()),
        "siblings": pa.array([*(tails[x[0]][x[1]] for x in given), None], pa.string()),
    })


def _height(n: Column, powers: list[int]) -> Column:
    """Levels above the leaves of a tree of n."""
    return F.size(F.filter(F.array(*[F.lit(p).cast("bigint") for p in powers]), lambda p: p < n))


class Forest:
    """Trees over the leaves of each group: rows (grp, order columns, leaf, and others that go along).

    `leaves` has each row's place and its subtree (level, spot); `roots` (grp, n, root) one row a group."""

    def __init__(self, rows: DataFrame, order: list[str], along: list[str]):
        spark = rows.sparkSession
        self.order, self.along = order, along
        n_rows = rows.count()
        parts = max(1, math.ceil(n_rows / PART_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // LEAST_ROWS))
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
        keys = ["grp", *order, "leaf"]
        self.sorted = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).checkpoint()
        placed = self.sorted.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
        held = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"), F.min("at").alias("first"))
        in_group = Window.partitionBy("grp").orderBy("part")
        held = held.select("grp", "part", "here", "first", F.coalesce(F.sum("here").over(in_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("low"), F.sum("here").over(in_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
        ranges = cut(held, "ranges")
        most = ranges.agg(F.max("n")).first()[0] or 0
        self.powers = [FAN**k for k in range(max(1, math.ceil(math.log(most + 1, FAN)) + 2))] if most else [1]

        place = (F.col("low") + F.col("at") - F.col("first")).alias("place")
        found = placed.join(ranges, ["grp", "part"]).select("grp", *order, "leaf", *along, "n", place, "low", (F.col("low") + F.col("here")).alias("high"))
        inside = lambda p: (p < FAN * F.col("n")) & (F.col("place") - F.col("place") % p >= F.col("low")) & (F.least(F.col("place") - F.col("place") % p + p, "n") <= F.col("high"))
        level = F.size(F.filter(F.array(*[F.lit(p).cast("bigint") for p in self.powers[1:]]), inside)) if len(self.powers) > 1 else F.lit(0)
        spot = F.floor(F.col("place") / F.element_at(F.array(*[F.lit(p).cast("bigint") for p in self.powers]), F.col("level") + 1)).cast("bigint")
        self.leaves = found.withColumn("level", level).withColumn("spot", spot).drop("low", "high")

        # (where the ranges were broadcast this sort finds all in order)
        stood = self.leaves.select("grp", "n", "level", "spot", "place", "leaf").sortWithinPartitions("grp", "place")
        nodes = "grp string, n bigint, level int, spot bigint, digest string"
        tops = cut(_by_group(stood, ["grp", "level", "spot"], nodes, _subtree), "tops")
        self.steps, now = [], tops.withColumn("height", _height(F.col("n"), self.powers))
        for upto in range(ROUND, len(self.powers) + ROUND, ROUND):
            up = F.least(F.lit(upto), F.col("height"))
            power = F.element_at(F.array(*[F.lit(p).cast("bigint") for p in self.powers]), up - F.col("level") + 1)
            under = now.filter(F.col("level") < up).withColumn("up_level", up).withColumn("up_spot", F.floor(F.col("spot") / power).cast("bigint"))
            made = cut(_dealt(under, ["grp", "up_level", "up_spot"], ["level", "spot"], f"{nodes}, up_level int, up_spot bigint, siblings string", _climb), "climbed")
            self.steps.append(made.filter("siblings IS NOT NULL").drop("digest", "n"))
            built = made.filter("digest IS NOT NULL").select("grp", "n", "level", "spot", "digest").withColumn("height", _height(F.col("n"), self.powers))
            now = built.unionByName(now.filter(F.col("level") >= up))
        self.roots = cut(now.select("grp", "n", F.col("digest").alias("root")), "roots")

    def proofs(self, tails: DataFrame) -> DataFrame:
        """Each leaf with its place, n and proof; tails (grp, tail, and others that go along) has what follows a group's root in it."""
        more = [c for c in tails.columns if c not in ("grp", "tail")]
        ends = self.roots.select("grp", "n").join(tails, "grp").select("grp", _height(F.col("n"), self.powers).alias("level"), F.lit(0).cast("bigint").alias("spot"), "tail", *more)
        for step in reversed(self.steps):
            above = ends.select("grp", F.col("level").alias("up_level"), F.col("spot").alias("up_spot"), "tail", *more)
            carried = step.join(above, ["grp", "up_level", "up_spot"]).select("grp", "level", "spot", F.concat("siblings", "tail").alias("tail"), *more)
            ends = ends.unionByName(carried)
        ends = cut(ends, "tails")
        keep = [*self.order, "leaf", *self.along, "n", "place"]
        dealt = self.leaves.select("grp", "level", "spot", *keep).unionByName(ends.withColumn("place", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
        out = ["grp", *keep, *more, "proof"]

        def work(rows: pa.Table) -> Iterator[pa.Table]:
            end, rows = rows.slice(0, 1), rows.slice(1)  # the tail's row is first
            if not rows.num_rows:
                return
            at = 0
            for proofs in _proofs(raised(rows["leaf"].to_pylist(), end["level"][0].as_py()), end["tail"][0].as_py()):
                some = rows.slice(at, len(proofs)).select(["grp", *keep])
                for c in more:
                    some = some.append_column(c, pa.array([end[c][0].as_py()] * len(proofs), rows[c].type))
                yield some.append_column("proof", pa.array(proofs, pa.string()))
                at += len(proofs)

        schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in out)
        return _dealt(dealt, ["grp", "level", "spot"], ["place"], schema, work)


def build(docs: DataFrame, fields: list[str], *, group_col: str, order_col: str, along: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of docs: order_col, leaf, what goes `along`, and of its proof: place (in its group), n (rows of
    the group), group_place, n_groups, subroot, root, proof."""
    along = along or {}
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # null is first, as `-` is less than `=`
    rows = cut(docs.select(group.alias("grp"), F.col(order_col).alias("__order"), leaf(*[F.col(c) for c in fields]).alias("leaf"), *[c.alias(f"__{k}") for k, c in along.items()]), "leaves")
    trees = Forest(rows, ["__order"], [f"__{k}" for k in along])
    over = Forest(trees.roots.select(F.lit("").alias("grp"), F.col("grp").alias("group"), F.col("root").alias("leaf")), ["group"], [])
    groups = over.proofs(over.roots.select("grp", F.lit("").alias("tail"), "root"))
    tails = cut(groups.select(F.col("group").alias("grp"), F.col("proof").alias("tail"), F.col("leaf").alias("subroot"), "root", F.col("place").alias("group_place"), F.col("n").alias("n_groups")), "groups")
    found = trees.proofs(tails)
    return found.select(F.col("__order").alias(order_col), "leaf", *[F.col(f"__{k}").alias(k) for k in along], "place", "n", "group_place", "n_groups", "subroot", "root", "proof")


def folded(proofs: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """proofs with `folded_root`, recomputed from the digests in leaf_col and the siblings, and `verified`, whether it is the root."""
    names = proofs.columns
    bound_batches(proofs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = (leaf_col, "place", "n", "group_place", "n_groups", "proof")
        for batch in batches:
            roots = []
            for digest, place, n, group_place, n_groups, proof in zip(*(batch.column(c).to_pylist() for c in wanted)):
                sub, at = fold(digest, place, n, proof)
                roots.append(fold(sub, group_place, n_groups, proof, at)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], [*names, "folded_root"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proofs.schema)
    return proofs.mapInArrow(run, f"{schema}, folded_root string").withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT *, list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda k: ascii(substr(doc_id::VARCHAR, k, 1))::BIGINT),
         lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) % 2 = 1 AS even,
       coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM documents),
leaves AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN even THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS seen,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (SELECT source, 0 AS lvl, i, leaf AS h, n AS w FROM leaves
       UNION ALL SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (w + 2) // 3 FROM up WHERE w > 1 GROUP BY source, lvl, i // 3, w),
subs AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE w = 1),
top AS (SELECT 0 AS lvl, i, subroot AS h, n AS w FROM subs
        UNION ALL SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (w + 2) // 3 FROM top WHERE w > 1 GROUP BY lvl, i // 3, w),
fold AS (SELECT doc_id, source, 0 AS lvl, i, n AS w, seen AS h, '' AS sibs FROM leaves
         UNION ALL SELECT doc_id, f.source, f.lvl + 1, f.i // 3, (f.w + 2) // 3, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)), f.sibs || coalesce(string_agg(CASE WHEN u.i <> f.i THEN u.h END, '' ORDER BY u.i), '')
         FROM fold f JOIN up u ON u.source IS NOT DISTINCT FROM f.source AND u.lvl = f.lvl AND u.i // 3 = f.i // 3 WHERE f.w > 1 GROUP BY doc_id, f.source, f.lvl, f.i, f.w, f.h, f.sibs),
rise AS (SELECT doc_id, 0 AS lvl, subs.i, subs.n AS w, h, sibs FROM fold JOIN subs ON subs.source IS NOT DISTINCT FROM fold.source WHERE w = 1
         UNION ALL SELECT doc_id, f.lvl + 1, f.i // 3, (f.w + 2) // 3, sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)), f.sibs || coalesce(string_agg(CASE WHEN u.i <> f.i THEN u.h END, '' ORDER BY u.i), '')
         FROM rise f JOIN top u ON u.lvl = f.lvl AND u.i // 3 = f.i // 3 WHERE f.w > 1 GROUP BY doc_id, f.lvl, f.i, f.w, f.h, f.sibs)
SELECT leaves.doc_id, leaf, subroot, top.h AS root, sha256(sibs) AS proof_sha256, rise.h AS folded_root, rise.h = top.h AS verified
FROM leaves JOIN subs ON subs.source IS NOT DISTINCT FROM leaves.source JOIN top ON top.w = 1 JOIN rise ON rise.w = 1 AND rise.doc_id = leaves.doc_id
"""
