"""Keyed tables in one folder: merges that write only what changed, several writers, older versions, unique keys.

A version of the folder is a file that names, for every table and part, the runs that hold its rows. A part is the keys
of one hash bucket. Nothing that was written is written again: a merge finds its keys' runs in the index, reads only
those, and adds a run of the new rows, an index of their keys, and the places of the rows that these replace (`dead`),
which a read leaves out by an anti join. So what a merge writes follows its source, whatever the table's size.
`compact` rewrites the parts of which many rows are dead or which have many runs.

A transaction reads one version and ends in creating the next one, which only one writer can. Who finds it taken looks
at the versions in between: if these touched none of its parts, its changes go on top of them; else it fails with
Conflict and can be run again. Changes of several tables in one transaction are seen together or not at all, and a
transaction that carries a stream's batch isn't run twice.

* Keys are compared by value; a null key matches nothing and is inserted. Rows of any schema: columns that a source
  lacks are null, those that the table lacks are added, and no column is ever lost.
* Two hashes of 64 bits that collide only make a merge read more: rows are told apart by their keys.
* An empty source changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from colloquy.operators.dedup import latest_wins, violations
from colloquy.operators.merge import merge
from colloquy.sources import files

BUCKETS = 16
#: Up to so many hashes go to the index as a list, which Parquet's own ranges answer, and for a few its Bloom filters.
LISTED = 1000
#: A part is compacted beyond so many runs, or this share of dead rows if these are so many.
RUNS, DEAD, LEAST_DEAD = 16, 0.5, 10_000
DRAFTS, VERSIONS = "drafts", "versions"
INDEX_ROWS, DEAD_ROWS = StructType().add("h", LongType()), StructType().add("h", LongType()).add("of", StringType())


class Conflict(Exception):
    """Another writer changed a part that this transaction has read."""


class Refused(Exception):
    """An append that would give a unique key a second row."""


class Folder:
    """The tables of a folder, by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        return [int(n) for n in files.names(self.spark, f"{self.path}/{VERSIONS}") if n.isdigit()]

    def held(self, version: int) -> dict | None:
        """What a version holds; None for one that its writer died over."""
        draft = files.get(self.spark, f"{self.path}/{VERSIONS}/{version:012d}")
        return json.loads(files.get(self.spark, f"{self.path}/{DRAFTS}/{draft}")) if draft else None

    def state(self, version: int | None = None) -> tuple[int, dict]:
        """A version, the newest if none is given, and what it holds."""
        for k in reversed(self.versions()) if version is None else [version]:
            if (found := self.held(k)) is not None:
                return k, found
        return 0, {"tables": {}, "batches": {}, "touched": []}

    def begin(self) -> Transaction:
        return Transaction(self)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return Transaction(self, version).read(name)

    def clean(self, keep: int = 2) -> None:
        """Removes all versions but the last `keep`, and what only they held. Nothing may be reading or writing those."""
        known = self.versions()
        for k in known[:-keep]:
            files.delete(self.spark, f"{self.path}/{VERSIONS}/{k:012d}")
        states = [s for s in map(self.held, known[-keep:]) if s is not None]
        held = {run for s in states for t in s["tables"].values() for part in t["parts"].values() for run in [*part["runs"], *part["dead"]]}
        for name in {t for s in states for t in s["tables"]}:
            for kind in ("rows", "index", "dead"):
                for found in files.names(self.spark, f"{self.path}/{name}/{kind}"):
                    if found.startswith("__run=") and found.removeprefix("__run=") not in held:
                        files.delete(self.spark, f"{self.path}/{name}/{kind}/{found}")


class Transaction:
    """Changes on top of one version. Nothing is seen before `commit`."""

    def __init__(self, folder: Folder, version: int | None = None):
        self.folder, self.spark = folder, folder.spark
        self.base, self.state = folder.state(version)
        self.changed: set[str] = set()
        self.touched: set[tuple[str, str]] = set()
        self.staged = f"{folder.path}/staged/{uuid.uuid4().hex}"
        self.written = 0  # rows of data

    # --- reading

    def _table(self, name: str) -> dict:
        return self.state["tables"][name]

    def _change(self, name: str, **table) -> None:
        now = self.state["tables"].get(name, {}) | table
        self.state = self.state | {"tables": self.state["tables"] | {name: now}}
        self.changed.add(name)

    def _load(self, name: str, kind: str, held: dict[str, list[str]], schema: StructType) -> DataFrame | None:
        """The runs of some parts, with __run and __bucket; None if there are none."""
        at, parts = f"{self.folder.path}/{name}/{kind}", {}
        for b, runs in held.items():
            for run in runs:
                parts.setdefault(run, []).append(int(b))
        if not parts:
            return None
        whole = StructType([*schema.fields]).add("__run", StringType()).add("__bucket", IntegerType())
        alike: dict[tuple[int, ...], list[str]] = {}
        for run, buckets in parts.items():
            alike.setdefault(tuple(sorted(buckets)), []).append(run)
        # (both are partition columns, so files of other parts aren't read)
        wanted = reduce(or_, [F.col("__run").isin(runs) & F.col("__bucket").isin([*buckets]) for buckets, runs in alike.items()])
        return self.spark.read.schema(whole).option("basePath", at).parquet(*[f"{at}/__run={run}" for run in parts]).filter(wanted)

    def _dead(self, name: str, buckets: Iterable[str]) -> DataFrame | None:
        parts = self._table(name)["parts"]
        found = self._load(name, "dead", {b: parts[b]["dead"] for b in buckets}, DEAD_ROWS)
        return None if found is None else found.select(F.col("h").alias("__gone"), F.col("of").alias("__of"))

    def _alive(self, name: str, held: dict[str, list[str]]) -> DataFrame | None:
        """Rows of some runs that no later run replaced, with __run and __bucket."""
        table = self._table(name)
        rows = self._load(name, "rows", held, StructType.fromJson(table["schema"]))
        dead = None if rows is None else self._dead(name, held)
        return rows if dead is None else rows.join(dead, (_hash(table["key"]) == F.col("__gone")) & (F.col("__run") == F.col("__of")), "left_anti")

    def read(self, name: str) -> DataFrame:
        table = self._table(name)
        schema = StructType.fromJson(table["schema"])
        rows = self._alive(name, {b: part["runs"] for b, part in table["parts"].items()})
        return self.spark.createDataFrame([], schema) if rows is None else rows.select(*map(_quoted, schema.names))

    def _matched(self, name: str, keys: DataFrame, buckets: Iterable[str]) -> DataFrame | None:
        """Rows with one of the keys (a column of the key's name), with __run and __bucket; reads the parts' index and the
        runs that it names. `dying` has how many there are in each part."""
        table, self.dying = self._table(name), {}
        held = {b: table["parts"][b]["runs"] for b in buckets if b in table["parts"]}
        index = self._load(name, "index", held, INDEX_ROWS)
        if index is None:
            return None
        wanted = keys.filter(_quoted(table["key"]).isNotNull()).select(_quoted(table["key"]).alias("__wanted")).distinct()
        hashes = wanted.select(F.xxhash64("__wanted").alias("h")).distinct()
        few = hashes.limit(LISTED + 1).collect()
        hits = index.filter(F.col("h").isin([r.h for r in few])) if len(few) <= LISTED else index.join(hashes, "h", "left_semi")
        if (dead := self._dead(name, held)) is not None:
            hits = hits.join(dead, (F.col("h") == F.col("__gone")) & (F.col("__run") == F.col("__of")), "left_anti")
        runs: dict[str, list[str]] = {}
        for r in hits.groupBy("__bucket", "__run").count().collect():  # at most the touched parts' runs
            runs.setdefault(str(r[0]), []).append(r[1])
            self.dying[str(r[0])] = self.dying.get(str(r[0]), 0) + r[2]
        rows = self._alive(name, runs) if runs else None
        return None if rows is None else rows.join(wanted, _quoted(table["key"]) == F.col("__wanted"), "left_semi")

    # --- changes

    def create(self, name: str, key: str, schema: StructType, buckets: int = BUCKETS) -> None:
        if name not in self.state["tables"]:
            self._change(name, key=key, buckets=buckets, schema=schema.jsonValue(), parts={})

    def _stage(self, rows: DataFrame) -> DataFrame:
        """rows, written and read back, so that they are worked out once; gone with the commit."""
        path = f"{self.staged}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _taken(self, name: str, rows: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """rows, staged, and how many fall into each part; the table has their columns from now on."""
        table = self._table(name)
        kept = self._stage(rows)
        sizes = {str(r[0]): r[1] for r in kept.groupBy(_bucket(table).alias("b")).count().collect()}
        self.touched |= {(name, b) for b in sizes}
        self._change(name, schema=_wider(table["schema"], rows.schema.jsonValue()))
        return kept, sizes

    def _add(self, name: str, rows: DataFrame | None, sizes: dict[str, int], keys: DataFrame, dead: DataFrame | None) -> None:
        """A run of rows, so many in each part, with the index of their keys, and the places of the rows (with __run and
        __bucket) that are dead now."""
        table, run = self._table(name), uuid.uuid4().hex
        parts = dict(table["parts"])
        at = lambda kind: f"{self.folder.path}/{name}/{kind}/__run={run}"
        h, bucket = _hash(table["key"]).alias("h"), _bucket(table).alias("__bucket")

        def note(which: str, n: str, counts: dict[str, int]) -> None:
            for b, k in counts.items():
                old = parts.get(b, {"runs": [], "dead": [], "n": 0, "n_dead": 0})
                parts[b] = old | {which: [*old[which], run], n: old[n] + k}

        if rows is not None and sizes:
            rows.withColumn("__bucket", bucket).repartition("__bucket").write.partitionBy("__bucket").parquet(at("rows"))
            index = keys.select(h, bucket).repartition("__bucket").sortWithinPartitions("__bucket", "h")
            index.write.options(**{"parquet.bloom.filter.enabled#h": "true", "parquet.bloom.filter.adaptive.enabled": "true"}).partitionBy("__bucket").parquet(at("index"))
            note("runs", "n", sizes)
            self.written += sum(sizes.values())
        if dead is not None:
            dead.select(h, F.col("__run").alias("of"), "__bucket").repartition("__bucket").write.partitionBy("__bucket").parquet(at("dead"))
            note("dead", "n_dead", self.dying)
        self._change(name, parts=parts)

    def merge(self, name: str, source: DataFrame, *, set_: Iterable[str] = (), coalesce: Iterable[str] = (), insert_only: Iterable[str] = ()) -> None:
        """`operators.merge.merge` on the table: reads the runs that hold a key of source, writes one of source's rows."""
        kept, sizes = self._taken(name, source)
        if not sizes:
            return
        table = self._table(name)
        schema = StructType.fromJson(table["schema"])
        old = self._matched(name, kept, sizes)
        target = self.spark.createDataFrame([], schema) if old is None else old.select(*map(_quoted, schema.names))
        made = merge(target, kept, table["key"], set_=set_, coalesce=coalesce, insert_only=insert_only)
        # (the filter also works out `_op`, which refuses keys that match twice)
        self._add(name, made.filter("_op != 'keep'").drop("_op"), sizes, kept, old)

    def upsert(self, name: str, source: DataFrame, order: list[str] | None = None) -> None:
        """Rows of source in place of those with the same keys, whose other columns stay. With `order`, the latest row of
        each key stays, whole, be it in source or in the table."""
        key = self._table(name)["key"]
        if order is None:
            self.merge(name, source, set_=[c for c in source.columns if c != key])
            return
        kept, sizes = self._taken(name, source)
        if not sizes:
            return
        names = StructType.fromJson(self._table(name)["schema"]).names
        old = self._matched(name, kept, sizes)
        both = kept if old is None else old.select(*map(_quoted, names)).unionByName(kept, allowMissingColumns=True)
        latest = latest_wins(both.select(*[_quoted(c) if c in both.columns else F.lit(None).alias(c) for c in names]), [key], order)
        self._add(name, latest, sizes, kept.select(_quoted(key)).distinct(), old)

    def delete(self, name: str, keys: DataFrame) -> None:
        """Rows whose key is in the one column of keys are dead; nothing is rewritten."""
        kept, sizes = self._taken(name, keys.toDF(self._table(name)["key"]))
        if sizes and (old := self._matched(name, kept, sizes)) is not None:
            self._add(name, None, {}, kept, old)

    def append_unique(self, name: str, rows: DataFrame) -> None:
        """Adds rows, or none of them: Refused if a key is in the table already, or twice in rows. Reads only the index,
        and, for hashes that are there, the rows."""
        kept, sizes = self._taken(name, rows)
        key = self._table(name)["key"]
        if not sizes:
            return
        if twice := violations(kept.filter(_quoted(key).isNotNull()), key).limit(3).collect():
            raise Refused(f"{name}: keys given twice, such as {[r[0] for r in twice]}")
        known = self._matched(name, kept, sizes)
        if known is not None and (there := known.select(_quoted(key)).limit(3).collect()):
            raise Refused(f"{name}: keys that are there already, such as {[r[0] for r in there]}")
        self._add(name, kept, sizes, kept, None)

    def compact(self, name: str, runs: int = RUNS, dead: float = DEAD) -> list[str]:
        """Rewrites the parts that have more runs, or a greater share of dead rows; gives these parts."""
        parts = self._table(name)["parts"]
        wanted = [b for b, p in parts.items() if len(p["runs"]) > runs or p["n_dead"] > max(dead * p["n"], LEAST_DEAD)]
        if wanted:
            alive = self._alive(name, {b: parts[b]["runs"] for b in wanted}).drop("__run", "__bucket")
            self._change(name, parts={b: p for b, p in parts.items() if b not in wanted})
            rows, sizes = self._taken(name, alive)
            self.touched |= {(name, b) for b in wanted}
            self._add(name, rows, sizes, rows, None)
        return wanted

    # --- the end

    def has(self, stream: str, batch: int) -> bool:
        """Whether a stream's batch is in this version already."""
        return self.state["batches"].get(stream, -1) >= batch

    def commit(self, batch: tuple[str, int] | None = None) -> int:
        """Makes the next version, on top of those that others made meanwhile; Conflict if they touched the same parts.
        A batch (stream, number) that another has committed is left at that."""
        spark, path = self.spark, self.folder.path
        draft = uuid.uuid4().hex
        while True:
            now, newest = self.folder.state()
            if batch and newest["batches"].get(batch[0], -1) >= batch[1]:
                return now
            known = self.folder.versions()
            for k in (v for v in known if self.base < v <= now):
                if both := {tuple(x) for x in (self.folder.held(k) or {"touched": []})["touched"]} & self.touched:
                    raise Conflict(f"version {k} changed {sorted(both)}")
            tables = dict(newest["tables"])
            for name in self.changed:
                mine, other, own = self._table(name), tables.get(name), {b for t, b in self.touched if t == name}
                if other is not None:
                    parts = {b: p for b, p in other["parts"].items() if b not in own} | {b: p for b, p in mine["parts"].items() if b in own}
                    mine = other | {"schema": _wider(other["schema"], mine["schema"]), "parts": parts}
                tables[name] = mine
            state = {"tables": tables, "batches": newest["batches"] | ({batch[0]: batch[1]} if batch else {}), "touched": sorted(self.touched)}
            files.put(spark, f"{path}/{DRAFTS}/{draft}", json.dumps(state))
            last = max(known, default=0)
            if files.create(spark, f"{path}/{VERSIONS}/{last + 1:012d}", draft):
                files.delete(spark, self.staged)
                return last + 1


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def _hash(key: str) -> Column:
    return F.xxhash64(_quoted(key))


def _bucket(table: dict) -> Column:
    return F.pmod(_hash(table["key"]), F.lit(table["buckets"])).cast("int")


def _wider(schema: dict, other: dict) -> dict:
    """A schema with the columns that only the other has, which rows before have as null."""
    names = {f["name"] for f in schema["fields"]}
    return schema | {"fields": [*schema["fields"], *(f for f in other["fields"] if f["name"] not in names)]}
