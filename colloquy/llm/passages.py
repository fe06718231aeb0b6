"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every window of WINDOW words the least hash of its SEED-word sequences, so
two documents that share a window share its anchor. Documents are joined on anchors. A seed is extended
both ways to its context, all windows it is the anchor of. Occurrences with one context are a class, and
match over all of it; so copies, however many, are extended once. Where an anchor has several contexts,
the classes' representatives are extended window by window, which finds what each class shares with
others. Matches that touch are joined to maximal repeats, and a document loses the words of those that
also stand in a document with a smaller id.

Every step groups by a hash of content with a combining aggregate, so a passage that very many documents
share is no single task's work, and no pairs of documents are made.

* Null or empty texts have no word. Texts are read whole; documents under WINDOW words lose nothing.
* Rows that repeat an id are judged each by its own text: they are no smaller than each other.
* Ties: of equal windows those in the document with the least id stay, all of them.
* Null ids are neither smaller nor greater than any: such rows lose nothing and take nothing.
* Only id and text are read, so other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches, cut, drop

WINDOW = 50
SEED = 25


def winnow(grams: np.ndarray, span: int) -> np.ndarray:
    """For each `span` consecutive values the position of the least, the first of equal ones."""
    best, width = np.arange(len(grams)), 1
    while 2 * width <= span:
        a, b = best[:-width], best[width:]
        best, width = np.where(grams[b] < grams[a], b, a), 2 * width
    if shift := span - width:
        a, b = best[:-shift], best[shift:]
        best = np.where(grams[b] < grams[a], b, a)
    return best


class Seeds:
    """The anchors of a slice of texts, each with the run of windows it is the anchor of."""

    def __init__(self, part: T.Slice, window: int):
        starts, ends, self.text = part.spans(T.NOT_SPACE)
        words = part.hashes(starts, ends)
        self.starts, self.ends = starts, ends
        self.n_words = part.per_text(self.text)
        self.first = np.cumsum(self.n_words) - self.n_words
        at = np.flatnonzero(T.whole(self.text, window))
        if not len(at):
            self.begin = self.count = self.anchor = self.context = np.zeros(0, np.int64)
            return
        grams = T.gram_hashes(words, SEED)
        place = winnow(grams, window - SEED + 1)[at]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        run = np.flatnonzero(new)
        self.begin, self.count = at[run], np.diff(np.append(run, len(at)))
        self.anchor = grams[place[run]].view(np.int64)
        content = T.span_hashes(T.mix64(words), self.begin, self.begin + self.count + window - 1)
        shape = (place[run] - self.begin).astype(T.U64) * T.U64(1 << 20) + self.count.astype(T.U64)
        with np.errstate(over="ignore"):
            self.context = (content ^ T.mix64(shape)).view(np.int64)


def _joined(raw: bytes) -> bytes:
    return b" ".join(raw.split())  # bytes.split() splits at the white space that words leave out


def _scan(window: int):
    def work(part: T.Slice, _) -> dict:
        seeds = Seeds(part, window)
        cuts = np.searchsorted(seeds.begin, np.append(seeds.first, len(seeds.text)))
        anchors = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(seeds.anchor, pa.int64()))
        shas = [hashlib.sha256(_joined(part.buf[a:b].tobytes())).hexdigest() for a, b in zip(part.offs[:-1], part.offs[1:])]
        return {"n_words": seeds.n_words, "whole_sha256": pa.array(shas, pa.string()), "anchors": anchors}

    return lambda: work


def _occurrences(window: int):
    """Rows (doc, text) to a row for each anchor in it: where its run of windows begins, and how many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(1)):
                seeds = Seeds(part, window)
                text = seeds.text[seeds.begin]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(part.lo + text)), pa.array(seeds.anchor, pa.int64()), pa.array(seeds.context, pa.int64()), pa.array((seeds.begin - seeds.first[text]).astype(np.int32)), pa.array(seeds.count.astype(np.int32))],
                    ["doc", "anchor", "context", "begin", "n"],
                )

    return run


def _windows(window: int):
    """Rows (text, contexts in it) to a row for each context's each window: (anchor, context, least, nth, hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column(0)):
                starts, ends, text = part.spans(T.NOT_SPACE)
                hashes = T.gram_hashes(part.hashes(starts, ends), window).view(np.int64)
                n_words = part.per_text(text)
                lists = batch.column(1).slice(part.lo, part.n)
                rows, sizes = lists.flatten(), np.diff(np.asarray(lists.offsets))
                begin, n = np.asarray(rows.field("begin")), np.asarray(rows.field("n")).astype(np.int64)
                begin = begin + np.repeat(np.cumsum(n_words) - n_words, sizes)
                row = np.repeat(np.arange(len(n)), n)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([*(rows.field(c).take(pa.array(row)) for c in ("anchor", "context", "least")), pa.array(nth.astype(np.int32)), pa.array(hashes[begin[row] + nth])], ["anchor", "context", "least", "nth", "window"])

    return run


def _removed(window: int, with_text: bool):
    """Rows (doc, text, ranges of window starts) to what is left of the text: how many words went, and a digest or the text."""

    def left(text: str | None, pairs: pa.StructArray) -> tuple[int, str]:
        words = (text or "").encode().split()
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, np.asarray(pairs.field("first")), 1)
        np.add.at(edges, np.asarray(pairs.field("last")) + window, -1)
        kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
        joined = b" ".join([words[k] for k in kept])
        return len(words) - len(kept), joined.decode() if with_text else hashlib.sha256(joined).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                rows = batch.slice(lo, 128)
                made = [left(text.as_py(), ranges.values) for text, ranges in zip(rows.column(1), rows.column(2))]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([x for _, x in made], pa.string())], ["doc", "n_removed", "left"])

    return run


def _work(docs: DataFrame, window: int, id_col: str, text_col: str, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """What each row holds (doc, n_words, whole_sha256), and of those that lose words `n_removed` and `left` (a text, or its digest)."""
    bound_batches(docs.sparkSession)
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")).alias("doc")
    texts = docs.select(doc, F.col(text_col).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()
    id_type = texts.schema["doc"].dataType["id"].dataType.simpleString()
    scanned = cut(T.map_texts(texts, "doc", "text", "n_words bigint, whole_sha256 string, anchors array<bigint>", _scan(window)).withColumnRenamed("doc_id", "doc"), "scanned")

    # seeds: documents with an anchor that occurs twice or more
    seeds = scanned.select(F.col("doc.key").alias("key"), F.explode("anchors").alias("anchor"))
    # (aggregates are written first: a join of two plain shuffles is one whose hot keys Spark can split)
    shared = cut(seeds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "shared")
    involved = cut(seeds.join(shared, "anchor", "left_semi").select("key").distinct(), "involved")
    near = cut(texts.withColumn("key", F.col("doc.key")).join(involved.hint("merge"), "key", "left_semi").select("doc", "text"), "near")
    drop(shared, involved)

    # classes of one context, with the least document, and where an anchor has several, window by window
    found = cut(near.mapInArrow(_occurrences(window), f"doc {kind}, anchor bigint, context bigint, begin int, n int"), "occurrences")
    classes = cut(found.groupBy("anchor", "context").agg(F.min("doc.id").alias("least"), F.max("doc.id").alias("most"), F.min(F.struct("doc.key", "begin", "n")).alias("where")), "contexts")
    several = cut(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1").select("anchor"), "several")
    chosen = classes.join(several, "anchor", "left_semi").groupBy(F.col("where.key").alias("key")).agg(F.collect_list(F.struct("anchor", "context", "least", "where.begin", "where.n")).alias("contexts"))
    extended = near.withColumn("key", F.col("doc.key")).join(chosen, "key").select("text", "contexts").mapInArrow(_windows(window), f"anchor bigint, context bigint, least {id_type}, nth int, window bigint")
    extended = cut(extended, "extended")
    first = cut(extended.groupBy("anchor", "window").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times"), "first")
    # only windows that a document with a smaller id than the class's own least has
    earlier = extended.join(first, ["anchor", "window"]).filter(F.col("first") < F.col("least")).groupBy("anchor", "context").agg(F.collect_list(F.struct("nth", "first")).alias("earlier"))
    known = cut(classes.filter("least < most").select("anchor", "context", "least").join(earlier, ["anchor", "context"], "full_outer"), "known")
    drop(classes, several, extended, first)

    hits = found.select("doc", "anchor", "context", "begin", "n").join(known, ["anchor", "context"])
    span = lambda a, b: F.struct(a.cast("int").alias("first"), b.cast("int").alias("last"))
    own = F.when(F.col("least") < F.col("doc.id"), F.array(span(F.col("begin"), F.col("begin") + F.col("n") - 1)))
    other = F.transform(F.filter("earlier", lambda w: w["first"] < F.col("doc.id")), lambda w: span(F.col("begin") + w["nth"], F.col("begin") + w["nth"]))
    ranges = hits.select("doc", F.coalesce(own, other).alias("ranges")).filter(F.size("ranges") > 0)
    # identical rows give the same ranges, and are dealt with once
    lost = ranges.groupBy("doc").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    left = near.dropDuplicates(["doc"]).join(lost, "doc").select("doc", "text", "ranges").mapInArrow(_removed(window, with_text), f"doc {kind}, n_removed bigint, left string")
    return scanned.drop("anchors"), left


def digests(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept_sha256."""
    scanned, left = _work(docs, window, id_col, text_col, False)
    met = scanned.join(left.withColumnRenamed("doc", "of"), (F.col("doc.key") == F.col("of.key")) & F.col("doc.id").eqNullSafe(F.col("of.id")), "left")
    return met.select(F.col("doc.id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"), F.coalesce("left", "whole_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all rows and columns, with the repeats taken out of the texts that have any (their words joined by one space)."""
    _, left = _work(docs, window, id_col, text_col, True)
    left = left.select(F.col("doc.id").alias("__left_id"), F.col("doc.key").alias("__left_key"), F.col("left").alias("__left_text"))
    here = (F.xxhash64(docs[id_col], docs[text_col]) == F.col("__left_key")) & docs[id_col].eqNullSafe(F.col("__left_id"))
    met = docs.join(left, here, "left")
    return met.select(*[F.coalesce("__left_text", docs[c]).alias(c) if c == text_col else docs[c] for c in docs.columns])


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS h FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 48)) AS i)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN least USING (h), range(50) AS t(j) WHERE m < doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1),
place AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w WHERE doc_id IN (SELECT doc_id FROM n)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM place ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(CASE WHEN n_removed IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
