"""Exact dedup, in DataFrame operations alone.

Texts are equal when identical after their ASCII white space is deleted. Of equal texts the one with the
most code points stays, then the smallest id (null last), then any one of identical rows.

Copies meet in three stages, each of which groups by the whole content and not only by its digest: within
each task (the partial aggregate), then by digest and salt, then over the salts. The salt is 0 for digests
of few rows, which so have nothing to combine in the last stage. The others (at least LEAST_HOT rows, and
one row in HOT_PARTS) are HOT_PARTS at most, and only their list is broadcast.

* Null texts count as empty, so they equal each other and texts of white space alone.
* Two contents with the same digests (none are known) are told apart: other digests are taken then.
* Very long texts are compared whole. An empty table gives an empty result.
* `drop_copies` keeps all columns of df; its own names can't clash, as the row travels as one struct.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.scratch import cut, drop

SPACE = r"[\x20\x09-\x0D]+"
HOT_PARTS = 10_000
LEAST_HOT = 500
SALTS = 64


def second_digest(body: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), body)


def _texts(docs: DataFrame, id_col: str, text_col: str, seed: int = 0) -> DataFrame:
    """Of each row: id, code points, the text without white space, its digests; `row` is the row itself."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).cast("bigint").alias("n_cp"), F.regexp_replace(text, SPACE, "").alias("body"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return named.withColumns({"digest": first_digest(F.col("body")), "xx": second_digest(F.col("body"), seed)})


def first_digest(body: Column) -> Column:
    return F.sha2(body, 256)


def _signatures(texts: DataFrame) -> DataFrame:
    return cut(texts.select("doc_id", "n_cp", "digest", "xx", F.monotonically_increasing_id().alias("row_id")), "signatures")


def _hot(signatures: DataFrame) -> DataFrame:
    """At most HOT_PARTS digests: those with the most copies."""
    rows = signatures.count()
    return signatures.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(LEAST_HOT, rows // HOT_PARTS)).select("digest", F.lit(True).alias("hot"))


def _contents(texts: DataFrame, hot: DataFrame, best: Column | None = None) -> DataFrame:
    """One row a content: digest, xx, n rows, and the first of (-n_cp, null id, id); `best` is taken from that row."""
    order = F.struct((-F.col("n_cp")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))
    chosen = [F.min_by("best", "first").alias("best")] if best is not None else []

    def merged(rows: DataFrame, n: Column, *more: str) -> DataFrame:
        return rows.groupBy("digest", "xx", "body", *more).agg(F.sum(n).alias("n"), F.min("first").alias("first"), *chosen)

    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("doc_id", "n_cp"), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    rows = texts.join(F.broadcast(hot), "digest", "left").select("digest", "xx", "body", order.alias("first"), salt.alias("salt"), *([best.alias("best")] if best is not None else []))
    salted = merged(rows, F.lit(1), "salt")
    # what wasn't salted is whole, and its content isn't needed any more
    salted = cut(salted.withColumn("body", F.when(F.col("salt") > 0, F.col("body"))), "salted")
    return salted.filter("salt = 0").drop("salt", "body").unionByName(merged(salted.filter("salt > 0"), F.col("n")).drop("body"))


def assign(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    for seed in itertools.count():
        texts = _texts(docs, id_col, text_col, seed)
        signatures = _signatures(texts)
        hot = cut(_hot(signatures), "hot")
        groups = _contents(texts.drop("row"), hot).groupBy("digest", "xx").agg(F.sum("n").alias("group_size"), F.min("first").alias("first"), F.count(F.lit(1)).alias("contents"))
        if groups.filter("contents > 1").isEmpty():
            break
        drop(signatures, hot)
    groups = groups.select("digest", "xx", "group_size", (-F.col("first.less")).alias("n_cp"), F.col("first.doc_id").alias("keep_id"))
    # of rows that agree in id and length, one stays
    rows = signatures.groupBy("digest", "xx", "n_cp", "doc_id").agg(F.min("row_id").alias("keep_row"))
    same = [rows[c] == groups[c] for c in ("digest", "xx", "n_cp")] + [rows["doc_id"].eqNullSafe(groups["keep_id"])]
    groups = groups.join(rows, same).select(groups["digest"], groups["xx"], "keep_id", "group_size", "keep_row")
    # a hot group's row is copied to every salt, so that its members meet it in many tasks
    spread = groups.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot")
    members = signatures.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("row_id"), F.lit(SALTS))).otherwise(0)).drop("hot")
    return members.join(spread, ["digest", "xx", "salt"]).select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one of each content, with all their columns."""
    texts = _texts(docs, id_col, text_col)
    signatures = _signatures(texts)
    hot = cut(_hot(signatures), "hot")
    drop(signatures)
    kept = _contents(texts, hot, F.col("row"))
    return kept.select(*[F.col("best").getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM d WINDOW best AS (PARTITION BY body ORDER BY n_cp DESC, doc_id)
"""
