"""Importance resampling of documents towards a target's distribution, over hashed n-grams.

Features (runs of words) fall into BUCKETS by crc32. Two passes over Arrow batches: the first counts buckets by
np.bincount, one vector a task, and treeReduce adds the vectors up, so the driver gets a few however many tasks
there are. The logarithm of target over raw frequency is a bucket's gain, in thousandths, rounded down. The second
pass gathers the gains (a broadcast vector of BUCKETS) and sums each document's with bincount weights. Gumbel noise
from a hash of the id makes the highest scores a weighted draw without replacement.

The draw sorts ids and scores over ranges; what a range holds before it comes from the number of rows in each
range, which is all that the driver collects. So no task holds more than its range.

* A null text has no words; a document without a feature has weight 0. Texts are read whole, long words too.
* Ties of scores go to the lesser id, null last; rows that repeat an id and a text get ranks next to each other.
* A null id is hashed as an empty one. Without target texts all gains follow from the raw counts alone.
* An empty table gives an empty result. Only id and text are read, so other columns may have any name; `resample`
  returns all columns unchanged.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import textnum as T
from colloquy.llm.scratch import bound_batches, cut

BUCKETS = 10_000
SEED = 2024
#: Levels of the tree that adds vectors up.
DEPTH = 3
#: Words beyond so many bytes are hashed one by one.
LONG = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1)).astype(np.uint32)
    return table


_TABLE = _crc_table()


def crc_on(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 values, each carried on over the bytes of its span; a value of 0 begins anew."""
    order = np.argsort(starts - ends, kind="stable")  # longest first
    first, size = starts[order], (ends - starts)[order]
    out = ~state[order]
    n_long = int(np.searchsorted(-size, -LONG))
    for k in range(int(size[n_long]) if n_long < len(size) else 0):
        n = int(np.searchsorted(-size, -k))
        now = out[n_long:n]
        out[n_long:n] = _TABLE[(now ^ data[first[n_long:n] + k]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    for k in range(n_long):
        out[k] = ~np.uint32(zlib.crc32(data[first[k] : first[k] + size[k]].tobytes(), int(~out[k])))
    back = np.empty_like(out)
    back[order] = ~out
    return back


@dataclass(frozen=True)
class Features:
    """Runs of `least` to `most` consecutive words (letters, digits, all beyond ASCII; A-Z in lower case), joined by one space."""

    least: int = 1
    most: int = 1
    buckets: int = BUCKETS

    def of(self, part: T.Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length the bucket and the text of each run."""
        starts, ends, text = part.spans(T.ALNUM)
        data, space = _LOWER[part.buf], np.full(1, 32, np.uint8)
        state = np.zeros(len(starts), np.uint32)
        for n in range(1, self.most + 1):
            if n > 1:  # one more word, where the run stays inside its text
                same = T.whole(text, n)
                state, zeros = state[: len(same)], np.zeros(len(same), np.int64)
                state = crc_on(state, space, zeros, zeros + 1)
            last = slice(n - 1, None)
            state = crc_on(state, data, starts[last], ends[last])
            if n >= self.least:
                keep = T.whole(text, n)
                yield (state[keep] % np.uint32(self.buckets)).astype(np.int64), text[: len(keep)][keep]


def counts(docs: DataFrame, how: Features = Features(), *, text_col: str = "text") -> np.ndarray:
    """How many features fall into each bucket, over all texts."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(how.buckets, np.int64)
        for batch in batches:
            for part in T.slices(batch.column(0)):
                for bucket, _ in how.of(part):
                    total += np.bincount(bucket, minlength=how.buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["counts"])

    vectors = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "counts binary").rdd.map(lambda row: np.frombuffer(row[0], np.int64))
    return vectors.treeReduce(np.add, DEPTH) if vectors.getNumPartitions() else np.zeros(how.buckets, np.int64)


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of smoothed frequencies, in thousandths, rounded down."""
    n, all_target, all_raw = len(raw), int(target.sum()), int(raw.sum())
    ratio = lambda t, s: (t + 1) * (all_raw + n) / ((s + 1) * (all_target + n))
    return np.array([math.floor(1000 * math.log(ratio(t, s))) for t, s in zip(target.tolist(), raw.tolist())], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, how: Features = Features(), *, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_features, n_words, weight, score."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # of how.buckets numbers

    def make():
        def work(part: T.Slice, batch: pa.RecordBatch) -> dict:
            sums, n = np.zeros(part.n, np.int64), np.zeros(part.n, np.int64)
            for bucket, text in how.of(part):
                n += part.per_text(text)
                sums += part.per_text(text, shared.value[bucket].astype(float))
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            ids = batch.column(0).slice(part.lo, part.n).to_pylist()
            return {"n_features": n, "n_words": part.per_text(part.spans(T.ALNUM)[2]), "weight": weight, "score": weight + np.array([noise(x, seed) for x in ids], np.int64)}

        return work

    return T.map_texts(docs, id_col, text_col, "n_features bigint, n_words bigint, weight bigint, score bigint", make)


def draw(weighed: DataFrame, *, percent: int = 10, least_words: int = 20) -> DataFrame:
    """weighed with `rank`: 1, 2, 3 for the highest scores of documents with enough words, as many as percent of these; else null."""
    spark = weighed.sparkSession
    weighed = cut(weighed, "weighed")
    fit = F.col("n_words") >= least_words
    ordered = weighed.filter(fit).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    ordered = cut(ordered.select("*", F.shiftright(at, 33).alias("range"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "ordered")
    ranges = sorted(ordered.groupBy("range").count().collect())  # a row for each range
    before = np.cumsum([0, *(r["count"] for r in ranges)]).tolist()
    offsets = spark.createDataFrame([(r["range"], b) for r, b in zip(ranges, before)], "range bigint, before bigint")
    rank = F.col("before") + F.col("place") + 1
    ranked = ordered.join(F.broadcast(offsets), "range").withColumn("rank", F.when(rank <= percent * before[-1] // 100, rank))
    names = weighed.columns
    return ranked.select(*names, "rank").unionByName(weighed.filter(~fit).select(*names, F.lit(None).cast("bigint").alias("rank")))


def assign(docs: DataFrame, target: DataFrame, how: Features = Features(), *, percent: int = 10, least_words: int = 20, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_features, n_words, weight, score, rank."""
    gain = gains(counts(target, how, text_col=target_text_col), counts(docs, how, text_col=text_col))
    return draw(weigh(docs, gain, how, seed=seed, id_col=id_col, text_col=text_col), percent=percent, least_words=least_words)


def resample(docs: DataFrame, target: DataFrame, how: Features = Features(), *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that are drawn, with all their columns; rows that share a drawn id all stay."""
    drawn = assign(docs, target, how, id_col=id_col, **options).filter("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(drawn, docs[id_col].eqNullSafe(drawn["__drawn"]), "left_semi")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
raw AS (SELECT doc_id, unnest(ws) AS word FROM w),
wanted AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
words AS (SELECT word, sum(s) AS s, sum(t) AS t FROM (SELECT word, 1 AS s, 0 AS t FROM raw UNION ALL SELECT word, 0, 1 FROM wanted) GROUP BY word),
coded AS (SELECT *, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(word) + 1), lambda k: ('0x' || substr(hex(encode(word)), 2 * k - 1, 2))::BIGINT),
          lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 10000 AS bucket FROM words),
buckets AS (SELECT bucket, sum(s) AS s, sum(t) AS t, (SELECT sum(s) FROM words) AS all_s, (SELECT sum(t) FROM words) AS all_t FROM coded GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::DOUBLE / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain FROM buckets),
summed AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM raw JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
weighed AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total / n), 0)::BIGINT AS weight,
            coalesce(floor(total / n), 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM w LEFT JOIN summed USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM weighed)
SELECT doc_id, n_features, n_features AS n_words, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
