"""The corpus pipeline over `documents`: what the rules keep, one of each copy and near copy, mixed by source, encoded.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last
return the columns of documents. A document that the mix draws twice is two rows from there on.

For every stage: an empty table gives an empty one of the same columns; texts are taken whole, however long; other
columns, whatever their names, go along unchanged. Null texts count as empty; a stage says what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import exact, mixing, neardup, pieces, quality
from colloquy.llm.scratch import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule. Null and empty texts break the one on length; rows that repeat are each judged alone."""
    return quality.keep(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each content: that with the longest text, then the least id, null last; of wholly alike rows any one."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, 0.8 or more).

    Rows with a null id, and those without a word, are in no group and stay; rows that repeat an id are one document."""
    return neardup.keep(docs, neardup.Similar(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, none more than twice. A null source is one of its own, the last in order;
    null ids don't matter, and rows alike in id and text are drawn alike."""
    return mixing.mixed(docs, mixing.plan(docs, mixing.cycle((3, 1, 2)), budget=1.5, most=2.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded texts as digests, one row for each row; a null or empty text has no id."""
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mix sources", mix_sources), ("encode", encode)]
#: Mixing draws by its own hashes and the encoder is no SQL function, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
