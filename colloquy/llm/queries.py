"""The queries opN_<name>, and their SQL where SQL can express them."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import chat, exact, importance, langid, licenses, lm, manifest, mixing, neardup, packing, passages, pieces, quality


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.plan(documents(spark, sf_dir), mixing.cycle((3, 1, 2)), budget=1.5, most=2.0))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.assign(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(documents(spark, sf_dir), window=50)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    probe = json.dumps({"messages": [{"role": r, "content": said} for r in ("user", "assistant")]})
    record = spark.range(1).selectExpr("CAST(-1 AS BIGINT) AS conv_id").withColumn("record", F.lit(probe))
    return chat.digests(chat.render(chat.from_table(table).unionByName(chat.from_json(record, "record").drop("layout"))))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = langid.held_out("doc_id", 10)
    model = lm.train(docs.filter(~held_out), cutoffs=(1, 1, 1))
    train_tokens = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return lm.score(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", train_tokens, "base_score", "score")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.assign(documents(spark, sf_dir), neardup.Similar(words=2, percent=80))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.filter(~langid.held_out("doc_id", 5)), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model).select("doc_id", langid.held_out("doc_id", 5).alias("held_out"), "lang_pred", "score")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = documents(spark, sf_dir).select(*fields)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    seen = manifest.leaf(*[F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text")) if c == "text" else F.col(c) for c in fields])
    found = manifest.folded(manifest.build(docs, fields, group_col="source", order_col="doc_id", along={"seen": seen}), "seen")
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.assign(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mixing, op2_exact_dedup, op3_substring_dedup, op4_chat_format, op5_sentencepiece, op6_lm_scoring, op7_license_scan, op8_near_dedup, op9_language_id, op10_quality_rules, op11_packing, op12_merkle_manifest, op13_importance_resampling)}
ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": exact.ORACLE, "op3_substring_dedup": passages.ORACLE, "op4_chat_format": chat.ORACLE, "op8_near_dedup": neardup.ORACLE, "op12_merkle_manifest": manifest.ORACLE, "op13_importance_resampling": importance.ORACLE}
