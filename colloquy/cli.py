"""Command line: ingest, score, compare, upload, merge, dedupe, migrate, report."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import Config
from colloquy.operators import clients, completion, dedup, merge, reports, sinks, talent
from colloquy.schemas import MAPPINGS, MEETING_INTEL, SALES_CRITERIA, TRANSCRIPT
from colloquy.session import session
from colloquy.sources import transcripts


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser("colloquy")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("ingest", help="text files to transcript rows")
    p.add_argument("input"), p.add_argument("output"), p.add_argument("--rejects"), p.add_argument("--default-date")
    p = commands.add_parser("merge", help="scored rows into the fact table")
    p.add_argument("table"), p.add_argument("rows"), p.add_argument("--domain", choices=("client", "talent"), required=True)
    p = commands.add_parser("score", help="transcripts to scored rows, from recorded answers")
    p.add_argument("transcripts"), p.add_argument("answers", help="JSON object of answers by prompt"), p.add_argument("output")
    p.add_argument("--domain", choices=("client", "talent"), default="client"), p.add_argument("--fallback", help="answers of the model to fall back on")
    p = commands.add_parser("compare-models", help="the same transcripts by several models' recorded answers")
    p.add_argument("transcripts"), p.add_argument("models", nargs="+", help="NAME=answers.json"), p.add_argument("--limit", type=int, default=3)
    p = commands.add_parser("upload", help="rows into a table")
    p.add_argument("rows"), p.add_argument("table"), p.add_argument("--disposition", choices=("append", "truncate", "empty"), default="append")
    p = commands.add_parser("dedupe", help="the latest row of each key")
    p.add_argument("table"), p.add_argument("--key", default="meeting_id"), p.add_argument("--order", default="scored_at")
    p = commands.add_parser("migrate", help="adds the columns that the fact table lacks")
    p.add_argument("table"), p.add_argument("--apply", action="store_true")
    p = commands.add_parser("sales-status", help="assessments by person over the last days")
    p.add_argument("table"), p.add_argument("--as-of", required=True), p.add_argument("--days", type=int, default=7)
    p = commands.add_parser("report", help="distribution of a column as markdown")
    p.add_argument("table"), p.add_argument("column")
    return parser


def _ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    date = F.lit(args.default_date).cast("date") if args.default_date else None
    rows = transcripts.parse(transcripts.scan(spark, args.input), date)
    good, bad = rows.filter("reject IS NULL").drop("reject"), rows.filter("reject IS NOT NULL")
    good.write.mode("overwrite").parquet(args.output)
    if args.rejects:
        bad.write.mode("overwrite").parquet(args.rejects)
    found, refused = spark.read.parquet(args.output).count(), bad.count()
    print(f"{found} transcripts, {refused} rejected")
    return int(not found)


def _recorded(path: str):
    with open(path) as file:
        answers = json.load(file)
    return lambda: completion.Recorded(answers)


def _read(spark: SparkSession, path: str, domain: str) -> DataFrame:
    """Transcripts with `context`: what a completer is given of each."""
    text = clients.client_text if domain == "client" else clients.talent_text
    rows = merge.add_columns(spark.read.parquet(path), TRANSCRIPT)
    return rows.withColumn("context", text(F.col("enhanced_notes"), F.col("full_transcript"), F.col("notes")))


def _score(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    config, make = Config.from_env(), _recorded(args.answers)
    fallback = _recorded(args.fallback) if args.fallback else None
    rows = _read(spark, args.transcripts, args.domain)
    if args.domain == "talent":
        asked = completion.ask(rows, {"talent_extraction": "talent_extraction"}, "context", make, config, fallback=fallback)
        answered = asked.withColumn("answer", completion.strip_fence(F.try_element_at("raw", F.lit("talent_extraction")))).drop("raw", "context")
        scored = talent.score(answered, "answer", spark.createDataFrame([], MAPPINGS), config)
        return talent.narrative(scored, "talent_narrative", make, config).drop("answer")
    prompts = {s: s for s in (*completion.SECTIONS, "taxonomy")} | ({f"sales_{c}": f"sales_{c}" for c in SALES_CRITERIA} if config.enable_sales_scoring else {})
    raw = completion.ask(rows, prompts, "context", make, config, fallback=fallback)
    scored = completion.taxonomy(completion.opportunity(raw, config))
    scored = completion.sales(scored, config) if config.enable_sales_scoring else scored
    return scored.drop("raw", "context")


def _compare(spark: SparkSession, args: argparse.Namespace) -> str:
    makers = {name: _recorded(path) for name, _, path in (m.partition("=") for m in args.models)}
    if len(makers) < 2:
        raise SystemExit("at least two models are compared")
    rows = _read(spark, args.transcripts, "client").orderBy("meeting_id").limit(args.limit)
    scores = completion.compare(rows, "meeting_id", {s: s for s in completion.SECTIONS}, "context", makers, Config.from_env())
    return sinks.markdown(reports.compare_models(scores).orderBy("model"), "Models")


def _sales_status(spark: SparkSession, args: argparse.Namespace) -> str:
    rows = spark.read.parquet(args.table).filter(F.col("sales_total_score").isNotNull() & reports.since("date", args.as_of, args.days))
    people = reports.summary(rows, ["salesperson_name"], "sales_total_score", F.col("sales_qualified"))
    return sinks.markdown(people.orderBy(F.desc("avg_score"), "salesperson_name"), f"Sales assessments, {args.days} days to {args.as_of}")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = session()
    if args.command == "ingest":
        return _ingest(spark, args)
    if args.command == "score":
        _score(spark, args).write.mode("overwrite").parquet(args.output)
    elif args.command == "compare-models":
        print(_compare(spark, args))
    elif args.command == "sales-status":
        print(_sales_status(spark, args))
    elif args.command == "upload":
        sinks.write(spark.read.parquet(args.rows), args.table, args.disposition)
    elif args.command == "merge":
        target = merge.add_columns(spark.read.parquet(args.table), MEETING_INTEL)
        merged = merge.merge_by_domain(target, spark.read.schema(MEETING_INTEL).parquet(args.rows), args.domain)
        sinks.replace_table(merged.drop("_op"), args.table)
    elif args.command == "dedupe":
        table = spark.read.parquet(args.table)
        table = table.withColumn("__tie", F.xxhash64(*table.columns))
        sinks.replace_table(dedup.latest_wins(table, [args.key], [args.order, "__tie"]).drop("__tie"), args.table)
    elif args.command == "migrate":
        table = spark.read.parquet(args.table)
        lacking = merge.missing_columns(table, MEETING_INTEL)
        print("\n".join(lacking) or "no column is missing")
        if lacking and args.apply:
            sinks.replace_table(merge.add_columns(table, MEETING_INTEL), args.table)
    else:
        print(sinks.markdown(reports.distribution(spark.read.parquet(args.table), args.column).orderBy(F.desc("n"), args.column), args.column))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
