"""Writers and renderers of results."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.functions.columns import joined
from colloquy.operators import names
from colloquy.sources import files

#: Reports show so many rows at most: they are pages for people, and are rendered on the driver.
REPORT_ROWS = 100
# Types of files by their endings.
CONTENT_TYPES = {"txt": "text/plain", "md": "text/markdown", "json": "application/json", "csv": "text/csv", "html": "text/html"}


def flat(df: DataFrame) -> DataFrame:
    """Columns as CSV can hold them: null as empty, arrays joined, structs as JSON."""

    def column(f) -> Column:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        text = joined(c.cast("array<string>")) if kind == "array" and f.dataType.elementType.typeName() == "string" else F.to_json(c) if kind in ("struct", "array", "map") else c.cast("string")
        return F.coalesce(text, F.lit("")).alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write(df: DataFrame, path: str, disposition: str = "append") -> None:
    """append, truncate, or empty: an error if the target already has rows."""
    spark = df.sparkSession
    if disposition == "empty" and files.exists(spark, path) and not spark.read.parquet(path).isEmpty():
        raise ValueError(f"{path} has rows")
    df.write.mode({"append": "append", "truncate": "overwrite", "empty": "append"}[disposition]).parquet(path)


def recover_table(spark: SparkSession, path: str) -> None:
    """Puts a table back that a swap was stopped over: the table before, or the next one if that was moved aside already."""
    if not files.exists(spark, path):
        for left in (f"{path}.next", f"{path}.before"):
            if files.exists(spark, f"{left}/_SUCCESS"):
                files.rename(spark, left, path)
                break
    files.delete(spark, f"{path}.before")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Swaps the table at path for df, which may read it: df is written beside it, and the table before stays beside
    the new one until that is in its place."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.next")
    if files.exists(spark, path):
        files.delete(spark, f"{path}.before")
        files.rename(spark, path, f"{path}.before")
    files.rename(spark, f"{path}.next", path)
    files.delete(spark, f"{path}.before")
    return spark.read.parquet(path)


def put_json(spark: SparkSession, path: str, value) -> None:
    files.put(spark, path, json.dumps(value, indent=2, default=str))


def content_type(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.element_at(F.split(name, r"\."), -1))), F.lit("text/plain"))


def legacy_rows(results: DataFrame, transcripts: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Results with their transcripts, flattened for export; with sales results where there are any."""
    rows = results.join(transcripts, "meeting_id")
    return rows if sales is None else rows.join(sales, "meeting_id", "left")


def table_info(spark: SparkSession, path: str) -> dict | None:
    """Rows, columns and bytes of a table, or None if there is none."""
    store, place = files.store(spark, path)
    if not store.exists(place):
        return None
    df = spark.read.parquet(path)
    return {"rows": df.count(), "columns": len(df.columns), "bytes": store.getContentSummary(place).getLength()}


SECTION_NAMES = ("now", "next", "measure", "blocker", "fit")


def detailed(df: DataFrame) -> DataFrame:
    """Scored rows as the detailed export has them, one column for each of its 32."""
    c = F.col
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    listed = lambda x: F.coalesce(joined(x), F.lit(""))
    out = [c("meeting_id").alias("Meeting ID"), text(c("title")).alias("Title"), text(c("date")).alias("Date"), listed(c("participants")).alias("Participants"), c("total_qualified_sections").alias("Total Score"), F.when(c("qualified"), "Yes").otherwise("No").alias("Qualified")]
    for name in SECTION_NAMES:
        title = name.upper()
        out.append(F.coalesce(c(f"{name}.qualified"), F.lit(False)).cast("int").alias(f"{title} Score"))
        if name == "fit":
            labels = names.labels(c("fit.services"), c("fit.fit_labels")) if "fit_labels" in df.schema["fit"].dataType.names else c("fit.services")
            out.append(listed(labels).alias("FIT Labels"))
        out += [text(c(f"{name}.{part}")).alias(f"{title} {part.title()}") for part in ("evidence", "reason", "summary")]
    return df.select(*out, listed(c("challenges")).alias("Challenges"), listed(c("results")).alias("Results"), text(c("offering")).alias("Offering"), text(c("scored_at")).alias("Scored At"), text(c("llm_model")).alias("Model"))


def opportunities(df: DataFrame, least: int = 4, n: int = 10) -> DataFrame:
    """The first n rows with a score of `least` or more: rank, title, date, at most three participants, score."""
    top = df.filter(F.col("total_qualified_sections") >= least).orderBy(F.desc("total_qualified_sections"), F.desc("date"), "meeting_id").limit(n)
    some, n_people = F.array_join(F.slice("participants", 1, 3), ", "), F.coalesce(F.size("participants"), F.lit(0))
    people = F.when(n_people > 3, F.concat(some, F.lit(" (+"), n_people - 3, F.lit(" more)"))).when(n_people > 0, some).otherwise("N/A")
    ranked = F.row_number().over(Window.orderBy(F.desc("total_qualified_sections"), F.desc("date"), "meeting_id"))
    return top.select(ranked.alias("rank"), "title", "date", people.alias("participants"), F.concat("total_qualified_sections", F.lit("/5")).alias("score"), "meeting_id")


def _rows_and_rest(df: DataFrame) -> tuple[list, int]:
    rows = df.limit(REPORT_ROWS + 1).collect()
    return rows[:REPORT_ROWS], df.count() - REPORT_ROWS if len(rows) > REPORT_ROWS else 0


def markdown(df: DataFrame, title: str) -> str:
    rows, rest = _rows_and_rest(df)
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([f"# {title}", "", line(df.columns), line(["---"] * len(df.columns)), *map(line, rows), *(["", f"{rest} more rows are not shown."] if rest else []), ""])


def html_page(df: DataFrame, title: str, summary: DataFrame | None = None) -> str:
    """A page with a table, below a list of what a summary of one row says."""
    rows, rest = _rows_and_rest(df)
    cell = lambda tag, x: f"<{tag}>{html.escape('' if x is None else str(x))}</{tag}>"
    body = "".join(f"<tr>{''.join(cell('td', c) for c in r)}</tr>" for r in rows)
    said = "" if summary is None else "<ul>" + "".join(cell("li", f"{c.replace('_', ' ')}: {v}") for c, v in summary.first().asDict().items()) + "</ul>"
    more = cell("p", f"{rest} more rows are not shown.") if rest else ""
    return f"<!doctype html><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{said}<table><tr>{''.join(cell('th', c) for c in df.columns)}</tr>{body}</table>{more}"


def message(summary: DataFrame, subject: str, steps: tuple[str, ...] = ()) -> str:
    """A mail's text from a summary of one row, with next steps."""
    row = summary.first()
    said = [f"{c.replace('_', ' ')}: {'' if row[c] is None else row[c]}" for c in summary.columns]
    return "\n".join([f"Subject: {subject}", "", *said, "", *[f"{k}. {step}" for k, step in enumerate(steps, 1)], *([""] if steps else [])])
