"""Files, tables, headers, answers and intake as queries: what goes through the engine, against plain SQL."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.functions import columns as C
from colloquy.operators import batch, clients, completion, costs, merge, names, redaction, routing, scoring, sinks, store, talent
from colloquy.plans.registry import Registry
from colloquy.sources import files, table, transcripts
from colloquy.streaming import intake

R = Registry()
c = F.col

# --- files -------------------------------------------------------------------------------------------


@R.query("""
SELECT n_name AS stem, octet_length(encode('Name: ' || n_name)) AS size, md5('Name: ' || n_name) AS md5, 'Name: ' || n_name AS text
FROM nation WHERE n_nationkey % 3 <> 2""")
def scan_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = files.shared_folder(spark, "files")
    for r in table(spark, sf, "nation").orderBy("n_nationkey").toLocalIterator():
        files.put(spark, f"{folder}/{r.n_name}.{('md', 'TXT', 'csv')[r.n_nationkey % 3]}", f"Name: {r.n_name}")
    return transcripts.scan(spark, folder).select("stem", "size", "md5", "text")


_WORDS = r"regexp_extract_all(text, '\p{L}+')"
_LETTERS = r"\p{L}+"


@R.query(f"""
SELECT 'n' || doc_id AS granola_note_id, array_to_string(ws, ' ') AS title, array_to_string(ws, ', ') AS attendees, coalesce(lang, '') AS creator_name, '' AS calendar_event_id
FROM (SELECT doc_id, lang, {_WORDS} AS ws FROM documents) WHERE len(ws) >= 1""")
def header_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Headers with an unquoted list of people, a missing value and a comma too many, made of the documents' words."""
    ws = F.regexp_extract_all("text", F.lit(_LETTERS), 0)
    header = F.concat(
        F.lit('```json\n{\n  "granola_note_id": "n'), "doc_id", F.lit('",\n  "title": "'), F.array_join("ws", " "), F.lit('",\n  "attendees": '), F.array_join("ws", ", "),
        F.lit(',\n  "creator_name": "'), F.coalesce("lang", F.lit("")), F.lit('",\n  "calendar_event_id": ,\n}\n```\n'),
    )
    docs = table(spark, sf, "documents").select("doc_id", "lang", ws.alias("ws")).filter(F.size("ws") >= 1)
    return docs.select(transcripts.metadata(header).alias("m")).select("m.granola_note_id", "m.title", "m.attendees", F.coalesce("m.creator_name", F.lit("")).alias("creator_name"), F.coalesce("m.calendar_event_id", F.lit("")).alias("calendar_event_id"))


@R.query(f"""
SELECT doc_id, array_to_string(ws, ' ') AS title, lower(ws[1]) || ' ' || ws[-1] AS creator_name, 'u' || doc_id || '@x.org' AS creator_email, array_to_string(ws, ', ') AS attendees
FROM (SELECT doc_id, {_WORDS} AS ws FROM documents) WHERE len(ws) >= 1""")
def markdown_header(spark: SparkSession, sf: str) -> DataFrame:
    """Headers of a note whose title and people are all words of a document; one without an address isn't among the people."""
    ws = F.regexp_extract_all("text", F.lit(_LETTERS), 0)
    people = F.array_join(F.transform("ws", lambda w, k: F.when(k % 2 == 0, F.concat(w, F.lit(" <a@x.org>"))).otherwise(F.concat(w, F.lit(" (b@x.org)")))), ", ")
    text = F.concat(
        F.lit("# "), F.array_join("ws", " "), F.lit("\n\n**Creator:** "), F.lower(F.element_at("ws", 1)), F.lit(" "), F.element_at("ws", -1), F.lit(" (u"), "doc_id", F.lit("@x.org)\n**Attendees:** nobody, "),
        people, F.lit("\n## Enhanced Notes\n**Creator:** no one\n"),
    )
    docs = table(spark, sf, "documents").select("doc_id", ws.alias("ws")).filter(F.size("ws") >= 1)
    return docs.select("doc_id", transcripts.metadata(text).alias("m")).select("doc_id", "m.title", "m.creator_name", "m.creator_email", "m.attendees")


@R.query("""
SELECT doc_id, source AS creator, 'Call ' || lang AS title, CASE WHEN doc_id % 2 = 0 THEN '2024-03-0' || (doc_id % 9 + 1) || 'T10_20_30.123Z' ELSE 'later' END AS timestamp,
       CASE WHEN doc_id % 2 = 0 THEN make_date(2024, 3, CAST(doc_id % 9 + 1 AS INT)) END AS day
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL
UNION ALL SELECT doc_id, source, 'Call', '', NULL FROM documents WHERE source IS NOT NULL AND lang IS NULL""")
def filename_parts(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.when(c("doc_id") % 2 == 0, F.concat(F.lit("2024-03-0"), c("doc_id") % 9 + 1, F.lit("T10_20_30.123Z"))).otherwise("later")
    whole = F.concat(F.lit("["), "source", F.lit("] Call "), "lang", F.lit(" - extra - "), stamp, F.lit(".txt"))
    name = F.coalesce(whole, F.concat(F.lit("["), "source", F.lit("] - Call.txt")))
    got = table(spark, sf, "documents").filter("source IS NOT NULL").select("doc_id", transcripts.from_filename(name).alias("f"))
    return got.select("doc_id", "f.*").withColumn("day", transcripts.filename_date(c("timestamp")))


@R.query("""
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN source END, CASE WHEN doc_id % 3 = 1 THEN lang END) AS company FROM documents""")
def company_lines(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("first\n"), F.when(c("doc_id") % 3 == 0, F.concat(F.lit("Company: "), "source", F.lit(", Ltd"))).when(c("doc_id") % 3 == 1, F.concat(F.lit("client: "), "lang")).otherwise("Nobody's company"), F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", transcripts.company_from_notes(text).alias("company"))


@R.query("""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN ['Ann', source, lang] WHEN 1 THEN [source, lang] END AS plain, CASE WHEN doc_id % 2 = 0 THEN [source, lang] ELSE ['Bob', source, lang] END AS fenced
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL""")
def participants_lists(spark: SparkSession, sf: str) -> DataFrame:
    people = F.concat("source", F.lit(" , "), "lang")
    plain = F.concat(F.lit("Title\n"), F.when(c("doc_id") % 3 == 0, F.concat(F.lit("Participants: Ann; "), people)).when(c("doc_id") % 3 == 1, F.concat(F.lit("Attendees: "), people)).otherwise("nobody"), F.lit("\nText"))
    creator = F.when(c("doc_id") % 2 == 0, c("source")).otherwise("Bob")
    docs = table(spark, sf, "documents").filter("source IS NOT NULL AND lang IS NOT NULL")
    return docs.select("doc_id", transcripts.plain_participants(plain).alias("plain"), transcripts.participants(people, creator).alias("fenced"))


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_MADE = "'**Date:** x' || chr(10) || text || chr(10) || '---' || chr(10) || '# Head' || chr(10) || '* star' || chr(10) || 'Original Granola Link: y'"


@R.query(rf"""
WITH l AS (SELECT conv_id, turn, trim(unnest(string_split({_MADE}, chr(10))), {_BLANK}) AS line FROM conversations),
b AS (SELECT * FROM l WHERE line <> '' AND NOT starts_with(line, '---'))
SELECT conv_id, turn, 'content' AS kind, NULL AS speaker, line AS text FROM b WHERE NOT starts_with(line, '#') AND NOT contains(line, '**Date:**')
UNION ALL
SELECT conv_id, turn, 'spoken', CASE WHEN named THEN trim(regexp_extract(line, '^([^:]+):', 1), {_BLANK}) END, CASE WHEN named THEN trim(regexp_extract(line, '^[^:]+:\s*(.+)', 1), {_BLANK}) ELSE line END
FROM (SELECT *, regexp_matches(line, '^([^:]+):\s*(.+)') AS named FROM b WHERE NOT contains(line, 'Original Granola Link:')) WHERE named OR NOT starts_with(line, '*')""")
def section_notes(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as a notes section and as a transcript section, with lines of metadata put around them."""
    made = F.concat(F.lit("**Date:** x\n"), "text", F.lit("\n---\n# Head\n* star\nOriginal Granola Link: y"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", made.alias("made"))
    both = [rows.select("conv_id", "turn", F.lit(kind).alias("kind"), F.explode(notes(c("made"))).alias("n")) for kind, notes in (("content", transcripts.content_notes), ("spoken", transcripts.spoken_notes))]
    return both[0].unionByName(both[1]).select("conv_id", "turn", "kind", "n.speaker", "n.text")


@R.query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN DATE '2000-01-01' ELSE CAST(ts AS DATE) END AS day FROM events""")
def plain_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(c("event_id") % 4 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    return table(spark, sf, "events").select("event_id", C.local_date(text, F.lit("2000-01-01").cast("date")).alias("day"))


_PARSED = r"""
SELECT 'm' || doc_id AS meeting_id, 'granola_drive' AS source, make_date(2024, 1, CAST(doc_id % 28 + 1 AS INT)) AS date, 'Weekly ' || doc_id AS title, ['Ann', coalesce(lang, 'xx')] AS participants,
       note AS enhanced_notes, NULL AS reject FROM (SELECT doc_id, lang, array_to_string(regexp_extract_all(text, '\p{L}+'), ' ') AS note FROM documents WHERE doc_id % 2 = 0) WHERE note <> ''
UNION ALL
SELECT 'd' || doc_id, 'plaintext', CASE WHEN doc_id % 5 <> 0 THEN make_date(2024, 2, CAST(doc_id % 28 + 1 AS INT)) END, 'Plain ' || doc_id, ['Bob', coalesce(lang, 'xx')], '', CASE WHEN doc_id % 5 = 0 THEN 'no date' END
FROM (SELECT doc_id, lang, array_to_string(regexp_extract_all(text, '\p{L}+'), ' ') AS note FROM documents WHERE doc_id % 2 = 1) WHERE note <> ''"""


@R.query(_PARSED)
def parsed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Fenced and plain files around the documents' words, parsed; those without a date are rejected."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("xx")).alias("lang"), F.array_join(F.regexp_extract_all("text", F.lit(_LETTERS), 0), " ").alias("note")).filter("note <> ''")
    day = lambda month: F.date_format(F.make_date(F.lit(2024), F.lit(month), (c("doc_id") % 28 + 1).cast("int")), "yyyy-MM-dd")
    fenced = F.concat(
        F.lit('```json\n{"granola_note_id": "m'), "doc_id", F.lit('", "title": "Weekly '), "doc_id", F.lit('", "creator_name": "Ann", "attendees": "'), "lang",
        F.lit('", "calendar_event_time": "'), day(1), F.lit('T09:00:00+01:00"}\n```\n## Enhanced Notes\n'), "note", F.lit("\n## Full Transcript\nMe: hello\n"),
    )
    dated = F.when(c("doc_id") % 5 != 0, F.concat(F.lit("Date: "), day(2), F.lit("\n"))).otherwise("")
    plain = F.concat(F.lit("Plain "), "doc_id", F.lit("\n"), dated, F.lit("Participants: Bob, "), "lang", F.lit("\n\n"), "note")
    even = c("doc_id") % 2 == 0
    given = docs.select(F.when(even, fenced).otherwise(plain).alias("text"), F.concat(F.lit("d"), "doc_id").alias("stem"), F.concat(F.lit("/x/d"), "doc_id", F.lit(".txt")).alias("path"))
    return transcripts.parse(given).select("meeting_id", "source", "date", "title", "participants", "enhanced_notes", "reject")


# --- tables and exports --------------------------------------------------------------------------------


@R.query("SELECT conv_id || '-' || turn AS meeting_id, role AS title, text AS full_transcript, count(*) AS n FROM conversations GROUP BY ALL")
def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON document for each turn, written and scanned again."""
    turns = table(spark, sf, "conversations").select(F.concat("conv_id", F.lit("-"), "turn").alias("meeting_id"), c("role").alias("title"), c("text").alias("full_transcript"))
    made = turns.groupBy(*turns.columns).agg(F.count(F.lit(1)).cast("string").alias("desk"))
    path = files.shared_folder(spark, "documents")
    store.write_each(made, F.concat_ws("-", C.file_safe(c("meeting_id")), F.md5(F.to_json(F.struct(*turns.columns)))), path)
    read = store.documents(spark, f"{path}/*").filter("_corrupt IS NULL")
    return read.select("meeting_id", "title", "full_transcript", c("desk").cast("bigint").alias("n"))


_SUPPLIERS = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"


@R.query(f"SELECT s.*, how FROM ({_SUPPLIERS}) AS s, (VALUES ('by schema'), ('inferred')) AS h(how)")
def staged_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = files.shared_folder(spark, "staged")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.write_json(rows, path)
    both = store.staged(spark, path, rows.schema).withColumn("how", F.lit("by schema")).unionByName(store.staged(spark, path).withColumn("how", F.lit("inferred")))
    return both.select("s_suppkey", "s_name", "s_acctbal", "how")


@R.query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand || '; ' || p_type AS kinds, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS optional FROM part")
def csv_export(spark: SparkSession, sf: str) -> DataFrame:
    path = files.shared_folder(spark, "csv")
    sinks.write_csv(table(spark, sf, "part").select("p_partkey", "p_name", F.array("p_brand", "p_type").alias("kinds"), F.when(c("p_partkey") % 3 != 0, c("p_type")).alias("optional")), path)
    read = spark.read.option("header", True).option("escape", '"').csv(path)
    return read.select("p_partkey", "p_name", "kinds", F.coalesce("optional", F.lit("")).alias("optional"))


@R.query("SELECT * FROM (VALUES ('append', 2), ('truncate', 1), ('empty', 0)) AS t(mode, times), (SELECT count(*) AS n, sum(o_orderkey) AS total FROM orders)")
def dispositions(spark: SparkSession, sf: str) -> DataFrame:
    """How often the rows are there after they were written twice, or written once and then refused."""
    rows, out = table(spark, sf, "orders").select("o_orderkey"), None
    n, total = rows.agg(F.count(F.lit(1)), F.sum("o_orderkey")).first()
    for mode in ("append", "truncate", "empty"):
        path = files.shared_folder(spark, mode)
        sinks.write(rows, path, "empty")
        refused = False
        try:
            sinks.write(rows, path, mode)
        except ValueError:
            refused = True
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("k")).select(F.lit(mode).alias("mode"), (F.lit(0) if refused else (c("k") / F.lit(max(n, 1)))).cast("int").alias("times"), F.lit(n).cast("bigint").alias("n"), F.lit(total).alias("total"))
        out = counted if out is None else out.unionByName(counted)
    return out


@R.query("SELECT event_type AS model, count(*) AS calls, sum(event_id) AS tokens_in FROM events WHERE event_id % 2 = 0 GROUP BY 1")
def cost_log(spark: SparkSession, sf: str) -> DataFrame:
    """Calls appended to a log in two batches, and a third that the switch keeps out."""
    path = files.shared_folder(spark, "log")
    calls = table(spark, sf, "events").select(c("event_id").cast("string").alias("log_id"), c("user_id").cast("string").alias("meeting_id"), F.lit("client").alias("scoring_domain"), c("event_type").alias("model"), F.lit("now").alias("prompt_label"), c("event_id").alias("tokens_in"), F.lit(1).cast("bigint").alias("tokens_out"), F.lit(0.1).alias("cost_estimate_usd"), c("ts").cast("timestamp").alias("scored_at"))
    for k, config in ((0, Config()), (2, Config()), (1, Config(cost_log_disabled=True))):
        store.log_calls(calls.filter(c("tokens_in") % 4 == k), path, config)
    return spark.read.parquet(path).groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").alias("tokens_in"))


@R.query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal FROM customer")
def table_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """A table made twice, filled, given a column that it lacked, filled again, and swapped for itself."""
    customers, name = table(spark, sf, "customer"), f"flow_{files.shared_folder(spark, 't').rpartition('/')[2]}"
    store.create_database(spark, "default")
    want = customers.select("c_custkey", "c_name", "c_acctbal").schema
    for _ in range(2):
        store.create_table(spark, name, customers.select("c_custkey", "c_name").schema)
    try:
        customers.filter("c_custkey % 2 = 0").select("c_custkey", "c_name").write.insertInto(name)
        assert store.evolve_table(spark, name, want, apply=False) == store.evolve_table(spark, name, want) == ["c_acctbal"]
        customers.filter("c_custkey % 2 = 1").select("c_custkey", "c_name", "c_acctbal").write.insertInto(name)
        path = f"{files.shared_folder(spark, 'swapped')}/t"
        sinks.write(spark.table(name), path)
        swapped = sinks.replace_table(spark.read.parquet(path), path)
        info = sinks.table_info(spark, path)
        assert info["rows"] == customers.count() and info["columns"] == 3 and sinks.table_info(spark, f"{path}-none") is None
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return swapped


@R.query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS c_name, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer")
def schema_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Customers brought to a schema that has a column more, and whose required column was relaxed so that it may be null."""
    from pyspark.sql import types as T

    wanted = T.StructType([T.StructField("c_custkey", T.LongType(), False), T.StructField("c_name", T.StringType(), False), T.StructField("c_phone", T.StringType()), T.StructField("C_ACCTBAL", T.DoubleType(), False)])
    relaxed, changed, already, missing = merge.relax(wanted, ["c_custkey", "c_name", "c_phone", "c_fax"])
    assert (changed, already, missing) == (["c_custkey", "c_name"], ["c_phone"], ["c_fax"])
    customers = table(spark, sf, "customer").select("c_custkey", F.when(c("c_custkey") % 2 == 0, c("c_name")).alias("c_name"), "c_acctbal")
    assert merge.missing_columns(customers, wanted) == ["c_phone"]
    full = merge.add_columns(customers, relaxed).select("c_custkey", "c_name", "c_phone", "c_acctbal")
    path = files.shared_folder(spark, "relaxed")
    full.write.parquet(path)
    return spark.read.schema(relaxed).parquet(path).withColumnRenamed("C_ACCTBAL", "c_acctbal")


@R.query("""
SELECT coalesce(t.k, s.k) AS meeting_id, CASE WHEN s.k IS NOT NULL THEN s.llm_model ELSE t.llm_model END AS llm_model, coalesce(s.notes, t.notes) AS enhanced_notes, t.total AS total_qualified_sections,
       CASE WHEN s.k IS NOT NULL THEN 'talent' ELSE 'client' END AS scoring_domain, CASE WHEN s.k IS NOT NULL THEN s.status END AS article9_status
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k, 'old' AS llm_model, o_orderpriority AS notes, o_custkey AS total FROM orders WHERE o_orderkey % 3 <> 0) t
FULL JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS llm_model, CASE WHEN o_orderkey % 4 = 0 THEN 'new' END AS notes, 'flag' AS status FROM orders WHERE o_orderkey % 2 = 0) s ON t.k = s.k""")
def merge_by_domain(spark: SparkSession, sf: str) -> DataFrame:
    """Client rows after talent rows came in by the dispatcher: the client's own columns stay."""
    orders, key = table(spark, sf, "orders"), c("o_orderkey")
    full = lambda rows: merge.add_columns(rows, schemas.MEETING_INTEL).select(*schemas.MEETING_INTEL.names)
    target = full(orders.filter(key % 3 != 0).select(key.cast("string").alias("meeting_id"), F.lit("old").alias("llm_model"), c("o_orderpriority").alias("enhanced_notes"), c("o_custkey").alias("total_qualified_sections"), F.lit("client").alias("scoring_domain")))
    source = full(orders.filter(key % 2 == 0).select(key.cast("string").alias("meeting_id"), c("o_orderstatus").alias("llm_model"), F.when(key % 4 == 0, "new").alias("enhanced_notes"), F.lit("flag").alias("article9_status")))
    return merge.merge_by_domain(target, source, "talent").select("meeting_id", "llm_model", "enhanced_notes", "total_qualified_sections", "scoring_domain", "article9_status")


@R.query("SELECT n_nationkey, n_name FROM nation WHERE n_name || '''; --' IN (SELECT n_name || '''; --' FROM nation WHERE n_regionkey = 1)")
def quoted_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values with quotes go in as parameters, never as text."""
    nations = table(spark, sf, "nation").withColumn("quoted", F.concat("n_name", F.lit("'; --")))
    wanted = [r.quoted for r in nations.filter("n_regionkey = 1").select("quoted").collect()]
    nations.createOrReplaceTempView("__quoted")
    return spark.sql("SELECT n_nationkey, n_name FROM __quoted WHERE array_contains(:names, quoted)", args={"names": wanted})


# --- intake --------------------------------------------------------------------------------------------


@R.query("""
SELECT doc_id, CASE WHEN doc_id % 4 <> 3 AND doc_id % 3 <> 2 AND coalesce(source, '') <> '' THEN 'taken' ELSE 'ignored' END AS kind FROM documents""")
def event_intake(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(c("doc_id") % 4 == 3, "google.cloud.storage.object.v1.deleted").otherwise("google.cloud.storage.object.v1.finalized")
    ending = F.element_at(F.array(F.lit(".txt"), F.lit(".md"), F.lit(".TXT")), (c("doc_id") % 3 + 1).cast("int"))
    name = F.concat(F.when(F.coalesce("source", F.lit("")) != "", "transcripts/").otherwise("other/"), "doc_id", ending)
    return table(spark, sf, "documents").select("doc_id", transcripts.event_kind(kind, name).alias("kind"))


@R.query("""
SELECT doc_id, trim(coalesce(s, '')) = '' AS unlabelled, lang, CASE WHEN trim(coalesce(s, '')) = '' THEN 'client' ELSE s END AS source
FROM (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN '  ' WHEN doc_id % 3 = 1 THEN source END AS s FROM documents)""")
def metadata_backfill(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(c("doc_id") % 3 == 0, "  ").when(c("doc_id") % 3 == 1, c("source"))
    rows = table(spark, sf, "documents").select("doc_id", F.create_map(F.lit("lang"), c("lang"), F.lit("source"), given).alias("m"))
    blank = routing.without_source(c("m"))
    done = rows.withColumns({"unlabelled": blank, "m": F.when(blank, routing.with_entry(c("m"), "source", F.lit("client"))).otherwise(c("m"))})
    return done.select("doc_id", "unlabelled", c("m")["lang"].alias("lang"), c("m")["source"].alias("source"))


@R.query("""
SELECT doc_id, coalesce(trim(id) = '', true) OR (note IS NULL AND id = 'tmp' || doc_id) AS poison
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'tmp' || doc_id WHEN 2 THEN 'tmp' || doc_id END AS id, CASE WHEN doc_id % 4 = 2 THEN source END AS note FROM documents)""")
def poison_keys(spark: SparkSession, sf: str) -> DataFrame:
    stem, k = F.concat(F.lit("tmp"), "doc_id"), c("doc_id") % 4
    identity, note = F.when(k == 0, "").when(k.isin(1, 2), stem), F.when(k == 2, c("source"))
    return table(spark, sf, "documents").select("doc_id", routing.poison_key(identity, stem, note).alias("poison"))


@R.query("""
WITH asked AS (SELECT user_id AS key, CAST(ts AS DATE) AS day, min(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL),
held AS (SELECT DISTINCT user_id AS key, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'signup'),
granted AS (SELECT * FROM asked ANTI JOIN held USING (key, day)),
claims AS (SELECT key, day FROM held UNION ALL SELECT key, day FROM granted)
SELECT key, day, count(*) AS n FROM claims ANTI JOIN (SELECT key, day FROM granted WHERE event_id % 2 = 0) USING (key, day) GROUP BY ALL""")
def claims_and_release(spark: SparkSession, sf: str) -> DataFrame:
    """Claims after requests took theirs and those whose work failed gave them back."""
    events = table(spark, sf, "events").select(c("user_id").alias("key"), c("ts").cast("date").alias("day"), "event_id", "event_type")
    held = events.filter("event_type = 'signup'").select("key", "day").distinct()
    granted, claims = store.acquire(events.filter("event_type = 'click'"), held, ["event_id"])
    left = store.release(claims, granted.filter("event_id % 2 = 0"))
    return left.groupBy("key", "day").agg(F.count(F.lit(1)).alias("n"))


@R.query("""
SELECT event_id, CASE WHEN event_type <> 'click' OR CAST(ts AS DATE) < DATE '2024-01-03' THEN NULL WHEN event_id % 3 = 0 THEN 'second ' || event_id ELSE 'first ' || event_id END AS result FROM events""")
def cached_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results cached, some of them once more, a day of them compacted, and old days forgotten."""
    cache = store.ResultCache(spark, files.shared_folder(spark, "cache"))
    day = c("ts").cast("date")
    asked = table(spark, sf, "events").select("event_id", "event_type", day.alias("day"), routing.cache_key(day, c("event_id"), F.lit("m"), c("event_type")).alias("key"))
    for said, rows in (("first ", asked), ("second ", asked.filter("event_id % 3 = 0"))):
        cache.put(rows.filter("event_type = 'click'").select("key", F.concat(F.lit(said), "event_id").alias("result"), "day"))
    cache.compact("2024-01-05")
    cache.forget("2024-01-03")
    return cache.find(asked).select("event_id", "result")


class _Odd:
    """Work that refuses, times out or breaks on some rows."""

    def __call__(self, row: dict) -> None:
        if row["event_type"] == "error":
            error = RuntimeError("refused")
            error.status = 400
            raise error
        if row["event_type"] == "view":
            raise TimeoutError("slow")
        if row["event_type"] == "signup":
            raise KeyError("broken")


@R.query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'timeout' WHEN 'signup' THEN 'error' ELSE 'success' END AS status FROM events""")
def batch_results(spark: SparkSession, sf: str) -> DataFrame:
    results = batch.run(table(spark, sf, "events").select("event_id", "event_type"), "event_id", _Odd)
    path = files.shared_folder(spark, "batch")
    counts = batch.report(results, path, "event_id")
    read = spark.read.json(path)
    assert sum(counts.values()) == read.count()
    return read.select("event_id", "status")


@R.query("""
SELECT event_id, attempts, seconds, make_timestamp(epoch_us(ts) + CAST(seconds * 1000000 AS BIGINT)) AS due
FROM (SELECT event_id, ts, attempts, least(30.0, 1.0 * power(2, attempts - 1)) AS seconds FROM (SELECT event_id, ts, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempts FROM events WHERE event_type = 'error'))""")
def retry_delays(spark: SparkSession, sf: str) -> DataFrame:
    """When each error of a user's day is tried again, by how many came before it."""
    # (a key is a user and a day, whose errors are few)
    nth = F.row_number().over(Window.partitionBy("user_id", c("ts").cast("date")).orderBy("ts", "event_id"))
    errors = table(spark, sf, "events").filter("event_type = 'error'").select("event_id", "ts", nth.cast("bigint").alias("attempts"))
    waits = errors.withColumn("seconds", intake.delay(c("attempts")))
    return waits.select("event_id", "attempts", "seconds", F.timestamp_micros(F.unix_micros(c("ts").cast("timestamp")) + (c("seconds") * 1_000_000).cast("bigint")).cast("timestamp_ntz").alias("due"))


@R.query("SELECT event_id, event_type IN ('click', 'view') OR status = 429 OR (status BETWEEN 500 AND 599) AS transient FROM (SELECT event_id, event_type, CAST(400 + event_id % 200 AS INT) AS status FROM events)")
def transient_errors(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(c("event_type") == "click", "timeout").when(c("event_type") == "view", "connection").otherwise(c("event_type"))
    return table(spark, sf, "events").select("event_id", scoring.is_transient(kind, (400 + c("event_id") % 200).cast("int")).alias("transient"))


# --- answers -------------------------------------------------------------------------------------------


class Echo:
    """A completer whose answers follow from the question and the text: fenced, as a list, broken, or of another shape (a
    key too many, a quoted boolean or score, a key missing), which it mends for even numbers when it is asked again."""

    def __init__(self, broken: bool = True):
        self.broken = broken

    def complete(self, prompt: str, context: str) -> str | None:
        number, _, text = context.partition(" ")
        k, (prompt, _, again) = int(number), prompt.partition("\n")
        odd = not (again and k % 2 == 0)  # whether it keeps to its shape
        if self.broken and k % 7 == 0:
            return "" if k % 2 else "no json"
        if prompt.startswith("sales_"):
            said = {"score": str(k % 5) if k % 13 == 0 else k % 5, "qualified": True, "reason": prompt, "evidence": text, "coaching_note": None, "more": 1}
            if odd and k % 11 == 0:
                del said["coaching_note"]
            return json.dumps(said)
        if prompt == "taxonomy":
            return json.dumps({"challenges": ["x", completion.CHALLENGES[k % len(completion.CHALLENGES)]], "results": [completion.RESULTS[k % len(completion.RESULTS)]], "offering": "unknown"})
        if prompt == "talent_narrative":
            return " " if k % 3 == 0 else f" About {k}. "
        said = {"qualified": (k + len(prompt)) % 2 == 0, "reason": prompt, "summary": None, "evidence": [text, None, "end"] if k % 3 == 0 else text}
        if prompt == "fit":
            said["services"] = ["talent", "Evolve", "x", "ACCESS"]
        if odd and prompt == "next" and k % 3 == 0:
            said["more"] = 1
        if odd and prompt == "now" and k % 5 == 0:
            said["qualified"] = "true"
        answer = json.dumps(said)
        return f"```json\n{answer}\n```" if k % 2 else answer


def _asked(spark: SparkSession, sf: str, prompts: list[str]) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws(" ", c("doc_id"), F.coalesce("text", F.lit(""))).alias("context"))
    asked = completion.ask(docs, {p: p for p in prompts}, "context", Echo, Config(), fallback=lambda: Echo(False))
    return asked.withColumn("given", F.element_at(F.split("context", " ", 2), 2))


_CUT = r"nullif(array_to_string(string_split(trim(regexp_replace({0}, '\s+', ' ', 'g')), ' ')[1:25], ' '), '')"
_EVIDENCE = _CUT.format("CASE WHEN doc_id % 3 = 0 THEN coalesce(nullif(text, '') || ' ', '') || 'end' ELSE coalesce(text, '') END")
#: Empty answers stay empty on the third try; what is no JSON is asked of the other completer, which answers.
_ANSWERED = "NOT (doc_id % 7 = 0 AND doc_id % 2 = 1)"


#: Answers that never get the shape they should have, by prompt.
_MISSHAPEN = {"now": "doc_id % 5 = 0 AND doc_id % 2 = 1", "next": "doc_id % 3 = 0 AND doc_id % 2 = 1"}


def _section(prompt: str) -> str:
    odd = _MISSHAPEN.get(prompt, "false")
    summary = "Model returned non-boolean qualified field" if prompt == "now" else "Model returned invalid response format"
    return f"""CASE WHEN {_ANSWERED} AND NOT ({odd}) THEN (doc_id + {len(prompt)}) % 2 = 0 ELSE false END AS {prompt}_qualified, CASE WHEN NOT {_ANSWERED} THEN 'invalid response' WHEN {odd} THEN 'Invalid JSON from model' ELSE '{prompt}' END AS {prompt}_reason,
       CASE WHEN {_ANSWERED} AND NOT ({odd}) THEN {_EVIDENCE} END AS {prompt}_evidence, CASE WHEN {_ANSWERED} AND {odd} THEN '{summary}' END AS {prompt}_summary"""


@R.query(f"""
WITH s AS (SELECT doc_id, {_section('now')}, {_section('next')}, {_section('fit')} FROM documents)
SELECT *, {_ANSWERED} AS has_services FROM s""")
def section_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Asked, retried, asked of the fallback, unfenced and validated: sections of the documents."""
    scored = completion.opportunity(_asked(spark, sf, ["now", "next", "measure", "blocker", "fit"]))
    out = [c(f"{s}.{f}").alias(f"{s}_{f}") for s in ("now", "next", "fit") for f in ("qualified", "reason", "evidence", "summary")]
    return scored.select("doc_id", *out, (F.size(F.coalesce("fit.services", F.array().cast("array<string>"))) == 2).alias("has_services"))


_QUALIFIED = " + ".join(f"CAST({_ANSWERED} AND NOT ({_MISSHAPEN.get(p, 'false')}) AND (doc_id + {len(p)}) % 2 = 0 AS INT)" for p in completion.SECTIONS)


@R.query(f"SELECT doc_id, CAST(n AS BIGINT) AS total_qualified_sections, n >= 3 AS qualified, [{', '.join(repr(p) for p in sorted(completion.SECTIONS))}] AS checks FROM (SELECT doc_id, {_QUALIFIED} AS n FROM documents)")
def sections_qualified(spark: SparkSession, sf: str) -> DataFrame:
    """Totals over the sections, and the legacy shape's checks."""
    scored = completion.legacy(completion.opportunity(_asked(spark, sf, list(completion.SECTIONS))))
    return scored.select("doc_id", "total_qualified_sections", "qualified", F.array_sort(F.map_keys("checks")).alias("checks"))


#: Assessments that lack a key for good, and the score of all others: 0 where it is a string.
_LACKING = "(doc_id % 11 = 0 AND doc_id % 2 = 1)"
_SALES_SCORE = f"CASE WHEN {_ANSWERED} AND NOT {_LACKING} AND doc_id % 13 <> 0 THEN least(3, doc_id % 5) ELSE 0 END"


@R.query(f"""
SELECT doc_id, CAST(8 * s AS BIGINT) AS sales_total_score, CAST(CASE WHEN s >= 2 THEN 8 ELSE 0 END AS BIGINT) AS sales_total_qualified, s >= 2 AS sales_qualified, CASE WHEN {_ANSWERED} THEN CASE WHEN lacking THEN 'Invalid JSON from model' ELSE 'sales_scoping' END END AS reason,
       CASE WHEN {_ANSWERED} AND NOT lacking THEN {_CUT.format("coalesce(text, '')")} END AS evidence
FROM (SELECT *, {_SALES_SCORE} AS s, {_LACKING} AS lacking FROM documents)""")
def sales_assessment(spark: SparkSession, sf: str) -> DataFrame:
    scored = completion.sales(_asked(spark, sf, [f"sales_{x}" for x in schemas.SALES_CRITERIA]))
    return scored.select("doc_id", "sales_total_score", "sales_total_qualified", "sales_qualified", c("sales_scoping.reason").alias("reason"), c("sales_scoping.evidence").alias("evidence"))


@R.query(f"SELECT doc_id, CAST(n AS BIGINT) AS total_qualified_sections, CAST(8 * ({_SALES_SCORE}) AS BIGINT) AS sales_total_score, CASE WHEN {_ANSWERED} THEN 1 ELSE 0 END AS n_challenges, true AS no_offering FROM (SELECT *, {_QUALIFIED} AS n FROM documents)")
def full_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Both assessments and labels from one round of questions."""
    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws(" ", c("doc_id"), F.coalesce("text", F.lit(""))).alias("context"))
    prompts = [*completion.SECTIONS, "taxonomy", *(f"sales_{x}" for x in schemas.SALES_CRITERIA)]
    scored = completion.full(docs, {p: p for p in prompts}, "context", Echo, Config(), fallback=lambda: Echo(False))
    return scored.select("doc_id", "total_qualified_sections", "sales_total_score", F.size(F.coalesce("challenges", F.array().cast("array<string>"))).alias("n_challenges"), c("offering").isNull().alias("no_offering"))


@R.query("SELECT event_id, CASE WHEN starts_with(m, 'gpt-5') THEN 'responses' WHEN starts_with(m, 'o1') THEN 'reasoning' ELSE 'chat' END AS family, CASE WHEN starts_with(m, 'gpt-5') OR starts_with(m, 'o1') THEN 1500 ELSE 700 END AS most FROM (SELECT event_id, ['gpt-5-mini', 'o1-preview', 'gpt-4o', 'other'][event_id % 4 + 1] AS m FROM events)")
def model_routes(spark: SparkSession, sf: str) -> DataFrame:
    """Which interface each model is asked by, and how many tokens it may answer with."""
    sent = []
    for model in ("gpt-5-mini", "o1-preview", "gpt-4o", "other"):
        completion.Routed(model, lambda family, r: sent.append((r["model"], family, next(v for k, v in r.items() if "token" in k))) or "{}", max_tokens=700).complete("p", "c")
    model = F.element_at(F.array(*[F.lit(m) for m, _, _ in sent]), (c("event_id") % 4 + 1).cast("int"))
    routes = F.broadcast(spark.createDataFrame(sent, "model string, family string, most int"))
    return table(spark, sf, "events").select("event_id", model.alias("model")).join(routes, "model").select("event_id", "family", "most")


@R.query("""
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'asked' WHEN doc_id % 4 = 1 THEN 'title' WHEN doc_id % 4 = 2 THEN 'filename' ELSE 'domain' END AS source,
       CASE WHEN doc_id % 4 = 0 THEN 'Client ' || doc_id WHEN doc_id % 4 = 1 THEN 'Acme ' || lang WHEN doc_id % 4 = 2 THEN 'Acme Office' ELSE coalesce(lang, 'Unknown') END AS client
FROM documents WHERE lang IS NOT NULL""")
def client_tiers(spark: SparkSession, sf: str) -> DataFrame:
    k = c("doc_id") % 4
    answer = F.when(k == 0, F.concat(F.lit('```json\n{"client": "Client '), "doc_id", F.lit('", "source": "asked"}\n```'))).otherwise("no json")
    title = F.when(k == 1, F.concat(F.lit("Acme "), "lang", F.lit(" x House"))).otherwise("x")
    identity = F.when(k == 2, F.concat(F.lit("meeting-acme-office-1693737600"), "doc_id")).otherwise("x")
    made = completion.client(answer, [("saas", ("software",))], title, identity, c("lang"), c("text"), ("house",))
    return table(spark, sf, "documents").filter("lang IS NOT NULL").select("doc_id", made.alias("i")).select("doc_id", "i.source", "i.client")


@R.query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN [p_brand] ELSE [p_type, p_name] END AS labels FROM part")
def labels_or_fit(spark: SparkSession, sf: str) -> DataFrame:
    services = F.when(c("p_partkey") % 2 == 0, F.array("p_brand")).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "part").select("p_partkey", names.labels(services, F.array("p_type", "p_name")).alias("labels"))


@R.query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN user_id ELSE 0 END AS tokens_in, CASE event_id % 4 WHEN 0 THEN user_id WHEN 1 THEN event_id ELSE 0 END AS tokens_out FROM events""")
def response_tokens(spark: SparkSession, sf: str) -> DataFrame:
    k, e, u = c("event_id") % 4, c("event_id"), c("user_id")
    got = costs.tokens(F.when(k.isin(0, 2), e), F.when(k == 0, u), F.when(k == 1, u), F.when(k.isin(1, 3), e))
    return table(spark, sf, "events").select("event_id", got.alias("t")).select("event_id", "t.*")


@R.query("SELECT doc_id, ['text/plain', 'text/markdown', 'application/json', 'text/csv', 'text/html', 'text/plain'][doc_id % 6 + 1] AS type FROM documents")
def content_types(spark: SparkSession, sf: str) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(x) for x in ("txt", "MD", "json", "csv", "html", "bin")]), (c("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf, "documents").select("doc_id", sinks.content_type(F.concat("doc_id", F.lit("."), ending)).alias("type"))


@R.query("SELECT CAST(o_orderkey AS VARCHAR) AS meeting_id, CASE WHEN o_orderkey % 3 = 0 THEN 'No summary: the narrative came back empty.' ELSE 'About ' || o_orderkey || '.' END AS talent_narrative FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 5 = 0")
def talent_narratives(spark: SparkSession, sf: str) -> DataFrame:
    """The second pass, which is given the extraction alone; rejected rows have none."""
    key = c("o_orderkey")
    answer = F.when(key % 5 != 0, F.concat(F.lit('{"talent_now": {"role": "'), key, F.lit('"}, "talent_motivation": {"primary_driver": "salary", "better_description": "b"}}'))).otherwise("no json")
    rows = table(spark, sf, "orders").select(key.cast("string").alias("meeting_id"), answer.alias("answer"))
    scored = talent.score(rows, "answer", spark.createDataFrame([], "variant_name string, canonical_name string"))
    return talent.narrative(scored, "talent_narrative", Narrator).select("meeting_id", "talent_narrative")


class Narrator:
    """Says something of the role in an extraction, or nothing."""

    def complete(self, prompt: str, context: str) -> str | None:
        return Echo(False).complete(prompt, json.loads(context)["talent_now"]["role"] + " ")


@R.query("""
SELECT doc_id, CASE WHEN n = 0 THEN 'redacted' ELSE 'redact_fallback' END AS status, CASE WHEN n = 0 THEN replace(lower(text), 'the ', 'the_') ELSE lower(text) END AS text
FROM (SELECT doc_id, text, CASE WHEN contains(lower(text), 'of the ') THEN 1 ELSE 0 END AS n FROM documents WHERE text IS NOT NULL AND NOT contains(lower(text), 'and the '))""")
def redaction_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the rounds don't make clean keep their text with a status that says so."""

    def detect(text: Column) -> Column:
        sure = F.when(text.contains("of the "), F.struct(F.lit("x").alias("category"), F.lit("of the ").alias("span"), F.lit(0.9).alias("confidence")))
        return F.array_compact(F.array(sure))

    docs = table(spark, sf, "documents").filter(c("text").isNotNull() & ~F.lower("text").contains("and the ")).select("doc_id", F.lower("text").alias("text"))
    done = redaction.redact(docs, "text", detect, rounds=1, on_failure="fallback", without=lambda t, flags: t)
    return done.select("doc_id", "status", F.when(c("status") == "redacted", F.replace("text", F.lit("the "), F.lit("the_"))).otherwise(c("text")).alias("text"))


class Finder:
    """A detector: finds `of the` in a text, surely, and `der die`, not surely; its answers are fenced."""

    def complete(self, prompt: str, context: str) -> str | None:
        low = context.lower()
        found = [{"category": "x", "span": span, "confidence": sure} for span, sure in (("of the", 0.9), ("der die", 0.3)) if span in low]
        return f"```json\n{json.dumps(found)}\n```"


@R.query("""
SELECT doc_id, CASE WHEN sure AND weak THEN regexp_replace(regexp_replace(text, 'of the', '[REDACTED:x]', 'gi'), 'der die', '[REDACTED:x]', 'gi') WHEN sure THEN regexp_replace(text, 'of the', '[REDACTED:x]', 'gi') ELSE text END AS text,
       'redacted' AS status, CAST(sure AS INT) AS rounds, CAST(sure AS INT) + CAST(weak AS INT) AS n_flags
FROM (SELECT *, contains(lower(text), 'of the') AS sure, contains(lower(text), 'der die') AS weak FROM documents WHERE text IS NOT NULL)""")
def asked_redaction(spark: SparkSession, sf: str) -> DataFrame:
    """Detection by a completer, in rounds, until nothing sure is found."""
    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text")
    done = talent.screen_asked(docs, "text", "find", Finder, Config(redact_mode="redact"))
    return done.select("doc_id", "text", "status", "rounds", F.size("flags").alias("n_flags"))


_DETAIL = "SELECT CAST(o_orderkey AS VARCHAR) AS \"Meeting ID\", o_orderpriority AS \"Title\", CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS \"Qualified\", CAST(o_orderkey % 2 = 0 AS INT) AS \"NOW Score\", CASE WHEN o_orderkey % 3 = 0 THEN 'a; b' ELSE '' END AS \"FIT Labels\", o_orderstatus AS \"BLOCKER Reason\", CAST(32 AS INT) AS n_columns FROM orders"


@R.query(_DETAIL)
def detailed_export(spark: SparkSession, sf: str) -> DataFrame:
    key = c("o_orderkey")
    part = F.struct((key % 2 == 0).alias("qualified"), c("o_orderstatus").alias("reason"), F.lit(None).cast("string").alias("summary"), F.lit(None).cast("string").alias("evidence"))
    fit = F.struct((key % 2 == 0).alias("qualified"), c("o_orderstatus").alias("reason"), F.lit(None).cast("string").alias("summary"), F.when(key % 3 == 0, F.array(F.lit("a"), F.lit("b"))).alias("services"), F.lit(None).cast("string").alias("evidence"))
    rows = table(spark, sf, "orders").select(key.cast("string").alias("meeting_id"), c("o_orderpriority").alias("title"), (key % 2 == 0).alias("qualified"), *[part.cast(schemas.SECTION).alias(s) for s in completion.SECTIONS[:-1]], fit.cast(schemas.FIT).alias("fit"))
    out = sinks.detailed(merge.add_columns(rows, schemas.MEETING_INTEL))
    return out.withColumn("n_columns", F.lit(len(out.columns))).select("Meeting ID", "Title", "Qualified", "NOW Score", "FIT Labels", "BLOCKER Reason", "n_columns")


@R.query("SELECT row_number() OVER (ORDER BY total DESC, meeting_id) AS rank, title, total || '/5' AS score, CASE WHEN n > 3 THEN 'p1, p2, p3 (+' || (n - 3) || ' more)' WHEN n = 0 THEN 'N/A' ELSE array_to_string(['p1', 'p2', 'p3'][1:n], ', ') END AS participants FROM (SELECT CAST(o_orderkey AS VARCHAR) AS meeting_id, o_orderpriority AS title, o_orderkey % 6 AS total, o_orderkey % 5 AS n FROM orders) WHERE total >= 4 QUALIFY rank <= 10")
def top_opportunities(spark: SparkSession, sf: str) -> DataFrame:
    key = c("o_orderkey")
    people = F.slice(F.array(*[F.lit(f"p{k}") for k in range(1, 6)]), F.lit(1), (key % 5).cast("int"))
    rows = table(spark, sf, "orders").select(key.cast("string").alias("meeting_id"), c("o_orderpriority").alias("title"), F.lit(None).cast("date").alias("date"), people.alias("participants"), (key % 6).alias("total_qualified_sections"))
    return sinks.opportunities(rows).select(c("rank").cast("bigint").alias("rank"), "title", "score", "participants")


@R.query("""
SELECT model, count(*) AS runs, count(score) AS succeeded, round(count(score) * 100.0 / count(*), 2) AS success_rate, round(avg(score), 3) AS avg_score, count(*) FILTER (score >= 3) AS qualified
FROM (SELECT 'plain' AS model, n AS score FROM (SELECT """ + _QUALIFIED.replace(_ANSWERED, "true") + """ AS n FROM documents)
      UNION ALL SELECT 'broken', CASE WHEN doc_id % 7 = 0 AND doc_id % 2 = 1 THEN 0 ELSE n END FROM (SELECT doc_id, """ + _QUALIFIED.replace(_ANSWERED, "doc_id % 7 <> 0") + """ AS n FROM documents)) GROUP BY 1""")
def models_compared(spark: SparkSession, sf: str) -> DataFrame:
    """Two completers over the same rows: one sound, one that breaks on some."""
    from colloquy.operators import reports

    docs = table(spark, sf, "documents").select("doc_id", F.concat_ws(" ", c("doc_id"), F.coalesce("text", F.lit(""))).alias("context"))
    scores = completion.compare(docs, "doc_id", {p: p for p in completion.SECTIONS}, "context", {"plain": lambda: Echo(False), "broken": Echo})
    return reports.compare_models(scores)
