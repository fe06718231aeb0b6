"""Parsing, scoring and redaction as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.config import Config
from colloquy.functions import columns as C
from colloquy.operators import clients, names, redaction, reports, scoring, store, talent
from colloquy.plans.registry import Registry
from colloquy.sources import table, transcripts

R = Registry()
VOCABULARY = ["the", "of", "and", "la", "die", "que"]
_IN_VOCABULARY = "[" + ", ".join(f"'{w}'" for w in VOCABULARY) + "]"


@R.query(f"SELECT doc_id, list_filter(string_split(lower(text), ' '), lambda w: list_contains({_IN_VOCABULARY}, w))[1:5] AS labels FROM documents")
def taxonomy_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", names.in_vocabulary(F.split(F.lower("text"), " "), VOCABULARY).alias("labels"))


_TYPE_WORDS = "CASE WHEN p_partkey % 4 = 0 THEN ['Talent', ' evolve ', 'x'] WHEN p_partkey % 4 = 1 THEN ['ACCESS', 'talent'] WHEN p_partkey % 4 = 2 THEN ['venture', 'ventures', 'Transform'] ELSE ['none'] END"
_ALIAS_MAP = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in names.FIT_ALIASES.items()) + "}"
_SERVICES = f"list_filter(list_transform({_TYPE_WORDS}, lambda x: {_ALIAS_MAP}[lower(trim(x))]), lambda x: x IS NOT NULL)"


def _words(spark: SparkSession, sf: str) -> DataFrame:
    lists, k = [["Talent", " evolve ", "x"], ["ACCESS", "talent"], ["venture", "ventures", "Transform"], ["none"]], F.col("p_partkey") % 4
    arrays = F.array(*[F.array(*[F.lit(w) for w in ws]) for ws in lists])
    return table(spark, sf, "part").select("p_partkey", names.services(F.element_at(arrays, (k + 1).cast("int"))).alias("services"))


@R.query(f"SELECT p_partkey, list_sort(list_distinct({_SERVICES})) AS services FROM part")
def fit_services_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _words(spark, sf).withColumn("services", F.array_sort("services"))


@R.query(f"""
SELECT label, count(s) AS n FROM (VALUES ('Access'), ('Transform'), ('Ventures'), ('Other')) AS k(label)
LEFT JOIN (SELECT unnest(list_distinct({_SERVICES})) AS s FROM part) ON s = label GROUP BY 1""")
def fit_distribution(spark: SparkSession, sf: str) -> DataFrame:
    known = spark.createDataFrame([("Access",), ("Transform",), ("Ventures",), ("Other",)], "label string")
    return reports.label_counts(_words(spark, sf), "services", F.broadcast(known))


_SCORES = "[" + ", ".join(f"(l_orderkey * {k + 1} + l_linenumber) % 4" for k in range(8)) + "]"
_NAMES = "[" + ", ".join(f"'{n}'" for n in scoring.CRITERIA) + "]"


def _bands(steps, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN list_sum(scores) >= {n} THEN '{t}'" for n, t in steps) + f" ELSE '{rest}' END"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    scores = F.array(*[((F.col("l_orderkey") * (k + 1) + F.col("l_linenumber")) % 4).cast("int") for k in range(8)])
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scores.alias("scores"))


@R.query(f"SELECT l_orderkey, l_linenumber, CAST(list_sum(scores) AS INT) AS total, CAST(len(list_filter(scores, lambda s: s >= 2)) AS INT) AS total_qualified, {_bands(scoring.RATINGS, scoring.RATING_REST)} AS rating FROM (SELECT *, {_SCORES} AS scores FROM lineitem)")
def performance_rating(spark: SparkSession, sf: str) -> DataFrame:
    total = scoring.total(F.col("scores"))
    return _scored(spark, sf).select("l_orderkey", "l_linenumber", total.alias("total"), scoring.total_qualified(F.col("scores")).alias("total_qualified"), scoring.rating(total).alias("rating"))


def _named(test: str) -> str:
    return f"list_transform(list_filter(list_zip({_NAMES}, scores), lambda p: p[2] {test}), lambda p: p[1])[1:3]"


@R.query(f"SELECT l_orderkey, l_linenumber, {_named('= 3')} AS strengths, {_named('<= 1')} AS improvements, {_bands(scoring.COACHING, scoring.COACHING_REST)} AS coaching FROM (SELECT *, {_SCORES} AS scores FROM lineitem)")
def coaching_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("scores")
    return _scored(spark, sf).select("l_orderkey", "l_linenumber", scoring.strengths(s).alias("strengths"), scoring.improvements(s).alias("improvements"), scoring.coaching(scoring.total(s)).alias("coaching"))


@R.query("SELECT event_id, CAST(least(3, greatest(0, trunc(value / 20 - 1))) AS INT) AS score, least(3, greatest(0, trunc(value / 20 - 1))) >= 2 AS qualified FROM events")
def clamp_scores(spark: SparkSession, sf: str) -> DataFrame:
    score = C.clamp_score(F.col("value") / 20 - 1)
    return table(spark, sf, "events").select("event_id", score.alias("score"), (score >= 2).alias("qualified"))


@R.query("""
SELECT o_orderkey, CASE WHEN amount IS NULL THEN NULL WHEN period = 'day' THEN amount BETWEEN 50 AND 5000 WHEN period = 'hour' THEN amount BETWEEN 5 AND 500 WHEN period = 'year' THEN amount BETWEEN 10000 AND 2000000 END AS plausible
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'hour' WHEN 2 THEN 'year' ELSE 'other' END AS period, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 50 END AS amount FROM orders)""")
def comp_plausibility(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    period = F.when(key % 4 == 0, "day").when(key % 4 == 1, "hour").when(key % 4 == 2, "year").otherwise("other")
    amount = F.when(key % 7 != 0, F.col("o_totalprice") / 50)
    return table(spark, sf, "orders").select("o_orderkey", scoring.plausible(period, [amount, F.lit(None).cast("double")], Config().comp_bounds).alias("plausible"))


@R.query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS o_totalprice FROM orders")
def status_invariants(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return rows.withColumns(scoring.clear_unless(F.col("o_orderstatus") != "O", ["o_orderpriority", "o_totalprice"]))


@R.query(r"SELECT doc_id, nullif(array_to_string(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ')[1:25], ' '), '') AS evidence FROM documents")
def evidence_word_cap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", C.first_words(F.col("text")).alias("evidence"))


@R.query("""
SELECT conv_id, list(DISTINCT role ORDER BY role) AS participants, count(*) AS n_notes, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS full_transcript
FROM conversations GROUP BY 1""")
def meeting_view(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.from_turns(table(spark, sf, "conversations")).withColumn("participants", F.array_sort("participants"))


@R.query("""
SELECT conv_id, turn, role AS speaker, line AS text FROM (
SELECT conv_id, turn, role, trim(unnest(string_split(text, chr(10)))) AS line FROM conversations) WHERE line <> ''""")
def utterance_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every turn, with its speaker before it."""
    said = table(spark, sf, "conversations").withColumn("line", F.explode(F.split("text", "\n"))).filter(F.trim("line") != "")
    notes = said.select("conv_id", "turn", F.explode(transcripts.utterances(F.concat("role", F.lit(": "), "line"))).alias("n"))
    return notes.select("conv_id", "turn", "n.speaker", "n.text")


#: A trimmed `line` as a note, in SQL; what is none has a null text.
_NOTE = r"""
CASE WHEN regexp_matches(line, '^\[(\d{1,2}:\d{2}(?::\d{2})?)\]\s*([^:]+):\s*(.+)$') THEN regexp_extract(line, '^\[(\d{1,2}:\d{2}(?::\d{2})?)\]', 1) END AS t,
CASE WHEN regexp_matches(line, '^\[(\d{1,2}:\d{2}(?::\d{2})?)\]\s*([^:]+):\s*(.+)$') THEN trim(regexp_extract(line, '^\[[0-9:]+\]\s*([^:]+):', 1), ' ') WHEN regexp_matches(line, '^([^:]+):\s*(.+)$') THEN trim(regexp_extract(line, '^([^:]+):', 1), ' ') END AS speaker,
CASE WHEN regexp_matches(line, '^\[(\d{1,2}:\d{2}(?::\d{2})?)\]\s*([^:]+):\s*(.+)$') THEN trim(regexp_extract(line, '^\[[0-9:]+\]\s*[^:]+:\s*(.+)$', 1), ' ') WHEN regexp_matches(line, '^([^:]+):\s*(.+)$') THEN trim(regexp_extract(line, '^[^:]+:\s*(.+)$', 1), ' ') WHEN NOT regexp_matches(line, '^[-•*]') THEN line END AS text"""


@R.query(f"""
SELECT * FROM (SELECT conv_id, turn, {_NOTE} FROM (SELECT conv_id, turn, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM conversations) WHERE line <> '' AND NOT starts_with(line, '#') AND line <> '---') WHERE text IS NOT NULL""")
def utterance_lines(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "conversations").select("conv_id", "turn", F.explode(transcripts.utterances(F.col("text"))).alias("n"))
    return notes.select("conv_id", "turn", "n.*")


def _fenced(spark: SparkSession, sf: str) -> DataFrame:
    """Fenced files around the conversations' texts: as a title, as notes and as a transcript."""
    c = F.col
    header = F.to_json(F.struct(F.concat(F.lit("c"), "conv_id").alias("granola_note_id"), c("text").alias("title"), c("role").alias("creator_name")))
    body = F.concat(F.lit("```json\n"), header, F.lit("\n```\n## Enhanced Notes\n"), "text", F.lit("\n## Full Transcript\n"), "role", F.lit(": "), "text", F.lit("\n"))
    return table(spark, sf, "conversations").select("conv_id", "turn", body.alias("text"))


_BLANK = "' ' || chr(9) || chr(10) || chr(13)"


@R.query(f"SELECT conv_id, turn, trim(text, {_BLANK}) AS enhanced_notes, '' AS my_notes, trim(role || ': ' || text, {_BLANK}) AS full_transcript FROM conversations WHERE text IS NOT NULL")
def section_extract(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return _fenced(spark, sf).filter("text IS NOT NULL").select("conv_id", "turn", *[transcripts.section(text, s).alias(n) for s, n in zip(transcripts.SECTIONS, ("enhanced_notes", "my_notes", "full_transcript"))])


@R.query("SELECT conv_id, turn, true AS fenced, 'c' || conv_id AS granola_note_id, text AS title, role AS creator_name FROM conversations WHERE text IS NOT NULL")
def metadata_extract(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return _fenced(spark, sf).filter("text IS NOT NULL").select("conv_id", "turn", transcripts.is_fenced(text).alias("fenced"), transcripts.metadata(text).alias("m")).select("conv_id", "turn", "fenced", "m.granola_note_id", "m.title", "m.creator_name")


_PLAIN = "'---' || chr(10) || 'k: ' || conv_id || chr(10) || '---' || chr(10) || 'Date: 2024-01-01' || chr(10) || chr(10) || role || ' said ' || turn || chr(10) || '---' || chr(10) || 'end'"


@R.query(f"""
WITH l AS (SELECT key, pos - 1 AS pos, line FROM (SELECT conv_id || '-' || turn AS key, string_split({_PLAIN}, chr(10)) AS ls FROM conversations), LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos)),
s AS (SELECT *, CAST(sum(CASE WHEN line = '---' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY pos) AS BIGINT) AS dashes FROM l)
SELECT key, CAST(pos AS INT) AS pos, line, dashes, CASE WHEN line = '---' THEN 'fence' WHEN dashes = 1 THEN 'front matter' WHEN trim(line) = '' THEN 'blank' WHEN starts_with(line, 'Date:') THEN 'header' ELSE 'content' END AS kind FROM s""")
def plaintext_state_machine(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    body = F.concat(F.lit("---\nk: "), c("conv_id"), F.lit("\n---\nDate: 2024-01-01\n\n"), c("role"), F.lit(" said "), c("turn"), F.lit("\n---\nend"))
    docs = table(spark, sf, "conversations").select(F.concat(c("conv_id"), F.lit("-"), c("turn")).alias("key"), body.alias("text"))
    return transcripts.plain_lines(docs, "key", "text")


_WHOLE = "'---' || chr(10) || 'k: ' || conv_id || chr(10) || '---' || chr(10) || 'Date: 2024-01-01' || chr(10) || text || chr(10) || '___' || chr(10) || 'Metrics: ' || turn || chr(10) || 'Agenda:' || chr(10) || '---' || chr(10) || 'end'"


@R.query(rf"""
WITH l AS (SELECT k, conv_id, turn, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM (SELECT row_number() OVER () AS k, conv_id, turn, string_split({_WHOLE}, chr(10)) AS ls FROM conversations)),
b AS (SELECT *, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
d AS (SELECT *, sum(CASE WHEN line = '---' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY pos) AS dashes FROM b),
s AS (SELECT *, max(CASE WHEN line = '---' THEN dashes > 2 WHEN dashes = 1 THEN false ELSE line = '___' OR NOT regexp_matches(lower(raw), 'date:|participants:|attendees:') END) OVER (PARTITION BY k ORDER BY pos) AS started FROM d)
SELECT conv_id, turn, {_NOTE.replace("WHEN NOT regexp_matches(line, '^[-•*]') THEN line", "ELSE line")} FROM s
WHERE started AND dashes <> 1 AND line NOT IN ('', '---', '___') AND NOT regexp_matches(raw, '^(Date|Participants|Attendees):') AND NOT regexp_matches(raw, 'Key challenges:|Metrics:|Business context:|Performance metrics:')
  AND (regexp_matches(line, '^([^:]+):\s*(.+)$') OR (NOT regexp_matches(raw, '^[-•*]') AND NOT contains(right(raw, 20), ':')))""")
def plaintext_notes(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    body = F.concat(F.lit("---\nk: "), c("conv_id"), F.lit("\n---\nDate: 2024-01-01\n"), c("text"), F.lit("\n___\nMetrics: "), c("turn"), F.lit("\nAgenda:\n---\nend"))
    notes = table(spark, sf, "conversations").select("conv_id", "turn", F.explode(transcripts.plain_notes(body)).alias("n"))
    return notes.select("conv_id", "turn", "n.*")


# Words by which an industry is told, in the order they are tried.
INDUSTRIES = [
    ("fintech", ("fintech", "banking", "payments", "crypto")),
    ("healthcare", ("healthcare", "medical", "pharma", "biotech")),
    ("e-commerce", ("ecommerce", "retail", "marketplace", "shopping")),
    ("saas", ("saas", "software", "platform", "api")),
]


@R.query("SELECT doc_id, CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in ws) + f" THEN '{n}'" for n, ws in INDUSTRIES) + " END AS domain FROM documents")
def keyword_domain(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", C.first_class(F.col("text"), INDUSTRIES).alias("domain"))


SENSITIVE = {"health": ("the and", "der die"), "belief": ("of the",)}


def _scrub(t: str, span: str, category: str) -> str:
    """A flagged span's exact places, else its words with anything between them; spans are taken one after the other."""
    words = "[^\\pL\\pN_]+".join(span.split())
    return f"CASE WHEN NOT contains(lower(o), '{span}') THEN {t} WHEN contains(lower({t}), '{span}') THEN regexp_replace({t}, '{span}', '[REDACTED:{category}]', 'gi') ELSE regexp_replace({t}, '{words}', '[REDACTED:{category}]', 'gi') END AS {t}"


_SPANS = [(span, category) for category, spans in SENSITIVE.items() for span in spans]
_SCRUBBED = "(SELECT doc_id, text AS o, text AS t FROM documents)"
for _span, _category in _SPANS:
    _SCRUBBED = f"(SELECT doc_id, o, {_scrub('t', _span, _category)} FROM {_SCRUBBED})"


@R.query(f"SELECT doc_id, t AS text FROM {_SCRUBBED}")
def span_redaction(spark: SparkSession, sf: str) -> DataFrame:
    flags = redaction.dictionary_detector(SENSITIVE)(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", redaction.scrub_all(F.col("text"), flags).alias("text"))


_FLAGGED = "(contains(lower(o), 'the and') OR contains(lower(o), 'der die') OR contains(lower(o), 'of the'))"


@R.query(f"SELECT doc_id, t AS text, 'redacted' AS status, CAST({_FLAGGED} AS INT) AS rounds FROM {_SCRUBBED}")
def redact_to_clean(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return redaction.redact(docs, "text", redaction.dictionary_detector(SENSITIVE), rounds=2)


@R.query(f"SELECT doc_id, contains(lower(t), 'the and') OR contains(lower(t), 'of the') AS residue FROM {_SCRUBBED}")
def residue_check(spark: SparkSession, sf: str) -> DataFrame:
    flags = redaction.dictionary_detector(SENSITIVE)(F.col("text"))
    spans = F.array(F.lit("the and"), F.lit("of the"))
    return table(spark, sf, "documents").select("doc_id", redaction.residue(redaction.scrub_all(F.col("text"), flags), spans).alias("residue"))


@R.query(r"""
SELECT event_id, CASE WHEN regexp_full_match(trim(v), '[+-]?\d{1,18}') THEN CAST(trim(v) AS BIGINT) END AS whole
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' ' || event_id || ' ' WHEN 1 THEN '1.5' WHEN 2 THEN '1_000' ELSE event_type END AS v FROM events)""")
def safe_int(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    v = F.when(k % 4 == 0, F.concat(F.lit(" "), k, F.lit(" "))).when(k % 4 == 1, "1.5").when(k % 4 == 2, "1_000").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", C.safe_int(v).alias("whole"))


@R.query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(date_trunc('second', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS utc FROM events""")
def utc_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    text = F.when(k % 3 == 0, "no time").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    return table(spark, sf, "events").select("event_id", C.utc_timestamp(text).alias("utc"))


@R.query("""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'cached' WHEN event_id % 5 = 0 THEN 'duplicate' WHEN event_type <> 'error' THEN 'completed' WHEN value >= 50 THEN 'transient' ELSE 'permanent' END AS outcome FROM events""")
def outcome_classes(spark: SparkSession, sf: str) -> DataFrame:
    k, error = F.col("event_id"), F.when(F.col("event_type") == "error", F.lit("failed"))
    transient = scoring.is_transient(F.lit("http"), F.when(F.col("value") >= 50, 503).otherwise(400))
    return table(spark, sf, "events").select("event_id", scoring.outcome(k % 7 == 0, k % 5 != 0, error, transient).alias("outcome"))


@R.query("SELECT p_partkey, left(replace(replace(p_name || '/' || p_type, '/', '_'), chr(92), '_'), 20) AS name, CASE WHEN length(p_name) > 8 THEN left(p_name, 8) || '...' ELSE p_name END AS short, concat_ws('; ', p_brand, p_type) AS csv FROM part")
def export_fields(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return table(spark, sf, "part").select("p_partkey", C.file_safe(F.concat("p_name", F.lit("/"), "p_type"), 20).alias("name"), C.ellipsis(c("p_name"), 8).alias("short"), C.joined(F.array("p_brand", "p_type")).alias("csv"))


@R.query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n WHEN 3 THEN n WHEN 4 THEN string_split(n, ' ')[1] END AS client
FROM (SELECT p_partkey, upper(p_name) AS n FROM part)""")
def client_from_title(spark: SparkSession, sf: str) -> DataFrame:
    """Titles around the parts' names: either side of an x, before a dash with noise, first words, and no name at all."""
    name, kind, k = F.upper("p_name"), F.col("p_type"), F.col("p_partkey") % 6
    title = (
        F.when(k == 0, F.concat(name, F.lit(" Call x House"))).when(k == 1, F.concat(F.lit("house x "), name, F.lit(" - "), kind)).when(k == 2, F.concat(name, F.lit(" catch-up meeting"), F.lit(" x Ann")))
        .when(k == 3, F.concat(name, F.lit(" – "), kind)).when(k == 4, F.concat(name, F.lit(" "), kind)).otherwise(F.concat(F.lit("ann x office "), F.lower(name)))
    )
    title = F.when(k == 5, F.lit("ann x office")).otherwise(title)
    return table(spark, sf, "part").select("p_partkey", clients.from_title(title, ("house", "ann", "office")).alias("client"))


@R.query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN n WHEN 1 THEN n END AS client
FROM (SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS n FROM part)""")
def client_from_filename(spark: SparkSession, sf: str) -> DataFrame:
    """Ids made of the parts' names: with a kind and a number, with an end and more behind it, and of one part."""
    name, k = F.replace("p_name", F.lit(" "), F.lit("-")), F.col("p_partkey") % 3
    identity = F.when(k == 0, F.concat(F.lit("meeting-"), name, F.lit("-1693737600"), "p_partkey")).when(k == 1, F.concat(F.upper(name), F.lit("-transcript-7"))).otherwise(F.substring_index("p_name", " ", 1))
    return table(spark, sf, "part").select("p_partkey", clients.from_filename(identity).alias("client"))


@R.query("""
SELECT doc_id, CASE WHEN length(text) > 2000 THEN left(text, 2000) || '...' || chr(10) || '[Transcript truncated]' ELSE text END AS context FROM documents""")
def transcript_cap(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", clients.capped(F.col("text"), 2000).alias("context"))


@R.query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def outcome_tally(spark: SparkSession, sf: str) -> DataFrame:
    return store.tally(table(spark, sf, "events").select(F.col("event_type").alias("status")))


@R.query("SELECT doc_id AS seq, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS error FROM documents ORDER BY doc_id DESC LIMIT 10")
def recent_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return store.recent_jobs(table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("error")))


@R.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 'primary_driver' WHEN o_orderkey % 4 = 2 THEN 'openness_to_move' WHEN o_orderkey % 4 = 3 THEN 'no extraction' END AS reject,
       CASE WHEN o_orderkey % 4 <> 3 AND o_orderkey % 8 <> 0 THEN 'agency' END AS company_type, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderkey % 2 = 0 END AS plausible
FROM orders""")
def talent_rows(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(key % 8 == 0, "between_roles").otherwise("employed")
    driver = F.when(key % 4 == 1, "fame").otherwise("salary")
    amount = F.when(key % 2 == 0, "450").otherwise("4.5")
    openness = F.when(key % 4 == 2, "9").otherwise("3")
    answer = F.concat(
        F.lit('{"talent_now": {"role": "x", "company_type": "agency", "employment_status": "'), status, F.lit('"}, "talent_motivation": {"primary_driver": "'), driver,
        F.lit('", "better_description": "b"}, "talent_market": {"openness_to_move": '), openness, F.lit(', "current_comp_structured": {"period": "day", "amount_min": '), amount, F.lit("}}}"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(key % 4 != 3, answer).otherwise("no json").alias("answer"))
    empty = spark.createDataFrame([], "variant_name string, canonical_name string")
    scored = talent.score(rows, "answer", empty)
    return scored.select("o_orderkey", "reject", "talent_now.company_type", "talent_market.current_comp_structured.plausible")
