"""The talent domain's rows: closed vocabularies, invariants, plausibility, canonical names, and their pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.operators import completion, names, redaction, scoring
from colloquy.sources import files

# What the closed fields may hold.
STATUS = ("employed", "between_roles", "on_leave")
DRIVERS = ("progression", "salary", "the_work", "flexibility", "work_life_balance", "company_type_change", "employment_type_change", "benefits", "location", "leadership", "remote_work")
PREFERENCES = ("permanent", "freelance", "contract", "open")
CURRENCIES = ("GBP", "USD", "EUR", "other")
PERIODS = ("day", "hour", "year", "other")
COMPANY_TYPES = ("client", "competitor", "in_house", "independent", "other")
SENTIMENTS = ("positive", "negative", "neutral", "mixed")
SOURCES = ("candidate", "recruiter")
THEMES = ("brand", "leadership", "comp", "culture", "scope", "ambition", "flexibility", "stability")
POLARITIES = ("praise", "concern", "neutral")
BLOCKERS = ("comp_gap", "brand", "scope", "leadership", "stability", "flexibility", "other")
SPECIAL_CATEGORIES = ("racial_or_ethnic_origin", "political_opinions", "religious_or_philosophical_beliefs", "trade_union_membership", "genetic_data", "biometric_data", "health", "sex_life", "sexual_orientation")

#: What a structured extraction must look like.
EXTRACTION = f"talent_now {schemas.TALENT_NOW}, talent_triggers array<string>, talent_motivation {schemas.TALENT_MOTIVATION}, talent_market {schemas.TALENT_MARKET}, talent_leads {schemas.TALENT_LEADS}, mentioned_companies array<{schemas.COMPANY}>, perception_themes array<{schemas.THEME}>, articulated_blockers array<{schemas.BLOCKER}>"
EMPLOYER_FIELDS = ("company_type", "company_lifecycle", "company_discipline", "company_industry", "current_employer_hiring_signal")


def _optional(value: Column, allowed: tuple[str, ...]) -> Column:
    return value.isNull() | value.isin(*allowed)


def _required(value: Column, allowed: tuple[str, ...]) -> Column:
    return F.coalesce(value.isin(*allowed), F.lit(False))


def _each(array: str, ok) -> Column:
    return F.coalesce(F.forall(array, ok), F.lit(True))


def violation() -> Column:
    """The first rule that a row (columns of EXTRACTION) breaks, or null; such rows are rejected whole."""
    now, why, market = F.col("talent_now"), F.col("talent_motivation"), F.col("talent_market")
    comp = lambda c: _optional(c["currency"], CURRENCIES) & _optional(c["period"], PERIODS)
    rules = {
        "no extraction": now.isNotNull() & why.isNotNull(),
        "employment_status": _optional(now["employment_status"], STATUS),
        "primary_driver": _required(why["primary_driver"], DRIVERS),
        "better_description": why["better_description"].isNotNull(),
        "employment_preference": _optional(why["employment_preference"], PREFERENCES),
        "comp": F.coalesce(comp(market["current_comp_structured"]) & comp(market["expected_comp_structured"]), F.lit(True)),
        "openness_to_move": market["openness_to_move"].isNull() | market["openness_to_move"].between(1, 5),
        "mentioned_companies": _each("mentioned_companies", lambda c: c["name"].isNotNull() & _required(c["type"], COMPANY_TYPES) & _required(c["sentiment"], SENTIMENTS) & _required(c["source"], SOURCES) & c["evidence_quote"].isNotNull()),
        "perception_themes": _each("perception_themes", lambda t: t["company_name"].isNotNull() & _required(t["theme"], THEMES) & _required(t["polarity"], POLARITIES) & _required(t["source"], SOURCES)),
        "articulated_blockers": _each("articulated_blockers", lambda b: _required(b["category"], BLOCKERS) & b["evidence_quote"].isNotNull()),
    }
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])


def extracted(df: DataFrame, answer: str) -> DataFrame:
    """df with the columns of EXTRACTION read from a JSON answer, and `reject`."""
    read = df.withColumn("__e", F.from_json(answer, EXTRACTION))
    fields = [part.split()[0] for part in EXTRACTION.split(", ") if part.startswith(("talent_", "mentioned", "perception", "articulated"))]
    return read.withColumns({f: F.col(f"__e.{f}") for f in fields}).drop("__e").withColumn("reject", violation())


def with_invariants(now: Column) -> Column:
    """Between roles there is no employer; role and seniority are the person's own and stay."""
    gone = F.coalesce(now["employment_status"] == "between_roles", F.lit(False))
    return reduce(lambda out, f: out.withField(f, F.when(~gone, now[f])), EMPLOYER_FIELDS, now)


def with_plausible(comp: Column, config: Config) -> Column:
    return F.when(comp.isNotNull(), comp.withField("plausible", scoring.plausible(comp["period"], [comp["amount_min"], comp["amount_max"]], config.comp_bounds)))


def canonical_in_arrays(df: DataFrame, arrays: dict[str, str | None], mappings: DataFrame) -> DataFrame:
    """df with the names in some arrays (of strings, or of structs with the field given) made canonical, in their places.

    A small alias table is one map, broadcast with its one row, and names are looked up in place. A larger one is
    joined with the distinct arrays, whose result depends on nothing else, and these with df.
    """
    side = mappings.select(F.lower(F.trim("variant_name")).alias("variant"), "canonical_name").filter("variant IS NOT NULL").groupBy("variant").agg(F.min("canonical_name").alias("canonical"))
    rows = side.limit(names.BROADCAST_ROWS + 1).count()
    if rows > names.BROADCAST_ROWS:
        for array, field in arrays.items():
            df = _canonical_by_content(df, array, field, mappings)
        return df
    known = side.agg(F.map_from_entries(F.collect_list(F.struct("variant", "canonical"))).alias("__aliases")).withColumn("__one", F.lit(1))
    met = df.withColumn("__one", F.lit(1)).join(F.broadcast(known), "__one", "left")
    of = lambda name: F.coalesce(F.try_element_at("__aliases", F.lower(F.trim(name))), name)
    made = {array: F.transform(array, of) if field is None else _in_structs(array, field, of) for array, field in arrays.items()}
    return met.withColumns(made).drop("__one", "__aliases")


def _in_structs(array: str, field: str, of: Callable[[Column], Column]) -> Column:
    return F.transform(array, lambda x: x.withField(field, of(x[field])))


def _canonical_by_content(df: DataFrame, array: str, field: str | None, mappings: DataFrame) -> DataFrame:
    distinct = df.select(F.col(array).alias("__given")).filter("__given IS NOT NULL").distinct()
    items = distinct.select("__given", F.posexplode("__given").alias("pos", "item")).withColumn("__name", F.col("item") if field is None else F.col(f"item.{field}"))
    made = names.canonical(items, "__name", mappings, "__canonical_name")
    item = F.col("__canonical_name") if field is None else F.col("item").withField(field, F.col("__canonical_name"))
    back = made.groupBy("__given").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("item")))), lambda x: x["item"]).alias("__array"))
    return df.join(back, F.col(array) == F.col("__given"), "left").withColumn(array, F.coalesce("__array", array)).drop("__array", "__given")


def score(df: DataFrame, answer: str, mappings: DataFrame, config: Config = Config()) -> DataFrame:
    """Extraction answers as talent rows, with `reject` for those that break a rule."""
    rows = extracted(df, answer)
    rows = canonical_in_arrays(rows, {"mentioned_companies": "name", "perception_themes": "company_name", "articulated_blockers": "company_name"}, mappings)
    market = F.col("talent_market")
    for f in ("current_comp_structured", "expected_comp_structured"):
        market = market.withField(f, with_plausible(F.col("talent_market")[f], config))
    return rows.withColumns({"talent_now": with_invariants(F.col("talent_now")), "talent_market": market, "scoring_domain": F.lit("talent")})


#: What a narrative says that the completer gave no text for.
NO_NARRATIVE = "No summary: the narrative came back empty."


def narrative(rows: DataFrame, prompt: str, make: Callable[[], completion.Completer], config: Config = Config()) -> DataFrame:
    """rows with talent_narrative: what a completer says of the extraction alone, and NO_NARRATIVE if that is nothing.

    Rows that were rejected aren't asked for and have none."""
    fields = [part.split()[0] for part in EXTRACTION.split(", ") if part.startswith(("talent_", "mentioned", "perception", "articulated"))]
    given = rows.withColumn("__structured", F.when(F.col("reject").isNull(), F.to_json(F.struct(*fields))))
    asked = completion.ask(given.filter("__structured IS NOT NULL"), {"talent_narrative": prompt}, "__structured", make, config, prose=("talent_narrative",))
    text = F.coalesce(F.nullif(F.trim(F.try_element_at("raw", F.lit("talent_narrative"))), F.lit("")), F.lit(NO_NARRATIVE))
    rest = given.filter("__structured IS NULL").withColumn("talent_narrative", F.lit(None).cast("string"))
    return asked.withColumn("talent_narrative", text).drop("raw").unionByName(rest).drop("__structured")


def flags(detected: Column, redacted: Column, rounds: Column, place: Callable[[Column], Column] = lambda f: F.lit("full_transcript")) -> Column:
    """Detected spans as stored flags: once redacted the span itself is gone. `place`: the field that a flag stands in."""
    return F.transform(
        detected,
        lambda f: F.struct(
            f["category"].alias("category"), F.when(~redacted, f["span"]).alias("span"), place(f).alias("location"), f["confidence"].alias("confidence"),
            redacted.alias("redacted"), F.when(redacted, "confirmed").alias("raw_scrub"), F.when(redacted, rounds).alias("redact_rounds"),
        ),
    ).cast(f"array<{schemas.FLAG}>")


#: The text fields of a transcript besides its main one and the notes' texts.
TEXTS = ("enhanced_notes", "my_notes")


def screen(df: DataFrame, detect, config: Config = Config(), text: str = "full_transcript") -> DataFrame:
    """Transcripts with flags and status; in redact mode with the spans taken out of all text fields, failing closed.

    Fields are `text`, TEXTS and the notes' texts, as far as df has them; each is scrubbed of the spans found in any.
    """
    fields = [text, *[c for c in TEXTS if c in df.columns and c != text]]
    noted = "notes" in df.columns
    parts = F.array(*fields)
    if noted:
        parts = F.concat(parts, F.coalesce(F.transform("notes", lambda n: n["text"]), F.array().cast("array<string>")))
    detect_all = lambda texts: F.array_distinct(F.flatten(F.filter(F.transform(texts, detect), lambda f: f.isNotNull())))
    scrub_each = lambda texts, found: F.transform(texts, lambda t: redaction.scrub_all(t, found))
    seen = df.withColumn("__texts", parts).withColumns({"__before": F.col("__texts"), "__seen": detect_all(F.col("__texts"))})
    done = redaction.redact(seen, "__texts", detect_all, mode=config.redact_mode, rounds=config.max_redact_rounds, floor=config.min_confidence, on_failure=config.redact_on_failure, without=scrub_each)
    clean = F.col("status") == "redacted"
    spans = F.transform("__seen", lambda f: f["span"])
    left = clean & F.exists("__texts", lambda t: F.coalesce(redaction.residue(t, spans), F.lit(False)))
    holds = lambda f, k: F.coalesce(redaction.residue(F.get("__before", F.lit(k)), F.array(f["span"])), F.lit(False))
    place = lambda f: F.coalesce(*[F.when(holds(f, k), F.lit(c)) for k, c in enumerate(fields)], F.lit("notes" if noted else text))
    made = {c: F.get("__texts", F.lit(k)) for k, c in enumerate(fields)}
    if noted:
        made["notes"] = F.transform("notes", lambda n, k: n.withField("text", F.get("__texts", k + len(fields))))
    made |= {"article9_flags": flags(F.col("__seen"), clean, F.col("rounds"), place), "article9_status": F.col("status")}
    return done.filter(~left).withColumns(made).drop("__texts", "__before", "__seen", "status", "rounds")


#: How a detector answers: a JSON array of these.
DETECTED = "array<struct<category:string,span:string,confidence:double>>"


def detected(df: DataFrame, text: str, prompt: str, make: Callable[[], completion.Completer], config: Config = Config()) -> DataFrame:
    """df with `flags`: what a completer finds in a text; blank texts aren't asked about.

    An answer that is no list of flags is an error and not an empty list: what wasn't scanned must not go on.
    """
    asked = completion.ask(df.withColumn("__asked", F.col(text)), {"detection": prompt}, "__asked", lambda: _Unless(make()), config).drop("__asked")
    answer = completion.strip_fence(F.try_element_at("raw", F.lit("detection")))
    read = F.when(F.try_parse_json(answer).isNotNull() & answer.startswith("["), F.from_json(answer, DETECTED))
    failed = F.raise_error(F.lit("detection gave no list of flags")).cast(DETECTED)
    return asked.withColumn("flags", F.coalesce(read, failed)).drop("raw")


class _Unless:
    """A completer that isn't asked about blank texts."""

    def __init__(self, completer: completion.Completer):
        self.completer = completer

    def complete(self, prompt: str, context: str) -> str | None:
        return self.completer.complete(prompt, context) if context.strip() else "[]"


def screen_asked(df: DataFrame, text: str, prompt: str, make: Callable[[], completion.Completer], config: Config = Config()) -> DataFrame:
    """Like redaction.redact, with a completer as the detector: df with `text` scrubbed, `flags`, `status` and `rounds`.

    Each round asks about the texts that aren't clean yet, and is written to the shared folder, so that no question
    is asked twice; there are config.max_redact_rounds of them. Rows that don't become clean are dropped, or keep
    their text, as config.redact_on_failure says.
    """
    spark, folder = df.sparkSession, files.shared_folder(df.sparkSession, "screen")

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    sure = F.exists("flags", lambda f: f["confidence"] >= config.min_confidence)
    first = kept(detected(df.withColumn("__original", F.col(text)), text, prompt, make, config), "0")
    if config.redact_mode == "flag":
        return first.drop("__original").withColumns({"status": F.lit("flag"), "rounds": F.lit(0)})
    done, dirty = first.filter(~sure).withColumn("rounds", F.lit(0)), first.filter(sure)
    for k in range(1, config.max_redact_rounds + 1):
        if dirty.isEmpty():
            break
        scrubbed = dirty.withColumn(text, redaction.scrub_all(F.col(text), F.col("flags"))).withColumnRenamed("flags", "__before")
        again = kept(detected(scrubbed, text, prompt, make, config).withColumn("__all", F.array_distinct(F.concat("__before", "flags"))), str(k))
        clean, left = again.filter(~sure), again.filter(sure)
        done = done.unionByName(clean.withColumns({"flags": F.col("__before"), "rounds": F.lit(k)}).drop("__before", "__all"))
        dirty = left.withColumn("flags", F.col("__all")).drop("__before", "__all")
    out = done.withColumn("status", F.lit("redacted"))
    if config.redact_on_failure == "fallback":
        out = out.unionByName(dirty.withColumns({text: F.col("__original"), "rounds": F.lit(config.max_redact_rounds), "status": F.lit("redact_fallback")}))
    return out.drop("__original")
