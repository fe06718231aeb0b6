import json

import pytest
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.operators import clients, redaction, store, talent

GOOD = {
    "talent_now": {"role": "Designer", "seniority": "senior", "company_type": "agency", "company_industry": "media", "employment_status": "employed"},
    "talent_motivation": {"primary_driver": "salary", "better_description": "more"},
    "talent_market": {"openness_to_move": 3, "current_comp_structured": {"currency": "GBP", "period": "day", "amount_min": 450.0, "amount_max": 450.0}},
    "talent_leads": {"companies_mentioned": ["x"]},
    "mentioned_companies": [{"name": "akqa MEDIA", "type": "client", "sentiment": "mixed", "evidence_quote": "q", "source": "candidate"}, {"name": "Zed", "type": "other", "sentiment": "neutral", "evidence_quote": "q", "source": "recruiter"}],
    "perception_themes": [{"company_name": "Zed", "theme": "brand", "polarity": "praise", "evidence_quote": "q", "source": "candidate"}],
    "articulated_blockers": [{"company_name": None, "category": "scope", "evidence_quote": "q"}],
}


OWN = ("house", "ann", "bob")


def changed(path, value):
    made = json.loads(json.dumps(GOOD))
    spot = made
    for step in path[:-1]:
        spot = spot[step]
    spot[path[-1]] = value
    return made


CASES = {
    "ok": (GOOD, None), "driver": (changed(("talent_motivation", "primary_driver"), "fame"), "primary_driver"), "range": (changed(("talent_market", "openness_to_move"), 6), "openness_to_move"),
    "type": (changed(("mentioned_companies", 0, "type"), "enemy"), "mentioned_companies"), "theme": (changed(("perception_themes", 0, "theme"), "smell"), "perception_themes"),
    "category": (changed(("articulated_blockers", 0, "category"), "x"), "articulated_blockers"), "status": (changed(("talent_now", "employment_status"), "busy"), "employment_status"),
    "preference": (changed(("talent_motivation", "employment_preference"), "x"), "employment_preference"), "roles": (changed(("talent_now", "employment_status"), "between_roles"), None),
    "comp": (changed(("talent_market", "current_comp_structured", "amount_min"), 4.5), None),
}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(k, json.dumps(a)) for k, (a, _) in CASES.items()] + [("none", "no json"), ("null", None)], "meeting_id string, answer string")
    maps = spark.createDataFrame([("AKQA Media", "AKQA")], "variant_name string, canonical_name string")
    return {r.meeting_id: r for r in talent.score(df, "answer", maps).collect()}


def test_closed_vocabularies_reject_rows(rows):
    assert {k: rows[k].reject for k in CASES} == {k: why for k, (_, why) in CASES.items()}
    assert rows["none"].reject == rows["null"].reject == "no extraction"


def test_canonical_names_keep_their_places(rows):
    assert [c.name for c in rows["ok"].mentioned_companies] == ["AKQA", "Zed"]
    assert rows["ok"].articulated_blockers[0].company_name is None


def test_invariants_and_plausibility(rows):
    now = rows["roles"].talent_now
    assert (now.company_type, now.company_industry, now.role, now.seniority) == (None, None, "Designer", "senior")
    assert rows["ok"].talent_now.company_type == "agency"
    assert rows["ok"].talent_market.current_comp_structured.plausible is True
    assert rows["comp"].talent_market.current_comp_structured.plausible is False
    assert rows["ok"].talent_market.expected_comp_structured is None


def test_screening(spark):
    df = spark.createDataFrame([(1, "I have epilepsy."), (2, "All fine.")], "id int, full_transcript string")
    detect = redaction.dictionary_detector({"health": ("epilepsy",)})
    flag = {r.id: r for r in talent.screen(df, detect).collect()}
    assert flag[1].article9_flags[0].span == "epilepsy" and flag[1].article9_status == "flag" and flag[2].article9_flags == []
    red = {r.id: r for r in talent.screen(df, detect, Config(redact_mode="redact")).collect()}
    assert red[1].full_transcript == "I have [REDACTED:health]." and red[1].article9_flags[0].span is None
    assert (red[1].article9_flags[0].raw_scrub, red[1].article9_flags[0].redact_rounds, red[1].article9_status) == ("confirmed", 1, "redacted")


def test_screening_scrubs_all_text_fields(spark):
    row = (1, "I have epilepsy.", "Has Epilepsy; a wheelchair", None, [("09:00", "Ann", "my epilepsy, Epilepsy"), (None, None, None)])
    df = spark.createDataFrame([row, (2, None, None, "Fine.", None)], "id int, full_transcript string, enhanced_notes string, my_notes string, notes array<struct<t: string, speaker: string, text: string>>")
    detect = redaction.dictionary_detector({"health": ("epilepsy", "wheelchair")})
    got = {r.id: r for r in talent.screen(df, detect, Config(redact_mode="redact")).collect()}
    mark = "[REDACTED:health]"
    assert (got[1].full_transcript, got[1].enhanced_notes, got[1].my_notes) == (f"I have {mark}.", f"Has {mark}; a {mark}", None)
    assert [tuple(n) for n in got[1].notes] == [("09:00", "Ann", f"my {mark}, {mark}"), (None, None, None)]
    assert [(f.location, f.span, f.raw_scrub) for f in got[1].article9_flags] == [("full_transcript", None, "confirmed"), ("enhanced_notes", None, "confirmed")]
    assert (got[2].my_notes, got[2].notes, got[2].article9_flags) == ("Fine.", None, [])
    kept = talent.screen(df, detect).filter("id = 1").first()
    assert kept.enhanced_notes == row[2] and kept.article9_flags[0].span == "epilepsy"


@pytest.mark.parametrize(
    ("title", "want"),
    [("Zenith x House Team", "Zenith"), ("House x Zenith - Q3", "Zenith"), ("Acme sync x House", "Acme"), ("Acme - intro", "Acme"), ("ann x bob", None), ("House", None), ("Foo bar", "Foo"), ("lower case", None), ("", None), (None, None)],
)
def test_client_from_title(spark, title, want):
    assert spark.range(1).select(clients.from_title(F.lit(title).cast("string"), OWN)).first()[0] == want


def test_client_tiers(spark):
    kind = schemas.CLIENT_INFO
    classes = [("saas", ("platform",))]
    df = spark.createDataFrame([("Told", "T x House", "a-b", "Co", ""), (" ", "Acme x House", "a-b", "Co", ""), (None, "House", "auto-big-client-1693737600", "Co", ""), (None, None, "single", "Co", "our Platform"), (None, None, "single", None, "")], "c string, title string, id string, company string, text string")
    answer = F.when(F.col("c").isNotNull(), F.struct(F.lit(None).cast("string").alias("client_id"), F.col("c").alias("client"), *[F.lit(None).cast("string").alias(x) for x in ("domain", "size")], F.lit("llm").alias("source")).cast(kind))
    got = [r.i for r in df.select(clients.info(answer, F.col("title"), F.col("id"), F.col("company"), F.col("text"), classes, OWN).alias("i")).collect()]
    assert [(i.client, i.source, i.domain) for i in got] == [("Told", "llm", None), ("Acme", "title", None), ("Big Client", "filename", None), ("Co", "domain", "saas"), ("Unknown", "domain", None)]


def test_texts_for_completers(spark):
    notes = F.array(F.struct(F.lit("09:00").alias("t"), F.lit("Ann").alias("speaker"), F.lit("hi").alias("text")), F.struct(F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("speaker"), F.lit("bare").alias("text")))
    show = lambda c: spark.range(1).select(c).first()[0]
    assert show(clients.notes_text(notes)) == "[09:00] Ann: hi\nbare" and show(clients.notes_text(notes, 1)) == "[09:00] Ann: hi"
    assert len(show(clients.talent_text(F.lit(None).cast("string"), F.lit("x" * 130_000), notes))) == 120_000 + len("\n...\n[Transcript truncated]")
    assert show(clients.talent_text(F.lit(" e "), F.lit(" "), notes)) == "e"
    assert show(clients.client_text(F.lit("n" * 150), F.lit("f" * 4000), notes)).endswith("fff...\n[Transcript truncated]")
    assert show(clients.client_text(F.lit("n" * 1000), F.lit("full"), notes)) == "n" * 1000
    assert show(clients.client_text(F.lit("short"), F.lit("full"), notes)) == "[09:00] Ann: hi\nbare"


def test_tables_by_name(spark, tmp_path):
    store.create_database(spark, "meetings_test")
    store.create_table(spark, "meetings_test.maps", schemas.MAPPINGS)
    store.create_table(spark, "meetings_test.maps", schemas.MAPPINGS)
    wider = schemas.MAPPINGS.__class__([*schemas.MAPPINGS.fields]).add("extra", "integer")
    assert store.evolve_table(spark, "meetings_test.maps", wider, apply=False) == ["extra"]
    assert store.evolve_table(spark, "meetings_test.maps", wider) == ["extra"] and store.evolve_table(spark, "meetings_test.maps", wider) == []
    assert store.mappings(spark, "meetings_test.maps").count() == store.mappings(spark, "meetings_test.nothing").count() == 0
    spark.sql("DROP DATABASE meetings_test CASCADE")
    calls = spark.createDataFrame([("l", "m", "client", "gpt-5", "now", 1, 2, 0.1, None)], schemas.COST_LOG)
    assert store.log_calls(calls, f"{tmp_path}/log") and spark.read.parquet(f"{tmp_path}/log").count() == 1
    assert not store.log_calls(calls, f"{tmp_path}/log", Config(cost_log_disabled=True))
    assert not store.log_calls(calls.drop("model"), f"{tmp_path}/log")


def test_staging_and_documents(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text('{"meeting_id": "a"}\n{"meeting_id": "b", "title": "t"}\n')
    assert store.staged(spark, f"{tmp_path}/rows.jsonl", schemas.MEETING_INTEL).count() == 2
    assert store.staged(spark, f"{tmp_path}/rows.jsonl").columns == ["meeting_id", "title"]
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text('{\n"meeting_id": "a", "date": "2024-01-02"\n}')
    (tmp_path / "docs" / "b.json").write_text("{broken")
    got = store.documents(spark, f"{tmp_path}/docs").collect()
    assert sorted((r.meeting_id or "", r._corrupt is None) for r in got) == [("", False), ("a", True)]


def test_claims(spark):
    asked = spark.createDataFrame([("a", "d1", 1), ("a", "d1", 2), ("b", "d1", 3), ("a", "d2", 4)], "key string, day string, n int")
    held = spark.createDataFrame([("b", "d1")], "key string, day string")
    granted, claims = store.acquire(asked, held, ["n"])
    assert sorted((r.key, r.day) for r in granted.collect()) == [("a", "d1"), ("a", "d2")] and claims.count() == 3
    assert store.release(claims, granted.filter("day = 'd2'")).count() == 2
    assert sorted(r.n for r in granted.collect()) == [1, 4]
    key = spark.range(1).select(store.request_key(F.lit("call"), F.lit(None).cast("string"), F.lit("e1"))).first()[0]
    assert key == "auto-call-e1"


def test_each_row_to_its_file(spark, tmp_path):
    store.write_each(spark.createDataFrame([("a/b", 1), ("c", 2)], "id string, n int"), F.translate("id", "/", "_"), f"{tmp_path}/each")
    assert sorted(p.name for p in (tmp_path / "each").iterdir() if p.is_dir()) == ["name=a_b", "name=c"]


def test_required_columns_and_defaults(spark):
    spark.sql("DROP TABLE IF EXISTS strict_maps")
    store.create_table(spark, "strict_maps", schemas.MAPPINGS, schemas.REQUIRED["mappings"], schemas.DEFAULTS["mappings"])
    pair = "variant_name string, canonical_name string"
    try:
        store.insert(spark.createDataFrame([("a", "A")], pair), "strict_maps")
        row = spark.table("strict_maps").first()
        assert (row.variant_name, row.canonical_name, row.notes) == ("a", "A", None) and row.created_at is not None and row.updated_at is not None
        with pytest.raises(Exception, match="canonical_name is required"):
            store.insert(spark.createDataFrame([("b", "B"), ("c", None)], pair), "strict_maps")
        with pytest.raises(ValueError, match="canonical_name"):
            store.insert(spark.createDataFrame([("b",)], "variant_name string"), "strict_maps")
        assert spark.table("strict_maps").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS strict_maps")


def test_documents_are_written_by_many_tasks(spark, tmp_path):
    store.write_each(spark.range(40).coalesce(1), F.col("id").cast("string"), f"{tmp_path}/each")
    parts = {f.name.split("-")[1] for f in tmp_path.glob("each/*/part-*")}
    assert len(parts) > 1 and len([*tmp_path.glob("each/name=*")]) == 40
