import json

import pytest
from pyspark.sql import functions as F

from colloquy import cli, schemas
from colloquy.operators import sinks
from colloquy.plans import catalogue
from colloquy.sources import transcripts
from colloquy.streaming import upserts

PLAIN = """Meeting Notes - TechCorp Weekly Sync
Date: 2025-09-03
Participants: John Doe (CEO), Jane Smith (CTO)
[09:00] John: We need help now.
[09:01] Jane: By next month.
[09:02:30] John: Forty percent faster.
[09:03] Jane: Budget is the blocker.
"""
FENCED = """```json
{"granola_note_id": "test-123", "title": "Client Call", "creator_name": "Sam", "creator_email": "sam@example.org", "attendees": "Ann, Bob", "calendar_event_time": "2025-09-03T10:00:00+00:00", "zapier_step_id": "456"}
```
## Enhanced Notes
### Summary
They agreed.
## Full Transcript
John: Hello there
Jane: Hi
"""
BROKEN = """```json
{"granola_note_id": "test-456", "title": "Malformed Test", "attendees": email: ann@example.org
name: Ann,
"creator_name": "Sam", "calendar_event_id": , "calendar_event_time": "2025-09-04T10:00:00+00:00"}
```
## Full Transcript
John: Hello
"""


def files(spark, **texts):
    return spark.createDataFrame([(f"/x/{k}.txt", k, v) for k, v in texts.items()], "path string, stem string, text string")


def test_parse(spark):
    rows = {r.meeting_id: r for r in transcripts.parse(files(spark, plain=PLAIN, fenced=FENCED, broken=BROKEN, empty="")).collect()}
    p, f, b = rows["plain"], rows["test-123"], rows["test-456"]
    assert (p.source, str(p.date), p.company, len(p.participants)) == ("plaintext", "2025-09-03", "Meeting Notes", 2)
    assert sum(n.t is not None for n in p.notes) == 4 and sum(n.speaker is not None for n in p.notes) >= 4
    assert (f.source, f.title, f.creator_name, f.zapier_step_id, str(f.date)) == ("granola_drive", "Client Call", "Sam", "456", "2025-09-03")
    assert f.participants == ["Sam", "Ann", "Bob"] and f.my_notes == "" and f.enhanced_notes.endswith("They agreed.")
    assert f.full_transcript == "John: Hello there\nJane: Hi" and ("John", "Hello there") in [(n.speaker, n.text) for n in f.notes]
    assert (b.title, b.creator_name, b.reject) == ("Malformed Test", "Sam", None)
    assert rows["empty"].reject == "no date"


def test_scan_ingest_and_dedupe(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    (folder / "below").mkdir(parents=True)
    (folder / "a.md").write_text(FENCED)
    (folder / "b.txt").write_text(PLAIN)
    (folder / "c.txt").write_text("no date at all")
    (folder / "d.csv").write_text("x")
    (folder / "below" / "e.txt").write_text(PLAIN)
    found = transcripts.scan(spark, str(folder))
    assert sorted(r.stem for r in found.collect()) == ["a", "b", "c"] and transcripts.scan(spark, str(folder), limit=1).count() == 1
    assert cli.main(["ingest", str(folder), f"{tmp_path}/out", "--rejects", f"{tmp_path}/bad"]) == 0
    assert "2 transcripts, 1 rejected" in capsys.readouterr().out
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.columns == schemas.TRANSCRIPT.names and spark.read.parquet(f"{tmp_path}/bad").first().reject == "no date"
    spark.createDataFrame([("m", 1, "a"), ("m", 2, "b")], "meeting_id string, scored_at int, v string").write.parquet(f"{tmp_path}/t")
    assert cli.main(["dedupe", f"{tmp_path}/t"]) == 0
    assert [r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()] == ["b"]
    assert cli.main(["report", f"{tmp_path}/t", "v"]) == 0 and "| b | 1 | 100.0 |" in capsys.readouterr().out


def test_score_and_upload_commands(spark, tmp_path):
    transcripts.parse(files(spark, fenced=FENCED)).drop("reject").write.parquet(f"{tmp_path}/in")
    good = json.dumps({"qualified": True, "reason": "r", "summary": "s", "evidence": "e"})
    (tmp_path / "answers.json").write_text(json.dumps({"now": good, "next": good, "measure": good, "sales_discovery": json.dumps({"qualified": True, "score": 3, "reason": "r", "evidence": "e", "coaching_note": "n"}), "sales_scoping": '{"score": 3}'}))
    assert cli.main(["score", f"{tmp_path}/in", f"{tmp_path}/answers.json", f"{tmp_path}/out"]) == 0
    row = spark.read.parquet(f"{tmp_path}/out").first()
    assert (row.total_qualified_sections, row.qualified, row.sales_total_score) == (3, True, 3)
    assert cli.main(["upload", f"{tmp_path}/out", f"{tmp_path}/table", "--disposition", "empty"]) == 0
    with pytest.raises(ValueError):
        cli.main(["upload", f"{tmp_path}/out", f"{tmp_path}/table", "--disposition", "empty"])
    assert "qualified: True" in sinks.message(spark.read.parquet(f"{tmp_path}/out").select("qualified"), "scores")


def test_merge_command(spark, tmp_path):
    rows = lambda **x: spark.createDataFrame([x], schemas.MEETING_INTEL)
    rows(meeting_id="m", title="old", my_notes="kept").write.parquet(f"{tmp_path}/t")
    rows(meeting_id="m", title="new").write.parquet(f"{tmp_path}/s")
    assert cli.main(["merge", f"{tmp_path}/t", f"{tmp_path}/s", "--domain", "client"]) == 0
    row = spark.read.parquet(f"{tmp_path}/t").first()
    assert (row.title, row.my_notes, row.scoring_domain) == ("new", "kept", "client")


def test_state_machine_and_events(spark):
    lines = transcripts.plain_lines(files(spark, x="---\nkey: v\n---\nDate: 2024-01-01\nhello\n---\nbye"), "stem", "text").orderBy("pos")
    assert [r.kind for r in lines.collect()] == ["fence", "front matter", "fence", "header", "content", "fence", "content"]
    kind = lambda k, n: spark.range(1).select(transcripts.event_kind(F.lit(k), F.lit(n))).first()[0]
    final = "google.cloud.storage.object.v1.finalized"
    assert [kind(final, "transcripts/a.md"), kind(final, "transcripts/a.MD"), kind(final, "x/a.md"), kind("other", "transcripts/a.md")] == ["taken", "ignored", "ignored", "ignored"]


def test_streams(spark, tmp_path):
    made = spark.createDataFrame([(1, "2024-01-01 00:10:00", "a"), (1, "2024-01-01 00:20:00", "b"), (2, "2024-01-01 03:00:00", "a")], "k int, at string, event_type string").withColumn("ts", F.col("at").cast("timestamp"))
    made.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    state = upserts.replay(spark, f"{tmp_path}/events.parquet", "k", ["ts"])
    assert sorted((r.k, r.event_type) for r in state.collect()) == [(1, "b"), (2, "a")]
    assert sorted(r["count"] for r in upserts.hourly(made).collect()) == [1, 1, 1]
    source = spark.readStream.schema(made.schema).parquet(f"{tmp_path}/events.parquet")
    query = upserts.first_in_day(source, ["k"]).writeStream.format("memory").queryName("claims").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.k for r in spark.table("claims").collect()) == [1, 2]


def test_utterance_lines_takes_whole_texts(spark, tmp_path):
    said = "one\n\nAnn: two: more\n[09:00] Bob: three\n- bullet\nfour"
    spark.createDataFrame([(1, 0, "user", said), (2, 0, "user", "Ann: hi"), (3, 0, "user", None)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = catalogue.QUERIES["utterance_lines"](spark, str(tmp_path)).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, [(1, 0, None, None, "one"), (1, 0, None, "Ann", "two: more"), (1, 0, "09:00", "Bob", "three"), (1, 0, None, None, "four"), (2, 0, None, "Ann", "hi")]))


def test_filename_and_fallbacks(spark):
    head = '```json\n{"granola_note_id": "%s"%s}\n```\n## Enhanced Notes\n%s\n## Full Transcript\nAnn: hi\n'
    made = [
        ("[Sam] Acme Corp - Intro - 2025-09-03T10_00_00.000Z.txt", head % ("a", "", "x")),
        ("Sam - Call - 2025-09-04.txt", head % ("b", "", "Summary\nClient: Beta Ltd, London")),
        ("c.txt", head % ("c", ', "title": "Zenith - Q3", "calendar_event_time": "2025-09-05T10:00:00+00:00"', "x")),
        ("d.txt", "Date: 2025-09-06\nAnn Lee (CEO), Bob May (CTO)\nAnn: hi"),
        ("e.txt", "Title\nDate: 2025-09-07\nAttendees: Ann; Bob\nAnn: a, b (c)"),
    ]
    df = spark.createDataFrame([(f"file:/x/{n}", n.removesuffix(".txt"), t) for n, t in made], "path string, stem string, text string")
    got = {r.meeting_id: (str(r.date), r.company, r.title, r.participants, r.reject) for r in transcripts.parse(df).collect()}
    assert got["a"] == ("2025-09-03", "Acme Corp", "Acme Corp", [], None)
    assert got["b"] == ("2025-09-04", "Beta Ltd", "Call", [], None)
    assert got["c"] == ("2025-09-05", "Zenith", "Zenith - Q3", [], None)
    assert got["d"][0] == "2025-09-06" and got["d"][3] == ["Ann Lee (CEO)", "Bob May (CTO)"]
    assert got["e"][3] == ["Ann", "Bob"]
    name = spark.range(1).select(transcripts.from_filename(F.lit("[Sam] Acme - Extra - More - 2025.txt"))).first()[0]
    assert tuple(name) == ("Sam", "Acme", "More - 2025")


def test_plain_notes_leave_out_what_is_no_content(spark):
    text = "---\nk: v\n---\nMeeting date: 2024-01-01\nDate: 2024-01-01\n# Title\nMetrics: 3\n[09:00] Ann: hi\r\nAgenda for:\n- bullet\n  - kept\n___\nBob: Date: x\n---\nend"
    rows = {r.meeting_id: r for r in transcripts.parse(files(spark, x=text, y="Attendees: a\nhello", z="one\n---\nk: v")).collect()}
    assert [tuple(n) for n in rows["x"].notes] == [(None, None, "# Title"), ("09:00", "Ann", "hi"), (None, None, "- kept"), (None, "Bob", "Date: x"), (None, None, "end")]
    assert [tuple(n) for n in rows["y"].notes] == [(None, None, "hello")] and [tuple(n) for n in rows["z"].notes] == [(None, None, "one")]
    kinds = transcripts.plain_lines(files(spark, x=text), "stem", "text").orderBy("pos").collect()
    assert [r.kind for r in kinds] == ["fence", "front matter", "fence", "header", "header", "content", "header", *["content"] * 4, "rule", "content", "fence", "content"]


def test_compare_status_and_migrate_commands(spark, tmp_path, capsys):
    transcripts.parse(files(spark, fenced=FENCED)).drop("reject").write.parquet(f"{tmp_path}/in")
    good = json.dumps({"qualified": True, "reason": "r", "summary": "s", "evidence": "e"})
    (tmp_path / "a.json").write_text(json.dumps(dict.fromkeys(("now", "next", "measure", "blocker"), good) | {"fit": good[:-1] + ', "services": []}'}))
    (tmp_path / "b.json").write_text("{}")
    assert cli.main(["compare-models", f"{tmp_path}/in", f"one={tmp_path}/a.json", f"two={tmp_path}/b.json"]) == 0
    out = capsys.readouterr().out
    assert "| one | 1 | 1 | 100.0 | 5.0 | 1 |" in out and "| two | 1 | 0 | 0.0 |  | 0 |" in out
    with pytest.raises(SystemExit):
        cli.main(["compare-models", f"{tmp_path}/in", f"one={tmp_path}/a.json"])
    spark.sql("SELECT 'm' AS meeting_id, DATE '2024-01-05' AS date, 'Ann' AS salesperson_name, 17L AS sales_total_score, true AS sales_qualified").write.parquet(f"{tmp_path}/t")
    assert cli.main(["sales-status", f"{tmp_path}/t", "--as-of", "2024-01-06"]) == 0 and "| Ann | 1 | 17.0 | 100.0 |" in capsys.readouterr().out
    assert cli.main(["migrate", f"{tmp_path}/t"]) == 0 and "talent_now" in capsys.readouterr().out
    assert len(spark.read.parquet(f"{tmp_path}/t").columns) == 5
    assert cli.main(["migrate", f"{tmp_path}/t", "--apply"]) == 0
    assert set(schemas.MEETING_INTEL.names) <= set(spark.read.parquet(f"{tmp_path}/t").columns)


def test_talent_score_command(spark, tmp_path):
    transcripts.parse(files(spark, fenced=FENCED)).drop("reject").write.parquet(f"{tmp_path}/in")
    extraction = {"talent_now": {"role": "r"}, "talent_motivation": {"primary_driver": "salary", "better_description": "b"}}
    (tmp_path / "a.json").write_text(json.dumps({"talent_extraction": f"```json\n{json.dumps(extraction)}\n```", "talent_narrative": " Said. "}))
    assert cli.main(["score", f"{tmp_path}/in", f"{tmp_path}/a.json", f"{tmp_path}/out", "--domain", "talent"]) == 0
    row = spark.read.parquet(f"{tmp_path}/out").first()
    assert (row.reject, row.talent_now.role, row.talent_narrative, row.scoring_domain) == (None, "r", "Said.", "talent")


@pytest.mark.parametrize("text, want", [
    ('{"title": "a, b", "attendees": x: 1\ny: 2,\n"creator_name": , "zapier_step_id": 7}', ("a, b", "x: 1 y: 2", "", "7")),
    ('{"title": "q \\"r\\" s", "attendees": , }', ('q "r" s', "", None, None)),
    ('{"title": null, "attendees": "ok",, "creator_name": "c"}', (None, "ok", "c", None)),
])
def test_broken_headers_are_read_by_field(spark, text, want):
    m = spark.range(1).select(transcripts.by_field(F.lit(text)).alias("m")).first().m
    assert (m.title, m.attendees, m.creator_name, m.zapier_step_id) == want


def test_a_header_is_read_once_for_all_its_fields(spark):
    frame = spark.createDataFrame([("# T\n\n**Creator:** Ann (a@x.org)\n**Attendees:** Bob <b@x.org>, Cid (c@x.org)\n## Enhanced Notes\n",), (None,)], "text string")
    read = frame.select(transcripts.metadata(F.upper("text")).alias("m")).select("m.title", "m.creator_name", "m.attendees")
    assert [tuple(r) for r in read.collect()] == [("T", None, None), (None, None, None)]  # keys are told by their case
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1 and plan.count("```json") == 1
