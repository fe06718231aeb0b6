import json

import pytest
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.functions import columns as C
from colloquy.operators import completion, costs, dedup, merge, names, redaction, routing, scoring, sinks


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", type(None): "string"}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


# --- merge -------------------------------------------------------------------------------------------


@pytest.fixture
def sides(spark):
    t = spark.createDataFrame([(1, "t1", "t1", "t1", "t1"), (2, "t2", "t2", "t2", "t2"), (None, "tn", "tn", "tn", "tn")], "k int, s string, c string, i string, o string")
    s = spark.createDataFrame([(1, None, None, "s1", "s1"), (3, "s3", "s3", "s3", "s3"), (None, "sn", "sn", "sn", "sn")], "k int, s string, c string, i string, o string")
    return t, s


def test_merge_truth_table(sides):
    rows = {(r.k, r._op): r for r in merge.merge(*sides, "k", set_=["s"], coalesce=["c"], insert_only=["i"]).collect()}
    assert tuple(rows[1, "update"])[1:5] == (None, "t1", "t1", "t1")
    assert tuple(rows[2, "keep"])[1:5] == ("t2",) * 4
    assert tuple(rows[3, "insert"])[1:5] == ("s3", "s3", "s3", None)
    assert (None, "keep") in rows and (None, "insert") in rows
    assert tuple(merge.stats(merge.merge(*sides, "k", set_=["s"])).first()) == (2, 1, 3)


def test_merge_refuses_two_sources_of_one_row(sides):
    t, s = sides
    with pytest.raises(Exception, match="several source rows"):
        merge.merge(t, s.union(s.filter("k = 1")), "k", set_=["s"]).collect()
    assert merge.merge(t, s.union(s.filter("k = 3")), "k", set_=["s"]).filter("k = 3").count() == 2


def test_domains_keep_each_others_columns(spark):
    row = {"meeting_id": "m", "title": "old", "my_notes": "kept", "offering": "o", "talent_narrative": "n"}
    target = spark.createDataFrame([row], schemas.MEETING_INTEL)
    source = spark.createDataFrame([{"meeting_id": "m", "title": "new"}], schemas.MEETING_INTEL)
    client, talent = merge.merge_by_domain(target, source, "client").first(), merge.merge_by_domain(target, source, "talent").first()
    assert (client.title, client.my_notes, client.offering, client.talent_narrative, client.scoring_domain) == ("new", "kept", None, "n", "client")
    assert (talent.title, talent.my_notes, talent.offering, talent.talent_narrative, talent.scoring_domain) == ("new", "kept", "o", None, "talent")
    with pytest.raises(ValueError):
        merge.merge_by_domain(target, source, "other")
    assert len(schemas.MEETING_INTEL.names) == 59
    assert len(schemas.SHARED + schemas.TEXTS + schemas.CLIENT_ONLY) == 47 and len(schemas.SHARED + schemas.TEXTS + schemas.TALENT_ONLY) == 31


def test_mapping_changes(spark):
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    t = spark.createDataFrame([("a", "A", None)], "variant_name string, canonical_name string, notes string").withColumns({"created_at": at("2024-01-01"), "updated_at": at("2024-01-01")})
    s = spark.createDataFrame([("a", "AA", "n"), ("b", "B", None)], "variant_name string, canonical_name string, notes string")
    got = {r.variant_name: r for r in merge.upsert_mapping(t, s, at("2024-02-02")).collect()}
    assert (got["a"].canonical_name, got["a"].created_at.month, got["a"].updated_at.month) == ("AA", 1, 2)
    assert got["b"].created_at.month == 2
    assert merge.delete(s, F.col("notes") == "n").count() == 1
    assert merge.missing_columns(s, schemas.MAPPINGS) == ["created_at", "updated_at"]
    assert merge.add_columns(s, schemas.MAPPINGS).columns == schemas.MAPPINGS.names


def test_relax(spark):
    schema = spark.range(1).select("id", F.lit(1).alias("x")).schema
    relaxed, changed, already, missing = merge.relax(schema, ["id", "gone"])
    assert relaxed["id"].nullable and changed == ["id"] and already == [] and missing == ["gone"]


# --- dedup, names, routing ----------------------------------------------------------------------------


def test_dedup(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], "k int, at int, v string")
    assert sorted(r.v for r in dedup.latest_wins(df, ["k"], [F.desc("at")]).collect()) == ["b", "c", "d"]
    assert tuple(dedup.duplicate_count(df, "k").first()) == (4, 2, 2)
    assert [tuple(r) for r in dedup.violations(df, "k").collect()] == [(1, 2)]
    claims = spark.createDataFrame([(1, "failed"), (2, "completed")], "k int, status string")
    assert sorted(str(r.k) for r in dedup.unclaimed(df, claims, ["k"]).collect()) == ["1", "1", "None"]


def test_names(spark):
    df = spark.createDataFrame([(" akqa MEDIA ",), ("Other",), (None,)], "n string")
    maps = spark.createDataFrame([("AKQA media", "AKQA")], "variant_name string, canonical_name string")
    assert [r.c for r in names.canonical(df, "n", maps, "c").collect()] == ["AKQA", "Other", None]
    assert [r.c for r in names.canonical(df, "n", maps, "c", exact=True).collect()] == [" akqa MEDIA ", "Other", None]
    assert one(spark, names.services(F.array(F.lit("Evolve "), F.lit("transform"), F.lit("no"), F.lit("VENTURE")))) == ["Transform", "Ventures"]
    assert one(spark, names.in_vocabulary(F.array(*[F.lit(x) for x in "abcabca"]), ["a", "c"])) == ["a", "c", "a", "c", "a"]


def test_routing(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("client",), (" Talent ",), ("other",)], "s string")
    assert [(r.route, r.reject) for r in routing.route(df, "s").collect()] == [(None, "missing source")] * 3 + [("client", None), ("talent", None), (None, "unknown source")]
    poison = lambda i, s, n: one(spark, routing.poison_key(F.lit(i), F.lit(s), F.lit(n)))
    assert [poison("tmp1", "tmp1", None), poison("", "x", "n"), poison("tmp1", "tmp1", "n"), poison("real", "tmp1", None), poison(None, "x", None)] == [True, True, False, False, True]
    m = spark.sql("SELECT map('a', '1', 'source', ' ') AS m")
    assert m.select(routing.without_source(F.col("m"))).first()[0]
    assert m.select(routing.with_entry(F.col("m"), "source", F.lit("talent"))).first()[0] == {"a": "1", "source": "talent"}
    key = lambda *parts: one(spark, routing.cache_key(F.lit("2024-01-02").cast("date"), *map(F.lit, parts)))
    assert key("abc-123", "gpt-5-mini", "client") == "cache/2024-01-02/abc-123-gpt-5-mini-client.json"


# --- costs and scoring ----------------------------------------------------------------------------------


def test_costs(spark):
    calls = spark.createDataFrame([("gpt-5-mini", 1000, 1000), ("gpt-5-mini", 0, 0), ("nope", 100, 100), ("gpt-4o-2024-08-06", 1000, 0), ("gpt-5-mini-snapshot-2026", 1000, 0)], "model string, i bigint, o bigint")
    rated = costs.by_longest_prefix(calls, costs.prices(spark)).select("model", costs.cost(F.col("i"), F.col("o"), F.col("rate_in"), F.col("rate_out")).alias("usd"))
    assert [r.usd for r in rated.orderBy("model", "usd").collect()] == [0.0025, 0.0, 0.00225, 0.00025, None]
    first = {r.model: r.config for r in costs.by_first_prefix(calls.union(spark.createDataFrame([("gpt-5-mini-x", 0, 0)], calls.schema)), costs.prices(spark)).collect()}
    assert first["gpt-5-mini"] == "gpt-5-mini" and first["gpt-5-mini-x"] == "gpt-5" and first["nope"] is None
    n = F.lit(None).cast("bigint")
    both = lambda *x: tuple(one(spark, costs.tokens(*[n if v is None else F.lit(v).cast("bigint") for v in x])))
    assert [both(1, 2, None, None), both(1, None, 3, 4), both(1, None, None, 4)] == [(1, 2), (3, 4), (0, 0)]


@pytest.mark.parametrize(
    ("period", "low", "high", "want"),
    [("day", 450.0, 450.0, True), ("day", 4.5, None, False), ("hour", 1.25, None, False), ("year", 130000.0, None, True), ("day", 400.0, 9e6, False), ("day", None, None, None), ("other", 50000.0, None, None)],
)
def test_plausible(spark, period, low, high, want):
    amounts = [F.lit(low).cast("double"), F.lit(high).cast("double")]
    assert one(spark, scoring.plausible(F.lit(period), amounts, Config().comp_bounds)) is want


def test_bounds_from_the_environment(spark, monkeypatch):
    monkeypatch.setenv("COMP_PLAUSIBLE_DAY_MAX", "100")
    monkeypatch.setenv("ARTICLE9_MODE", "nonsense")
    config = Config.from_env()
    assert config.redact_mode == "flag"
    assert one(spark, scoring.plausible(F.lit("day"), [F.lit(450.0)], config.comp_bounds)) is False


def test_scores(spark):
    scores = F.array(*[F.lit(x) for x in (3, 3, 0, 3, 1, 3, 0, 1)])
    assert one(spark, scoring.total(scores)) == 14 and one(spark, scoring.total_qualified(scores)) == 4
    assert one(spark, scoring.strengths(scores)) == ["Introduction", "Discovery", "Solution"]
    assert one(spark, scoring.improvements(scores)) == ["Scoping", "Commercial", "Next Steps"]
    assert [one(spark, scoring.rating(F.lit(x))) for x in (24, 20, 16, 12, 11)] == ["Excellent", "Excellent", "Good", "Developing", "Needs Improvement"]
    assert [one(spark, scoring.is_transient(F.lit(k), F.lit(s))) for k, s in (("timeout", 0), ("http", 503), ("http", 429), ("http", 400))] == [True, True, True, False]


def test_columns(spark):
    assert one(spark, C.json_scalar("j", "$.a"), j='{"a": [1], "b": null}') is None
    assert one(spark, C.json_array("j", "$.a"), j='{"a": ["x"]}') == ["x"]
    assert [one(spark, C.clamp_score(F.col("v")), v=v) for v in (2.9, -1.0, 99.0)] == [2, 0, 3]
    assert [one(spark, C.safe_int(F.col("v")), v=v) for v in (" 12 ", "1.5", "1_000", "x", None)] == [12, None, None, None, None]
    assert one(spark, C.utc_timestamp(F.col("v")), v="2025-09-03T10:00:00+02:00") == "2025-09-03T08:00:00Z"
    assert one(spark, C.utc_timestamp(F.col("v")), v="bad") is None
    assert str(one(spark, C.week_start(F.lit("2024-01-10").cast("date")))) == "2024-01-07"
    assert one(spark, C.first_words(F.col("v"), 2), v="  a\n b c") == "a b" and one(spark, C.first_words(F.col("v")), v=" ") is None
    assert one(spark, C.ellipsis(F.col("v"), 3), v="abcd") == "abc..."


# --- redaction -----------------------------------------------------------------------------------------


def flags(*pairs):
    return F.array(*[F.struct(F.lit(c).alias("category"), F.lit(s).alias("span")) for c, s in pairs])


@pytest.mark.parametrize(
    ("text", "span", "want"),
    [
        ("I was diagnosed with epilepsy last year", "Epilepsy", "I was diagnosed with [REDACTED:health] last year"),
        ("I've got a heart-condition, honestly.", "heart condition", "I've got a [REDACTED:health], honestly."),
        ("price (x+y)*2 \\E end", "(X+Y)*2 \\E", "price [REDACTED:health] end"),
        ("nothing here", "asthma", "nothing here"), ("a b", "", "a b"), ("a b", "!?", "a b"),
    ],
)
def test_scrub(spark, text, span, want):
    assert one(spark, redaction.scrub_all(F.lit(text), flags(("health", span)))) == want


def test_redaction_loop(spark):
    df = spark.createDataFrame([(1, "I have ADHD. We discussed my adhd diagnosis."), (2, "fine"), (3, None)], "id int, text string")
    detect = redaction.dictionary_detector({"health": ("adhd",)})
    got = {r.id: r for r in redaction.redact(df, "text", detect).collect()}
    assert "adhd" not in got[1].text.lower() and (got[1].status, got[1].rounds) == ("redacted", 1)
    assert (got[2].text, got[2].rounds) == ("fine", 0)
    stubborn = lambda text: F.array(F.struct(F.lit("health").alias("category"), F.lit("zz").alias("span"), F.lit(0.9).alias("confidence")))
    assert redaction.redact(df, "text", stubborn, rounds=2).count() == 0
    fell = redaction.redact(df, "text", stubborn, rounds=2, on_failure="fallback").first()
    assert (fell.status, fell.text) == ("redact_fallback", df.first().text)
    assert redaction.redact(df, "text", stubborn, mode="flag").first().status == "flag"
    assert one(spark, redaction.residue(F.lit("My ADHD"), F.array(F.lit("adhd")))) is True


# --- completion ----------------------------------------------------------------------------------------


def test_retries():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise completion.Transient("busy", 503)
        return "ok"

    assert completion.with_retries(flaky, Config(), waits.append) == "ok"
    assert len(calls) == 3 and waits[0] >= 1 and waits[1] >= 2
    waits.clear()
    with pytest.raises(completion.Transient):
        completion.with_retries(lambda: (_ for _ in ()).throw(completion.Transient("no", 500)), Config(retry_attempts=4, retry_max_s=4.0), waits.append)
    assert len(waits) == 3 and max(waits) <= 5
    with pytest.raises(ValueError):
        completion.with_retries(lambda: int("x"), Config(), waits.append)


def test_scoring_from_recorded_answers(spark):
    good = json.dumps({"qualified": True, "reason": "r", "summary": "s", "evidence": " ".join("abcdefghijklmnopqrstuvwxyz" + "012")})
    answers = {"p-now": good, "p-next": good, "p-measure": '{"qualified": "yes"}', "p-blocker": None, "p-fit": json.dumps({**json.loads(good), "services": ["evolve", "x"]})}
    answers |= {f"s-{c}": json.dumps({"score": k, "reason": "r", "qualified": False, "evidence": None, "coaching_note": None}) for k, c in enumerate(schemas.SALES_CRITERIA)}
    prompts = {s: f"p-{s}" for s in completion.SECTIONS} | {f"sales_{c}": f"s-{c}" for c in schemas.SALES_CRITERIA}
    df = spark.createDataFrame([("m1", "text")], "meeting_id string, full_transcript string")
    raw = completion.ask(df, prompts, "full_transcript", lambda: completion.Recorded(answers))
    row = completion.sales(completion.opportunity(raw)).first()
    assert row.now.qualified and len(row.now.evidence.split()) == 25 and not row.measure.qualified and not row.blocker.qualified
    assert row.fit.services == ["Transform"] and row.fit.qualified
    assert (row.total_qualified_sections, row.qualified) == (3, True)
    assert (row.sales_introduction.score, row.sales_strategic_context.score, row.sales_total_score) == (0, 3, 0 + 1 + 2 + 3 * 5)
    assert row.sales_total_qualified == 6 and row.sales_scoping.qualified


def test_taxonomy(spark):
    answer = json.dumps({"challenges": ["Expand locations", "Made up", "Shrinking margin"], "results": "Revenue Growth", "offering": "Media"})
    df = spark.createDataFrame([(1, {"taxonomy": answer}), (2, {"taxonomy": "no json"}), (3, {})], "id int, raw map<string,string>")
    got = {r.id: r for r in completion.taxonomy(df).collect()}
    assert (got[1].challenges, got[1].results, got[1].offering) == (["Expand locations", "Shrinking margin"], [], "Media")
    assert all((got[k].challenges, got[k].results, got[k].offering) == ([], [], None) for k in (2, 3))


# --- sinks ---------------------------------------------------------------------------------------------


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], None), (2, None, "x|y")], "k int, tags array<string>, s string")
    assert [tuple(r) for r in sinks.flat(df).orderBy("k").collect()] == [("1", "a; b", ""), ("2", "", "x|y")]
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    path = f"{tmp_path}/t"
    assert sinks.table_info(spark, path) is None
    sinks.write(df, path, "empty")
    with pytest.raises(ValueError):
        sinks.write(df, path, "empty")
    sinks.write(df, path)
    assert spark.read.parquet(path).count() == 4
    assert sinks.replace_table(spark.read.parquet(path).filter("k = 1"), path).count() == 2
    assert sinks.table_info(spark, path)["rows"] == 2
    assert "x\\|y" in sinks.markdown(df, "t") and "<td>x|y</td>" in sinks.html_page(df, "t")
    assert one(spark, sinks.content_type(F.lit("a.b.JSON"))) == "application/json" and one(spark, sinks.content_type(F.lit("a.xyz"))) == "text/plain"


def test_answers_are_checked_and_asked_again():
    def ask(*answers, fallback=None, **more):
        left = list(answers)
        return completion.checked(lambda: left.pop(0), fallback, **more), len(left)

    good = '```json\n{"a": 1}\n```'
    assert ask("", None, good, "x") == (good, 1) and ask("", " ", "", "x") == ("", 1)
    assert ask("{", good, "x") == (good, 1) and ask("{", "[", "x") == ("[", 1)
    assert ask("{", "[", "x", fallback=lambda: "{}") == ("{}", 1)
    assert ask("told", "x", as_json=False) == ("told", 1)
