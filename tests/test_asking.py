"""Answers of the wrong shape, questions under way, and a journal of answers that were paid for."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from colloquy.config import Config
from colloquy.operators import completion

GOOD = {"qualified": True, "reason": "r", "summary": "s", "evidence": "e"}
SALE = {"qualified": True, "score": 2, "reason": "r", "evidence": "e", "coaching_note": "n", "more": 1}


class Said:
    """Gives the answers of a list, one after the other, and keeps the prompts."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def complete(self, prompt, context):
        self.asked.append(prompt)
        return self.answers.pop(0)


def answers(said, name, **more):
    return completion.answer_all("text", {name: "P"}, said, None, Config(), (), **more)[name]


@pytest.mark.parametrize(("name", "bad"), [("now", GOOD | {"qualified": "true"}), ("now", GOOD | {"more": 1}), ("now", {"qualified": True}), ("now", [GOOD]), ("fit", {**GOOD, "service": []}), ("sales_scoping", {k: v for k, v in SALE.items() if k != "score"})])
def test_a_wrong_shape_is_asked_for_once_more(name, bad):
    good = json.dumps(SALE if name.startswith("sales") else GOOD)
    said = Said(json.dumps(bad), good)
    assert answers(said, name) == good and said.asked[0] == "P" and said.asked[1].startswith("P\n\n" + completion.AGAIN)
    said = Said(json.dumps(bad), json.dumps(bad))
    assert answers(said, name) == json.dumps(bad) and len(said.asked) == 2
    said = Said(f"```json\n{good}\n```")
    answers(said, name)
    assert len(said.asked) == 1
    assert answers(Said("[1]"), "taxonomy") == "[1]"


def test_sections_are_strict(spark):
    cases = [
        (GOOD, (True, "r", "s", "e")), (GOOD | {"qualified": "true"}, (False, completion.INVALID, completion.INVALID_QUALIFIED, None)), (GOOD | {"qualified": None}, (False, completion.INVALID, completion.INVALID_QUALIFIED, None)),
        (GOOD | {"qualified": 1}, (False, completion.INVALID, completion.INVALID_QUALIFIED, None)), (GOOD | {"x": 1}, (False, completion.INVALID, completion.INVALID_SECTION, None)), ([1], (False, "invalid response", None, None)),
        (GOOD | {"evidence": ["a", None, "", "b"]}, (True, "r", "s", "a b")),
    ]
    frame = spark.createDataFrame([(k, json.dumps(a)) for k, (a, _) in enumerate(cases)] + [(99, "no json"), (100, None)], "k int, a string")
    got = {r.k: tuple(r.s) for r in frame.select("k", completion.section(F.col("a")).alias("s")).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)} | {99: (False, "invalid response", None, None), 100: (False, "invalid response", None, None)}


def test_a_fit_section_keeps_what_looks_like_its_services(spark):
    said = GOOD | {"services": ["talent", "x"], "evidence": 'he said "services": [a, b] twice'}
    row = spark.createDataFrame([(json.dumps(said),)], "a string").select(completion.fit_section(F.col("a")).alias("f")).first().f
    assert row.evidence == 'he said "services": [a, b] twice' and row.services == ["Access"] and row.qualified


def test_scores_are_numbers(spark):
    cases = [(2, 2), ("3", 0), (2.9, 2), (7, 3), (-1, 0), (None, 0), ([3], 0)]
    frame = spark.createDataFrame([(k, json.dumps(SALE | {"score": s})) for k, (s, _) in enumerate(cases)] + [(50, json.dumps({"score": 3})), (51, None)], "k int, a string")
    got = {r.k: r.s for r in frame.select("k", completion.sales_section(F.col("a")).alias("s")).collect()}
    assert {k: got[k].score for k in range(len(cases))} == {k: want for k, (_, want) in enumerate(cases)}
    assert all(got[k].qualified == (got[k].score >= 2) for k in range(len(cases)))
    assert (got[50].score, got[50].reason, got[50].coaching_note, got[50].qualified) == (0, completion.INVALID, completion.INVALID_NOTE, False)
    assert got[51].score == 0 and got[51].reason is None


def slow():
    class Slow:
        """Counts what is under way in its task, and says it."""

        def __init__(self):
            self.now, self.lock = 0, threading.Lock()

        def complete(self, prompt, context):
            with self.lock:
                self.now += 1
                here = self.now
            time.sleep(0.05)
            with self.lock:
                self.now -= 1
            return json.dumps({"now": here})

    return Slow


def test_questions_under_way_reach_and_keep_their_bound(spark):
    frame = spark.range(40).selectExpr("CAST(id AS STRING) AS text")
    asked = completion.ask(frame, {"p": "P"}, "text", slow(), Config(scoring_max_concurrency=1, questions_in_flight=8))
    began = time.time()
    seen = [json.loads(r.raw["p"])["now"] for r in asked.collect()]
    assert max(seen) == 8 and len(seen) == 40 and time.time() - began < 40 * 0.05 + 20
    assert {json.loads(r.raw["p"])["now"] for r in completion.ask(frame, {"p": "P"}, "text", slow(), Config(scoring_max_concurrency=1, questions_in_flight=1)).collect()} == {1}


def test_a_pace_spaces_requests():
    now, slept = [0.0], []
    pace = completion.Pace(4, sleep=slept.append, clock=lambda: now[0])
    for _ in range(3):
        pace.wait()
    now[0] = 10.0
    pace.wait()
    assert slept == [0.25, 0.5]


def payer():
    class Paid:
        """Counts what it is asked in a folder, and breaks on a text until a file is there."""

        def __init__(self, folder, broken=None):
            self.folder, self.broken = folder, broken

        def complete(self, prompt, context):
            import os
            import uuid

            with open(f"{self.folder}/asked-{uuid.uuid4().hex}", "w") as f:
                f.write(f"{prompt}|{context}")
            if self.broken and context == "13" and not os.path.exists(self.broken):
                open(self.broken, "w").close()
                os._exit(1)  # as a lost executor
            return None if context == "3" else json.dumps({"said": context})

    return Paid


def paid(folder):
    return sorted(p.read_text() for p in folder.iterdir() if p.name.startswith("asked-"))


def test_a_journal_pays_once_over_jobs(spark, tmp_path):
    Paid = payer()
    folder, journal = tmp_path / "paid", f"{tmp_path}/journal"
    folder.mkdir()
    frame = spark.range(20).selectExpr("CAST(id AS STRING) AS text")
    said = completion.ask(frame, {"p": "P"}, "text", lambda: Paid(str(folder)), Config(scoring_max_concurrency=2), journal=journal, label="m1").collect()
    assert sum(r.raw["p"] is not None for r in said) == 19
    first = paid(folder)
    assert set(first) == {f"P|{k}" for k in range(20)} and len(first) == 22  # the empty answer is asked for three times
    again = completion.ask(frame, {"p": "P"}, "text", lambda: Paid(str(folder)), Config(scoring_max_concurrency=3), journal=journal, label="m1").collect()
    assert {(r.text, r.raw["p"]) for r in again} == {(r.text, r.raw["p"]) for r in said} and len(paid(folder)) == 25
    completion.ask(frame.limit(1), {"p": "P"}, "text", lambda: Paid(str(folder)), journal=journal, label="m2").collect()
    assert len(paid(folder)) == 26


def test_a_journal_is_found_by_any_path_of_its_folder(spark, tmp_path):
    folder, broken, Paid = tmp_path / "paid", f"{tmp_path}/broken", payer()
    folder.mkdir()
    journal = completion.Journal(Paid(str(folder)), f"{tmp_path}/journal", "m")
    assert [journal.complete("P", str(k)) for k in range(5)] == [None if k == 3 else json.dumps({"said": str(k)}) for k in range(5)]
    other = completion.Journal(Paid(str(folder), broken), f"file:{tmp_path}/journal", "m")
    assert other.complete("P", "2") == '{"said": "2"}' and len(paid(folder)) == 5
    assert completion.Journal(Paid(str(folder)), f"{tmp_path}/journal", "n").path("P", "2") != journal.path("P", "2")


def test_answers_are_validated_as_wide_as_shuffles_and_only_as_far_as_asked(spark):
    frame = spark.range(20).selectExpr("id", "CAST(id AS STRING) AS text", "IF(id % 2 = 0, id, NULL) AS odd")
    answer = json.dumps({"qualified": True, "reason": "r", "summary": "s", "evidence": "e"})
    asked = completion.ask(frame, {s: s for s in completion.SECTIONS}, "text", lambda: completion.Recorded({"now": answer}), Config(scoring_max_concurrency=2))
    assert asked.rdd.getNumPartitions() == 8 and {(r.id, r.odd) for r in asked.collect()} == {(k, None if k % 2 else k) for k in range(20)}
    scored = completion.opportunity(asked)
    plan = lambda *columns: scored.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan("total_qualified_sections", "qualified")
    assert plan("now").count("get_json_object") == 3  # reason, summary and evidence, once each
    assert [tuple(r.now) for r in scored.select("now").distinct().collect()] == [(True, "r", "s", "e")]


def test_a_fence_ends_at_its_last_mark(spark):
    answers = ["```json\n{}\n```", "```{}```", "```\n{} ``` \n\n```", "``````", "`````", " {} ", "```json\n{}\n```\n", "{}```", "```json {}"]
    told = ["{}", "{}", "{} ```", "", "`````", "{}", "{}\n", "{}```", "```json {}"]
    assert [r.b for r in spark.createDataFrame([(k, a) for k, a in enumerate(answers)], "k int, a string").orderBy("k").select(completion.strip_fence(F.col("a")).alias("b")).collect()] == told
    assert [completion.is_json(a) for a in answers] == [True, True, False, False, False, True, True, False, False]
