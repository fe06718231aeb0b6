"""Files that arrive, over restarts and failures, to scored meetings."""

import json
import os

from colloquy.config import Config
from colloquy.operators import completion
from colloquy.sources import landing
from colloquy.streaming import meetings

PROMPTS = {s: f"about {s}" for s in completion.SECTIONS}


def answerer(paid, down):
    """Answers all, but refuses `blocker` about meetings that say 'flaky' while a file is there; notes what it is asked."""

    class Answerer:
        def complete(self, prompt, context):
            import uuid

            with open(f"{paid}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{prompt}|{context}")
            if "flaky" in context and "blocker" in prompt and os.path.exists(down):
                raise RuntimeError("refused")
            said = {"qualified": "yes" in context, "reason": prompt.split("\n")[0], "summary": "s", "evidence": context}
            return json.dumps(said | ({"services": ["talent"]} if "fit" in prompt else {}))

    return Answerer


def put(folder, name, date="2024-02-03", text="Ann: yes"):
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write(f"Weekly {name}\n" + (f"Date: {date}\n" if date else "") + f"Participants: Ann, Bob\n\n{text}\n")


def test_files_become_scored_meetings_once(spark, tmp_path):
    landing.register(spark)
    folder, paid, down = tmp_path / "in", tmp_path / "paid", f"{tmp_path}/down"
    folder.mkdir()
    paid.mkdir()
    open(down, "w").close()
    made = lambda: meetings.pipeline(spark, f"{tmp_path}/tables", PROMPTS, answerer(str(paid), down), Config(retry_attempts=4, scoring_max_concurrency=1), journal=f"{tmp_path}/journal")

    def arrive():
        run = made()  # as after a restart
        run.stream(meetings.arrivals(spark.readStream.format("landing").option("settleSeconds", 0).load(str(folder))), f"{tmp_path}/checkpoint")
        status = {r.meeting_id: (r.status, r.attempts, r.error) for r in run.folder.read("status").collect()}
        return status, {r.meeting_id: (r.total_qualified_sections, r.qualified) for r in run.folder.read("results").collect()}

    put(folder, "a")
    put(folder, "b", text="Ann: no")
    put(folder, "c", text="Ann: flaky yes")
    put(folder, "d", date=None)
    status, results = arrive()
    assert status == {"a": ("completed", 1, None), "b": ("completed", 1, None), "c": ("pending", 1, "a question was not answered"), "d": ("failed", 1, "no date")}
    assert results == {"a": (5, True), "b": (0, False)}
    first = len(os.listdir(paid))
    assert first == 15  # three meetings of five questions, and none about d

    put(folder, "a", text="Ann: no, written again")  # done for good
    put(folder, "d")  # with its date now
    os.remove(down)
    status, results = arrive()
    # c was due by the new files' time, and only its missing answer was paid for, besides d's five
    assert status == {"a": ("completed", 1, None), "b": ("completed", 1, None), "c": ("completed", 2, None), "d": ("completed", 2, None)}
    assert results == {"a": (5, True), "b": (0, False), "c": (5, True), "d": (5, True)}
    assert len(os.listdir(paid)) == first + 6
    assert made().drain() == 0 and arrive() == (status, results)
