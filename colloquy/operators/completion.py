"""Scoring by a completion service: an injectable interface, run by partition, with retries.

A completer turns (prompt, context) into JSON text. Only the raw answers come from Python; validation and
all that follows from them are columns.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy import schemas
from colloquy.config import Config
from colloquy.functions import columns as C
from colloquy.operators import clients, names, scoring
from colloquy.operators.vocabularies import CHALLENGES, OFFERINGS, RESULTS
from colloquy.sources import landing

SECTIONS = ("now", "next", "measure", "blocker", "fit")


class Completer(Protocol):
    def complete(self, prompt: str, context: str) -> str | None: ...


class Recorded:
    """Answers from a table of prompts; for tests and for scoring again."""

    def __init__(self, answers: dict[str, str], otherwise: str | None = None):
        self.answers, self.otherwise = answers, otherwise

    def complete(self, prompt: str, context: str) -> str | None:
        return self.answers.get(prompt, self.otherwise)


#: What is said before every prompt, and after the text.
SYSTEM = "You judge business meetings. Answer with valid JSON only."
ANSWER = "Answer in JSON."


def family(model: str) -> str:
    """Which interface a model is asked by: `responses` (gpt-5), `reasoning` (o1) or `chat` (all others)."""
    return "responses" if model.startswith("gpt-5") else "reasoning" if model.startswith("o1") else "chat"


def request(model: str, prompt: str, context: str, *, max_tokens: int = 1000, temperature: float | None = 0.2, token_param: str = "max_tokens") -> dict:
    """A request in the shape of the model's interface.

    Reasoning models have no system message and no temperature, and get MIN_REASONING_TOKENS at least."""
    asked = f"{prompt}\n\nTranscript:\n{context}\n\n{ANSWER}"
    whole, most = f"{SYSTEM}\n\n{asked}", max(max_tokens, MIN_REASONING_TOKENS)
    if family(model) == "responses":
        return {"model": model, "input": whole, "reasoning": {"effort": "minimal"}, "text": {"verbosity": "low"}, "max_output_tokens": most}
    if family(model) == "reasoning":
        return {"model": model, "messages": [{"role": "user", "content": whole}], "max_completion_tokens": most}
    made = {"model": model, "messages": [{"role": "system", "content": SYSTEM}, {"role": "user", "content": asked}], token_param: max_tokens}
    return made if temperature is None else made | {"temperature": temperature}


MIN_REASONING_TOKENS = 1500


class Routed:
    """A completer over a function that sends a request of any family and gives the answer's text."""

    def __init__(self, model: str, send: Callable[[str, dict], str | None], **settings):
        self.model, self.send, self.settings = model, send, settings

    def complete(self, prompt: str, context: str) -> str | None:
        return self.send(family(self.model), request(self.model, prompt, context, **self.settings))


class Transient(Exception):
    """An error worth another try; `status` is that of the response, if there was one."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


def is_transient(error: BaseException) -> bool:
    status = getattr(error, "status", None) or getattr(error, "status_code", None)
    return isinstance(error, (Transient, TimeoutError, ConnectionError)) if status is None else status == 429 or 500 <= status < 600


def delays(config: Config, jitter: Callable[[], float] = random.random) -> Iterator[float]:
    """Seconds before each further attempt: doubling, bounded, and up to a quarter more."""
    for k in range(config.retry_attempts - 1):
        wait = min(config.retry_max_s, config.retry_base_s * 2**k)
        yield wait * (1 + 0.25 * jitter())


def with_retries(call: Callable[[], str | None], config: Config = Config(), sleep: Callable[[float], None] = time.sleep) -> str | None:
    waits = delays(config)
    while True:
        try:
            return call()
        except Exception as error:
            wait = next(waits, None) if is_transient(error) else None
            if wait is None:
                raise
            sleep(wait)


#: A code fence and what is in it; greedy, as a lazy one tries its end at every character.
FENCE = r"(?s)^```(?:json)?\s*(.*\S)?\s*```$"
_FENCE = re.compile(FENCE)


@lru_cache(maxsize=64)  # whether an answer is JSON and whether it has its shape is asked one after the other
def _read(answer: str) -> tuple[bool, object]:
    """Whether an answer, without the code fence around it, is JSON, and what it says."""
    bare = answer.strip()
    fenced = _FENCE.match(bare)
    try:
        return True, json.loads((fenced[1] or "") if fenced else bare)
    except ValueError:
        return False, None


def is_json(answer: str) -> bool:
    """Whether an answer, without the code fence around it, is JSON."""
    return _read(answer)[0]


def checked(call: Callable[[], str | None], fallback: Callable[[], str | None] | None = None, as_json: bool = True) -> str | None:
    """An answer, asked for again while it is empty (three times in all) or once if it is no JSON, then from the fallback."""
    for tries in range(3):
        answer = call()
        if not (answer or "").strip():
            continue
        if not as_json or is_json(answer) or tries > 1:
            return answer
        if tries == 1:
            return answer if fallback is None else fallback()
    return answer


#: Keys of an answer by the kind of its prompt; a section has just these, an assessment may have more.
SECTION_KEYS = ("evidence", "qualified", "reason", "summary")
SALES_KEYS = ("coaching_note", "evidence", "qualified", "reason", "score")
#: What is said below a prompt that is asked again because the answer had another shape.
AGAIN = "The answer before didn't have the wanted shape. Answer with JSON of exactly these keys and types: "
# What stored rows say of answers that never had the shape.
INVALID, INVALID_SECTION, INVALID_QUALIFIED, INVALID_NOTE = "Invalid JSON from model", "Model returned invalid response format", "Model returned non-boolean qualified field", "Unable to assess - model returned invalid response"


def shape(name: str) -> tuple[str, Callable[[dict], bool]] | None:
    """What the answer to a prompt of this name must be: in words, and as a test; None if anything will do."""
    if name in SECTIONS:
        wanted = {*SECTION_KEYS, *(["services"] if name == "fit" else [])}
        return f"{', '.join(sorted(wanted))}; qualified is true or false", lambda a: {*a} | ({"services"} if name == "fit" else set()) == wanted and isinstance(a["qualified"], bool)
    if name.startswith("sales_"):
        return f"{', '.join(SALES_KEYS)}; score is a number from 0 to 3", lambda a: {*a} >= {*SALES_KEYS}
    return None


def shaped(once: Callable[[str], str | None], name: str, prompt: str) -> str | None:
    """The answer to a prompt; one that is JSON of another shape is asked for once more, with what is wanted."""
    answer, wanted = once(prompt), shape(name)
    if wanted is None or answer is None or not is_json(answer):
        return answer
    value = _read(answer)[1]
    return answer if isinstance(value, dict) and wanted[1](value) else once(f"{prompt}\n\n{AGAIN}{wanted[0]}.")


def answer_all(text: str | None, prompts: dict[str, str], completer: Completer, other: Completer | None, config: Config, prose: tuple[str, ...]) -> dict[str, str | None]:
    """The answers to all prompts about one text; one question's failure isn't the row's."""
    got = {}
    for name, prompt in prompts.items():
        tried = lambda c, p: lambda: with_retries(lambda: c.complete(p, text or ""), config)
        once = lambda p: checked(tried(completer, p), other and tried(other, p), name not in prose)
        try:
            got[name] = shaped(once, name, prompt)
        except Exception:
            got[name] = None
    return got


class Pace:
    """Lets requests of many threads through, so many a second."""

    def __init__(self, per_second: float, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic):
        self.gap, self.next, self.sleep, self.clock, self.lock = 1 / per_second, 0.0, sleep, clock, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            at = max(now, self.next)
            self.next = at + self.gap
        if at > now:
            self.sleep(at - now)


class Paced:
    """A completer whose requests wait for their turn."""

    def __init__(self, completer: Completer, pace: Pace):
        self.completer, self.pace = completer, pace

    def complete(self, prompt: str, context: str) -> str | None:
        self.pace.wait()
        return self.completer.complete(prompt, context)


class Journal:
    """Answers that were paid for, a file for each question in a folder that all executors share, so that a task that is
    run again, or another job, asks only what is missing. `label` is what else an answer depends on, such as the model.

    Failures and empty answers aren't kept. Files are written whole under another name and moved, so a lost executor leaves none half-written."""

    def __init__(self, completer: Completer, folder: str, label: str = ""):
        self.completer, self.label = completer, label
        self.store, self.folder = landing.store_of(folder.rstrip("/"))

    def path(self, prompt: str, context: str) -> str:
        key = hashlib.sha256(json.dumps([self.label, prompt, context]).encode()).hexdigest()
        return f"{self.folder}/{key[:2]}/{key}"

    def complete(self, prompt: str, context: str) -> str | None:
        path = self.path(prompt, context)
        try:
            with self.store.open_input_stream(path) as held:
                return held.read().decode()
        except FileNotFoundError:
            pass
        answer = self.completer.complete(prompt, context)
        if (answer or "").strip():
            self.store.create_dir(path.rpartition("/")[0], recursive=True)
            draft = f"{path}-{uuid.uuid4().hex}"
            with self.store.open_output_stream(draft) as out:
                out.write(answer.encode())
            self.store.move(draft, path)
        return answer


def ask(df: DataFrame, prompts: dict[str, str], context: str, make: Callable[[], Completer], config: Config = Config(), *, fallback: Callable[[], Completer] | None = None, prose: tuple[str, ...] = (), journal: str | None = None, label: str = "") -> DataFrame:
    """df with a column `raw`: a map from each prompt's name to the answer, or null if it failed for good.

    Empty answers and those that are no JSON are asked for again, the latter in the end from the completer that
    `fallback` gives; JSON of another shape than the prompt's kind has is asked for once more. `prose` names the
    prompts whose answers are no JSON.

    `make` gives a completer once a task, so that no connection is pickled. Rows are dealt to
    `scoring_max_concurrency` partitions, each of which has `questions_in_flight` questions under way (a completer
    must bear as many threads); all partitions together send `requests_per_second` at most, if that is set. With
    `journal`, a folder that all executors share, answers are kept there as they come, by `label`, prompt and text, and
    none is asked for twice. What comes before runs as wide as it is, and what comes after as wide as other shuffles: a
    job that reads the answers anew doesn't ask for them again as long as that shuffle is there.
    """
    tasks = max(1, config.scoring_max_concurrency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(config.requests_per_second / tasks) if config.requests_per_second else None

        def wrapped(made: Completer, of: str) -> Completer:
            made = Paced(made, pace) if pace else made
            return Journal(made, journal, f"{label}{of}") if journal else made

        completer, other = wrapped(make(), ""), fallback and wrapped(fallback(), " (fallback)")
        one = lambda text: answer_all(text, prompts, completer, other, config, prose)
        with ThreadPoolExecutor(max(1, config.questions_in_flight)) as pool:
            ahead = deque()
            for rows in (batch.slice(at, _ASKED_ROWS) for batch in batches for at in range(0, batch.num_rows, _ASKED_ROWS)):
                ahead.append((rows, pool.map(one, rows.column(rows.schema.get_field_index(context)).to_pylist())))
                if len(ahead) > 1:  # the next rows are under way while these are waited for
                    yield answered(*ahead.popleft())
            for rows, got in ahead:
                yield answered(rows, got)

    def answered(rows: pa.RecordBatch, got: Iterator[dict]) -> pa.RecordBatch:
        raw = pa.array([[*answers.items()] for answers in got], pa.map_(pa.string(), pa.string()))
        return pa.RecordBatch.from_arrays([*rows.columns, raw], names=[*rows.schema.names, "raw"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    asked = df.repartition(tasks).mapInArrow(run, f"{kind}, raw map<string,string>")
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt by what was given, as rows with all their answers would be sorted before they are dealt in turn
    given = [f.name for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    return asked.repartition(wide, F.xxhash64(*[F.col(f"`{name}`") for name in given])) if wide > tasks else asked


#: Rows whose answers a task holds at once; as many more are under way.
_ASKED_ROWS = 256


def strip_fence(text: Column) -> Column:
    """An answer without the code fence around it."""
    return C.let(F.trim(text), lambda t: F.when(t.startswith("```"), F.regexp_replace(t, FENCE, "$1")).otherwise(t))


def evidence(json: Column) -> Column:
    """The evidence of an answer, cut to its first words; a list is joined by spaces, without null and empty entries."""
    listed = lambda got: F.array_join(F.filter(F.from_json(got, "array<string>"), lambda p: p != ""), " ")
    return C.let(F.get_json_object(json, "$.evidence"), lambda got: C.first_words(F.when(got.startswith("["), listed(got)).otherwise(C.scalar(got))))


def _scalar(json: Column, key: str) -> Column:
    return C.let(F.get_json_object(json, f"$.{key}"), C.scalar)


def _keys(json: Column, but: str | None = None) -> Column:
    """The sorted keys of an object (without one that may be there or not), as JSON; null for anything else."""
    keys = F.json_object_keys(json)
    return F.to_json(F.sort_array(keys if but is None else F.array_remove(keys, but)))


def _said(json: Column, key: str) -> Column:
    """The value of a key as JSON, so that texts are quoted and told from numbers and booleans; null if it is missing or null."""
    return F.to_json(F.try_variant_get(F.try_parse_json(json), f"$.{key}", "variant"))


_WANTED = json.dumps(SECTION_KEYS, separators=(",", ":"))


def _section_marks(keys: Column, said: Column) -> tuple[Column, Column]:
    fine = F.coalesce((keys == _WANTED) & said.isin("true", "false"), F.lit(False))
    return fine, fine & (said == "true")


def _section(json: Column, keys: Column, fine: Column, qualified: Column, services: Column | None = None) -> Column:
    """A validated section: exactly the wanted keys and a boolean, else an unqualified one that says why.

    Each field is told for itself, so that a query which asks for some doesn't pay for the others."""
    reason = F.when(fine, _scalar(json, "reason")).when(keys.isNull(), "invalid response").otherwise(INVALID)
    summary = F.when(fine, _scalar(json, "summary")).when(keys != _WANTED, INVALID_SECTION).when(keys == _WANTED, INVALID_QUALIFIED)
    fields = {"qualified": qualified, "reason": reason, "summary": summary, **({} if services is None else {"services": services}), "evidence": F.when(fine, evidence(json))}
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _fit(json: Column, keys: Column, fine: Column, qualified: Column) -> Column:
    return _section(json, keys, fine, qualified, names.services(C.json_array(json, "$.services")))


def _sales_marks(keys: Column, said: Column) -> tuple[Column, Column]:
    lacking = F.size(F.array_except(F.array(*[F.lit(k) for k in SALES_KEYS]), F.from_json(keys, "array<string>"))) > 0
    fine = ~F.coalesce(lacking, F.lit(False))
    return fine, F.when(fine, C.clamp_score(F.when(said.rlike("^-?[0-9]"), said.try_cast("double")))).otherwise(0)


def _sales(json: Column, keys: Column, fine: Column, score: Column) -> Column:
    """A criterion: a number as score, cut to 0..3, and qualified from 2 on whatever the answer says. JSON without one of
    the wanted keys is an assessment that says so."""
    told = lambda value, failed: F.when(fine, value).otherwise(failed)
    fields = {"qualified": score >= 2, "score": score, "reason": told(_scalar(json, "reason"), INVALID), "evidence": F.when(fine, evidence(json)), "coaching_note": told(_scalar(json, "coaching_note"), INVALID_NOTE)}
    return F.struct(*[value.alias(name) for name, value in fields.items()])


#: How answers are validated: a section from the answer, its keys (without one that may be there or not) and two marks,
#: whether it has its shape and its verdict, which are told from the keys and what the answer says of one of them.
_KINDS = {**{s: (_section, _section_marks, "qualified", None) for s in SECTIONS[:-1]}, "fit": (_fit, _section_marks, "qualified", "services"), **{f"sales_{c}": (_sales, _sales_marks, "score", None) for c in schemas.SALES_CRITERIA}}


def _validate(answer: Column, name: str) -> Column:
    """One answer to a prompt of this name as a validated section."""
    make, marks, key, but = _KINDS[name]
    marked = lambda json, keys, said: C.let(F.struct(*[mark.alias(kind) for kind, mark in zip(("fine", "verdict"), marks(keys, said))]), lambda m: make(json, keys, m["fine"], m["verdict"]))
    return C.let(strip_fence(answer), lambda json: C.let(_keys(json, but), lambda keys: marked(json, keys, _said(json, key))))


def section(answer: Column) -> Column:
    return _validate(answer, SECTIONS[0]).cast(schemas.SECTION)


def fit_section(answer: Column) -> Column:
    return _validate(answer, "fit").cast(schemas.FIT)


def sales_section(answer: Column) -> Column:
    return _validate(answer, f"sales_{schemas.SALES_CRITERIA[0]}").cast(schemas.SALES)


def _validated(df: DataFrame, prompts: list[str]) -> DataFrame:
    """df with the answers in `raw` to these prompts as validated sections. What several fields rest on are columns of
    their own for as long, so that an answer is read once for each of them and not for each place that names it."""
    kept = {(kind, p): F.col(f"__{kind}_{p}") for kind in ("json", "keys", "said", "fine", "verdict") for p in prompts}
    made = df.withColumns({f"__json_{p}": strip_fence(F.try_element_at("raw", F.lit(p))) for p in prompts})
    made = made.withColumns({f"__keys_{p}": _keys(kept["json", p], _KINDS[p][3]) for p in prompts} | {f"__said_{p}": _said(kept["json", p], _KINDS[p][2]) for p in prompts})
    made = made.withColumns({f"__{kind}_{p}": mark for p in prompts for kind, mark in zip(("fine", "verdict"), _KINDS[p][1](kept["keys", p], kept["said", p]))})
    made = made.withColumns({p: _KINDS[p][0](*[kept[kind, p] for kind in ("json", "keys", "fine", "verdict")]) for p in prompts})
    return made.drop(*[f"__{kind}_{p}" for kind, p in kept])


def opportunity(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Answers in `raw` as validated sections, with how many qualify and whether that is enough."""
    made = _validated(df, [*SECTIONS])
    n, enough = scoring.sections_qualified([F.col(s)["qualified"] for s in SECTIONS], config.qualification_threshold)
    return made.withColumns({"total_qualified_sections": n.cast("bigint"), "qualified": enough})


def taxonomy(df: DataFrame, answer: str = "taxonomy") -> DataFrame:
    """Labels of the controlled vocabularies from the answer of that name, the first five of a kind and one offering; none if it is no JSON."""
    raw = strip_fence(F.try_element_at("raw", F.lit(answer)))
    labels = lambda path, known: names.in_vocabulary(C.json_array(raw, path), list(known))
    offering = C.json_scalar(raw, "$.offering")
    return df.withColumns({"challenges": labels("$.challenges", CHALLENGES), "results": labels("$.results", RESULTS), "offering": F.when(offering.isin(*OFFERINGS), offering)})


def sales(df: DataFrame, config: Config = Config()) -> DataFrame:
    """Answers in `raw` (sales_<criterion>) as eight assessments with totals, strengths and coaching."""
    made = _validated(df, [f"sales_{c}" for c in schemas.SALES_CRITERIA])
    scores = F.array(*[F.col(f"sales_{c}")["score"] for c in schemas.SALES_CRITERIA])
    total, good = scoring.total(scores), scoring.total_qualified(scores)
    return made.withColumns({"sales_total_score": total.cast("bigint"), "sales_total_qualified": good.cast("bigint"), "sales_qualified": good >= config.sales_qualification_threshold, "sales_strengths": scoring.strengths(scores), "sales_improvements": scoring.improvements(scores), "sales_overall_coaching": scoring.coaching(total)})


def legacy(df: DataFrame) -> DataFrame:
    """Opportunity sections as the legacy shape has them: one map of checks by name."""
    checks = F.create_map(*[x for s in SECTIONS for x in (F.lit(s), F.struct(F.col(s)["qualified"].alias("qualified"), F.col(s)["reason"].alias("reason"), F.col(s)["summary"].alias("summary"), F.col(s)["evidence"].alias("evidence")))])
    return df.withColumn("checks", checks).drop(*SECTIONS)


def full(df: DataFrame, prompts: dict[str, str], context: str, make: Callable[[], Completer], config: Config = Config(), *, fallback: Callable[[], Completer] | None = None) -> DataFrame:
    """Opportunity, taxonomy and sales assessment of each row, from one round of questions."""
    asked = ask(df, prompts, context, make, config, fallback=fallback)
    return sales(taxonomy(opportunity(asked, config)), config).drop("raw")


def client(answer: Column, classes: list, title: Column, identity: Column, company: Column, text: Column, own: tuple[str, ...] = clients.OWN_NAMES) -> Column:
    """Client info, whose first tier is a completer's answer."""
    return clients.info(F.from_json(strip_fence(answer), schemas.CLIENT_INFO), title, identity, company, text, classes, own)


def compare(df: DataFrame, key: str, prompts: dict[str, str], context: str, makers: dict[str, Callable[[], Completer]], config: Config = Config()) -> DataFrame:
    """The score of each row by each model (model, key, score): null where a model failed on a question for good."""
    out = None
    for model, make in makers.items():
        asked = ask(df.select(key, context), prompts, context, make, config)
        failed = F.exists(F.map_values("raw"), lambda a: a.isNull())
        scored = opportunity(asked, config).select(F.lit(model).alias("model"), key, F.when(~failed, F.col("total_qualified_sections")).alias("score"))
        out = scored if out is None else out.unionByName(scored)
    return out
