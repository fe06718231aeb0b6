"""Chat formatting by schema fingerprints, in DataFrame operations alone.

The nested field paths of a record or of a table's columns are hashed; the hash selects a declarative mapping
that turns the layout into canonical turns, an array of (role, text). Only paths that the layout names go into
its hash, so further keys don't matter; of several layouts that fit, the first in LAYOUTS is taken. One
template renders the turns:

    <|turn|>ROLE<|text|>TEXT<|end|>

Inside roles and texts a backslash is doubled, and one is put after the first character of anything that
could be read as a control string, of this template or of the common ones, so none is left and reading
back is exact. The loss mask is a run for each turn, of the formatted text's characters: how many are skipped
and how many then learned.

* Null roles and texts count as empty. Turns with one number are ordered by role, then text; null first.
* A record of no known layout, or no JSON, has null turns and a null name of layout; nothing is dropped.
  A field that holds no text is taken as its JSON. A text beside a layout's own fields under `system` is a system turn
  before all others. A message whose content is a list of parts has the parts' texts, a line each; with a part that
  holds no text the record's layout isn't known.
* Repeated rows are repeated turns. An empty table gives an empty result. Other columns aren't read, and may
  have any name.
* Texts are taken whole. A conversation is one row of the result, so its turns meet in one task; nothing else
  does, and a turn is formatted and read back in time that doesn't depend on how many there are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What begins a control string; a backslash goes after its first character.
CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


# --- layouts ---------------------------------------------------------------------------------------


def digest(paths: Iterable[str]) -> str:
    """The fingerprint of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def fingerprint(paths: Column, among: tuple[str, ...]) -> Column:
    """`digest` of those of the paths (an array) that are `among` some."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(F.filter(paths, lambda p: p.isin(*among)))), "\n"), 256)


@dataclass(frozen=True)
class Layout:
    """Nested field paths, and how turns are read from a record that has them."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[Column], Column]


def _turn(role: Column | str, text: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), text.alias("text"))


def _listed(key: str, role: str, text: str, roles: dict[str, str] | None = None) -> Layout:
    """A list of messages under one key; roles may have other names, and texts may be lists of parts."""
    named = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair]) if roles else None
    of = lambda m: m[role] if named is None else F.coalesce(F.try_element_at(named, m[role]), m[role])

    def turns(json: Column) -> Column:
        said = F.from_json(json, f"{key} array<struct<{role}:string,{text}:string>>")[key]
        parts = F.transform(F.from_json(json, f"{key} array<struct<{text}:array<struct<text:string>>>>")[key], lambda m: F.transform(m[text], lambda p: p["text"]))
        whole = F.coalesce(~F.exists(parts, lambda p: F.exists(p, lambda t: t.isNull())), F.lit(True))
        return F.when(whole, F.transform(said, lambda m, k: _turn(of(m), F.coalesce(F.array_join(F.get(parts, k), "\n"), m[text]))))

    return Layout(key, (f"{key}[].{role}", f"{key}[].{text}"), turns)


def _fields(name: str, **roles: str) -> Layout:
    """Turns of single fields: role=field, in order; fields that are null or empty give no turn, but the last."""

    def turns(json: Column) -> Column:
        said = [_turn(role, F.get_json_object(json, f"$.{field}")) for role, field in roles.items()]
        last = len(said) - 1
        return F.filter(F.array(*said), lambda t, k: (F.coalesce(t["text"], F.lit("")) != "") | (k == last))

    return Layout(name, tuple(roles.values()), turns)


def _instruction(json: Column) -> Column:
    asked = F.concat_ws("\n\n", F.get_json_object(json, "$.instruction"), F.nullif(F.get_json_object(json, "$.input"), F.lit("")))
    return F.array(_turn("user", asked), _turn("assistant", F.get_json_object(json, "$.output")))


def layouts() -> tuple[Layout, ...]:
    """Known layouts, those of more fields first."""
    return (
        _listed("messages", "role", "content"),
        _listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
        _fields("system, prompt and response", system="system", user="prompt", assistant="response"),
        Layout("instruction with input", ("instruction", "input", "output"), _instruction),
        _fields("prompt and completion", user="prompt", assistant="completion"),
        _fields("prompt and response", user="prompt", assistant="response"),
        _fields("question and answer", user="question", assistant="answer"),
        _fields("instruction", user="instruction", assistant="output"),
    )


def json_paths(json: Column, lists: Iterable[str]) -> Column:
    """The field paths of a JSON text: its keys, and those of the objects in the named lists; null if it is no object."""
    keys = F.json_object_keys(json)

    def inside(name: str) -> Column:
        objects = F.from_json(F.get_json_object(json, f"$.{name}"), "array<map<string,string>>")
        found = F.transform(F.flatten(F.transform(objects, lambda m: F.map_keys(m))), lambda k: F.concat(F.lit(f"{name}[]."), k))
        return F.coalesce(found, F.array().cast("array<string>"))

    return F.concat(keys, *[inside(name) for name in lists])


def schema_paths(kind: T.DataType, above: str = "") -> list[str]:
    """The field paths of a column type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{above}.{f.name}" if above else f.name)]
    return schema_paths(kind.elementType, f"{above}[]") if isinstance(kind, T.ArrayType) else [above]


def from_json(records: DataFrame, json_col: str, *, id_col: str = "conv_id") -> DataFrame:
    """One row for each row of records: conv_id, the layout's name, and turns."""
    known, json = layouts(), F.col(json_col)
    paths = json_paths(json, sorted({p.partition("[]")[0] for layout in known for p in layout.paths if "[]" in p}))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(known):
        hit, own = fingerprint(paths, layout.paths) == digest(layout.paths), layout.turns(json)
        if "system" not in layout.paths:
            system = F.get_json_object(json, "$.system")
            own = F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.array(_turn("system", system)), own)).otherwise(own)
        name, turns = F.when(hit, F.when(own.isNotNull(), layout.name)).otherwise(name), F.when(hit, own).otherwise(turns)
    return records.select(F.col(id_col).alias("conv_id"), name.alias("layout"), turns.cast(TURNS).alias("turns"))


def _from_rows(rows: DataFrame, id_col: str) -> DataFrame:
    """Canonical turns of a table with a row for each turn."""
    said = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.transform(said, lambda t: _turn(t["role"], t["text"])).alias("turns"))


#: How a table's rows become canonical turns, by the paths of its columns.
TABLES = ((("role", "text", "turn"), _from_rows),)


def from_table(rows: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """Canonical turns (conv_id, turns) of a table of a known layout, found by the fingerprint of its columns."""
    found = schema_paths(rows.drop(id_col).schema)
    for paths, mapping in TABLES:
        if digest(p for p in found if p in paths) == digest(paths):
            return mapping(rows.select(id_col, *paths), id_col)
    raise ValueError(f"no mapping for the columns {found}")


# --- the template ----------------------------------------------------------------------------------


def render(canonical: DataFrame, *, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted, and loss_runs: for each turn how many of formatted's characters to skip and how many then
    to learn. Null turns give null."""
    made = canonical.withColumn("turns", F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (F.coalesce(t["role"], F.lit("")) == trained).alias("loss"))))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(TEXT), t["text"], F.lit(END))), "")
    marks = len(TURN + TEXT)
    before = lambda t: F.char_length(t["role"]) + marks + F.when(t["loss"], 0).otherwise(F.char_length(t["text"]))
    # what ends one turn is skipped with the next
    runs = F.transform("turns", lambda t, k: F.struct((before(t) + F.when(k > 0, len(END)).otherwise(0)).alias("skip"), F.when(t["loss"], F.char_length(t["text"])).otherwise(0).alias("learn")))
    return made.select("conv_id", formatted.alias("formatted"), runs.alias("loss_runs"))


def _bodies(formatted: Column) -> Column:
    """The turns of a formatted conversation, still escaped."""
    bodies = F.filter(F.split(formatted, re.escape(TURN)), lambda _, k: k > 0)
    return F.transform(bodies, lambda b: F.struct(F.substring_index(b, TEXT, 1).alias("role"), F.substring_index(F.substring_index(b, TEXT, -1), END, 1).alias("text")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    return F.transform(_bodies(formatted), lambda t: _turn(unescape(t["role"]), unescape(t["text"])))


def loss_text(formatted: Column, loss_runs: Column) -> Column:
    """All text under the loss mask, read from formatted and unescaped; a run that isn't exactly a turn's text is an error."""
    marks = len(TURN + TEXT)

    def learned(both: Column, k: Column) -> Column:
        turn, run = both["turn"], both["run"]
        skipped = F.char_length(turn["role"]) + marks + F.when(k > 0, len(END)).otherwise(0)
        exact = (run["skip"] == skipped) & (run["learn"] == F.char_length(turn["text"]))
        return F.when(run["learn"] == 0, "").when(exact, turn["text"]).otherwise(F.raise_error(F.lit("the loss mask doesn't fit the text")).cast("string"))

    return unescape(F.array_join(F.transform(F.arrays_zip(_bodies(formatted).alias("turn"), loss_runs.alias("run")), learned), ""))


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered conversations hold, read back from them."""
    read = rendered.select("conv_id", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_runs")).alias("loss"), F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>|</?SYS>>)', '\1\\\2', 'g'), '(\[)(/?INST\])', '\1\\\2', 'g'))
              + length(regexp_replace(regexp_replace(replace(role, '\', '\\'), '(<)(\||/?s>|</?SYS>>)', '\1\\\2', 'g'), '(\[)(/?INST\])', '\1\\\2', 'g')) + 23 AS chars FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
