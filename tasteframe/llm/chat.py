"""Chat formatting: tool calls linked to results, ordered by their dependencies, validated, as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import pieces
from tasteframe.scratch import materialise

#: Schemas of the tools that ``requests`` makes: a subset of JSON Schema.
REPLY = {
    "reply": {
        "type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    }
}
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
EVENTS = (
    "conv_id long, turn long, idx int, role string, kind string, call_id string, name string, arguments string, after array<string>, content string"
)


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """JSON with sorted keys, without spaces, characters unescaped where JSON allows it; half a surrogate pair becomes U+FFFD."""
    return _LONE.sub("\ufffd", json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False))


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("a number beyond all bounds")
    return value


def parsed(text: str):
    """The value of a JSON text. Texts that have no canonical JSON are no JSON here: NaN and Infinity, numbers beyond double
    precision's range, integers or nesting beyond Python's limits. Raises ValueError."""
    try:
        value = json.loads(text, parse_float=_number, parse_constant=_number)
        deeper = value
        for _ in range(50):  # it will be written as a part of a message
            deeper = [deeper]
        canonical(deeper)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    return value


def _is(value, kind: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "number":
        return number
    if kind == "integer":
        return number and (isinstance(value, int) or value.is_integer())
    return kind in _TYPES and isinstance(value, _TYPES[kind])


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What a value breaks of a schema: type (one or a list), enum, required, properties, additionalProperties, items, bounds of numbers and lengths."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    number = _is(value, "number")
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = [f"{at}: not in enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    elif isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{i}]")
    size = value if number else len(value) if isinstance(value, (str, list)) else None
    low, high = ("minimum", "maximum") if number else ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
    if size is not None and size < schema.get(low, size):
        out.append(f"{at}: below {low}")
    if size is not None and size > schema.get(high, size):
        out.append(f"{at}: above {high}")
    return out


def _object(text: str | None, key: str) -> dict | None:
    if not text or key not in text or not text.lstrip().startswith("{"):
        return None
    try:
        found = parsed(text)
    except ValueError:
        return None
    return found if isinstance(found, dict) and key in found else None


def _text(x) -> str | None:
    return x if x is None else _LONE.sub("\ufffd", x) if isinstance(x, str) else canonical(x)


def _parts(conv_id, turn, role, text) -> list[tuple]:
    """The events of one turn: its calls and what it says besides, its result, or its message."""
    calls = _object(text, "tool_calls") if role == "assistant" else None
    if calls and isinstance(calls["tool_calls"], list):
        out = []
        for i, c in enumerate(x for x in calls["tool_calls"] if isinstance(x, dict)):
            f = c.get("function") if isinstance(c.get("function"), dict) else c
            after = c.get("after") if isinstance(c.get("after"), list) else []
            out.append((conv_id, turn, i, role, "call", _text(c.get("id")), _text(f.get("name")), _text(f.get("arguments")), [_text(a) for a in after if a is not None], None))
        if calls.get("content") is not None or not out:
            out.append((conv_id, turn, len(out), role, "message", None, None, None, [], _text(calls.get("content"))))
        return out
    result = _object(text, "tool_call_id") if role == "tool" else None
    if result:
        return [(conv_id, turn, 0, role, "result", _text(result["tool_call_id"]), None, None, [], _text(result.get("content")))]
    return [(conv_id, turn, 0, role, "message", None, None, None, [], text)]


def events(conversations: DataFrame) -> DataFrame:
    """One row per call, result or message (columns of EVENTS) of turns (conv_id, turn, role, text).

    A call stands in an assistant turn {"tool_calls": [{"id", "function": {"name", "arguments"}, "after": [ids]}], "content"}, a result in a tool
    turn {"tool_call_id", "content"}; every other text, null too and JSON that ``parsed`` refuses, is a message.
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 5, pa.list_(pa.string()), pa.string()]
    names = [c.split()[0] for c in EVENTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = [e for turn in zip(*(c.to_pylist() for c in b.columns), strict=True) for e in _parts(*turn)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    return turns.mapInArrow(run, EVENTS)


def requests(found: DataFrame) -> DataFrame:
    """Events in which plain dialogue is a chain of calls: a user's message asks the tool ``reply`` and comes after the one two turns
    before, the assistant's message in the next turn is the result. Other events stay as they are.
    """
    plain = (F.col("kind") == "message") & F.col("turn").isNotNull() & F.col("conv_id").isNotNull()
    asks, answers = plain & (F.col("role") == "user"), plain & (F.col("role") == "assistant")

    def named(turn):
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    arguments = F.to_json(F.struct(F.col("content").alias("prompt"), F.col("turn").alias("turn")))
    return found.select(
        "conv_id", "turn", "idx", "role",
        F.when(asks, "call").when(answers, "result").otherwise(F.col("kind")).alias("kind"),
        F.when(asks, named(F.col("turn"))).when(answers, named(F.col("turn") - 1)).otherwise(F.col("call_id")).alias("call_id"),
        F.when(asks, "reply").otherwise(F.col("name")).alias("name"),
        F.when(asks, arguments).otherwise(F.col("arguments")).alias("arguments"),
        F.when(asks & (F.col("turn") >= 2), F.array(named(F.col("turn") - 2))).otherwise(F.col("after")).alias("after"),
        F.when(asks, None).otherwise(F.col("content")).alias("content"),
    )


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, cyclic) of calls (conv_id, call_id, turn, idx, after), one row per identifier.

    By (level, turn, idx) every call stands behind the calls that it comes after: its level is the largest of theirs, one more for
    each that stands later in the conversation. Calls that wait for themselves are cyclic. Identifiers that no call
    has are left out. Without calls that wait for later ones nothing is iterated; else each round is written to the shared folder.
    """
    place = F.struct("turn", "idx")
    nodes = calls.select("conv_id", "call_id", place.alias("place"))
    edges = (
        calls.select("conv_id", "call_id", place.alias("place"), F.explode(F.array_distinct("after")).alias("dep"))
        .join(nodes.select(F.col("conv_id").alias("c"), F.col("call_id").alias("dep"), F.col("place").alias("dep_place")), "dep")
        .filter(F.col("conv_id") == F.col("c")).select("conv_id", "call_id", "dep", (F.col("dep_place") >= F.col("place")).cast("long").alias("later"))
    )
    edges = materialise(edges, "edges")
    moved = edges.filter("later = 1").groupBy("conv_id").agg(F.count("*").alias("most"))
    if moved.isEmpty():
        return nodes.select("conv_id", "call_id", F.lit(0).cast("long").alias("level"), F.lit(False).alias("cyclic"))
    # a level above the number of later-pointing dependencies of a conversation means a cycle
    edges = materialise(edges.join(moved, "conv_id"), "edges")
    now = materialise(edges.groupBy("conv_id", "call_id").agg(F.max("later").alias("level")), "levels")
    while True:
        known = now.select(F.col("conv_id").alias("c"), F.col("call_id").alias("dep"), F.col("level").alias("of_dep"))
        raised = edges.join(known, (F.col("conv_id") == F.col("c")) & (edges["dep"] == known["dep"]), "left")
        raised = raised.groupBy("conv_id", "call_id").agg(F.max(F.least(F.coalesce("of_dep", F.lit(0)) + F.col("later"), F.col("most") + 1)).alias("level"), F.first("most").alias("most"))
        raised = materialise(raised, "levels")
        changed = raised.join(now.withColumnRenamed("level", "was"), ["conv_id", "call_id"]).filter("level <> was")
        now = raised.drop("most")
        if changed.isEmpty():
            break
    top = raised.select("conv_id", "call_id", "level", (F.col("level") > F.col("most")).alias("cyclic"))
    return nodes.select("conv_id", "call_id").join(top, ["conv_id", "call_id"], "left").select("conv_id", "call_id", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"))


def link(found: DataFrame) -> DataFrame:
    """Events with status, level: calls and results joined by (conv_id, call_id).

    Of calls or results that repeat an identifier the first (turn, idx) counts, others are ``repeated``. A call with a result is ``linked``, else
    ``open``; a result with a call is ``linked``, else ``orphan``; both are ``unnamed`` without identifier or conversation. A call that waits
    for itself is ``cyclic``. Messages have no status. A result has the level of its call, a message 0. Eager.
    """
    found = materialise(found, "events")
    named = found.filter("call_id is not null and conv_id is not null")
    place = F.struct("turn", "idx")
    calls = named.filter("kind = 'call'").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "idx", "after")).alias("first"))
    calls = materialise(calls.select("conv_id", "call_id", "first.*"), "calls")
    results = named.filter("kind = 'result'").groupBy("conv_id", "call_id").agg(F.min(place).alias("result_place"))
    both = calls.select("conv_id", "call_id", place.alias("call_place")).join(results, ["conv_id", "call_id"], "full")
    both = both.join(levels(calls), ["conv_id", "call_id"], "left")
    rows = found.join(both, ["conv_id", "call_id"], "left")
    of_call, is_call = place == F.col("call_place"), F.col("kind") == "call"
    status = (
        F.when(F.col("kind") == "message", None)
        .when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "unnamed")
        .when(is_call & ~F.coalesce(of_call, F.lit(False)), "repeated")
        .when(is_call & F.col("cyclic"), "cyclic")
        .when(is_call, F.when(F.col("result_place").isNull(), "open").otherwise("linked"))
        .when(F.col("call_place").isNull(), "orphan")
        .when(place == F.col("result_place"), "linked").otherwise("repeated")
    )
    return rows.select(*found.columns, status.alias("status"), F.coalesce("level", F.lit(0)).alias("level"))


def serialise(linked: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, level, turn, idx, kind, call_id, status, valid, fault, json): arguments checked, each event as canonical JSON.

    ``valid`` is null but for calls; ``fault`` names the first thing that is wrong: arguments that are no JSON, a tool without schema, a
    broken bound. Arguments that are JSON are written as JSON, others as text.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string()]
    names = ["conv_id", "level", "turn", "idx", "kind", "call_id", "status", "valid", "fault", "json"]
    columns = ["conv_id", "level", "turn", "idx", "kind", "call_id", "status", "role", "name", "arguments", "content"]

    def one(conv_id, level, turn, idx, kind, call_id, status, role, name, arguments, content) -> tuple:
        wrong: list[str] = []
        if kind == "call":
            try:
                value = parsed(arguments if arguments is not None else "{}")
            except ValueError:
                value, wrong = arguments, ["$: not JSON"]
            else:
                wrong = faults(value, schemas[name]) if name in schemas else [f"no schema of {name}"]
            out = {"role": "assistant", "tool_calls": [{"id": call_id, "type": "function", "function": {"name": name, "arguments": value}}]}
        elif kind == "result":
            out = {"role": "tool", "tool_call_id": call_id, "content": content}
        else:
            out = {"role": role, "content": content}
        return conv_id, level, turn, idx, kind, call_id, status, not wrong if kind == "call" else None, _text(wrong[0]) if wrong else None, canonical(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = [one(*r) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "conv_id long, level long, turn long, idx int, kind string, call_id string, status string, valid boolean, fault string, json string"
    return linked.select(columns).mapInArrow(run, schema)


def format_chats(conversations: DataFrame, schemas: dict[str, dict] = REPLY, chained: bool = True) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as linked, ordered, validated events in canonical JSON; see ``serialise``.

    Sorting a conversation's rows by (level, turn, idx) gives its messages with every call behind what it waits for. No conversation
    is gathered in one task: each event is a row. With ``chained``, plain dialogue is turned into calls of ``reply`` by ``requests``. Rows may
    repeat or have nulls in any column; other columns are ignored.
    """
    found = events(conversations)
    return serialise(link(requests(found) if chained else found), schemas)


ORACLE = """
WITH firsts AS (
    SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant') GROUP BY ALL),
rows AS (
    SELECT c.conv_id, c.turn, c.role, c.text,
           CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
           CASE role WHEN 'user' THEN conv_id || '-' || turn WHEN 'assistant' THEN conv_id || '-' || (turn - 1) END AS call_id
    FROM conversations c)
SELECT r.conv_id, CAST(0 AS BIGINT) AS level, r.turn, CAST(0 AS INTEGER) AS idx, kind, call_id,
       CASE kind WHEN 'call' THEN CASE WHEN a.turn IS NULL THEN 'open' ELSE 'linked' END
                 WHEN 'result' THEN CASE WHEN u.turn IS NULL THEN 'orphan' ELSE 'linked' END END AS status,
       CASE WHEN kind = 'call' THEN coalesce(text, '') <> '' END AS valid,
       CASE WHEN kind = 'call' AND text IS NULL THEN '$.prompt: missing' WHEN kind = 'call' AND text = '' THEN '$.prompt: below minLength' END AS fault,
       CASE kind WHEN 'call' THEN '{"role":"assistant","tool_calls":[{"function":{"arguments":{' || coalesce('"prompt":' || to_json(text) || ',', '') || '"turn":' || r.turn
                                  || '},"name":"reply"},"id":' || to_json(call_id) || ',"type":"function"}]}'
                 WHEN 'result' THEN '{"content":' || coalesce(to_json(text), 'null') || ',"role":"tool","tool_call_id":' || to_json(call_id) || '}'
                 ELSE '{"content":' || coalesce(to_json(text), 'null') || ',"role":' || to_json(r.role) || '}' END AS json
FROM rows r
LEFT JOIN firsts a ON kind = 'call' AND a.role = 'assistant' AND a.conv_id = r.conv_id AND a.turn = r.turn + 1
LEFT JOIN firsts u ON kind = 'result' AND u.role = 'user' AND u.conv_id = r.conv_id AND u.turn = r.turn - 1
"""
