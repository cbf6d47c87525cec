"""Chat formatting: link tool calls to results, order them, validate, write canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmart.llm.common import find_package, table
from reviewmart.session import stage

_TYPES: dict[str, Any] = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: (isinstance(v, int) and not isinstance(v, bool)) or (isinstance(v, float) and v.is_integer()),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}


#: Keywords that say nothing about what is valid.
_NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$comment", "$schema", "$id"}
_RULES = {
    "type", "enum", "const", "required", "properties", "additionalProperties", "minProperties", "maxProperties",
    "items", "minItems", "maxItems", "uniqueItems", "minLength", "maxLength",
    "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "anyOf", "allOf", "oneOf", "not",
}


def check_schema(schema: Any) -> None:
    """Raise ValueError where a schema has a keyword that ``violations`` does not judge."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"no schema: {schema!r}")
    unknown = sorted(set(schema) - _RULES - _NOTES)
    if unknown:
        raise ValueError(f"keywords not supported: {', '.join(unknown)}")
    types = schema.get("type", [])
    for name in [types] if isinstance(types, str) else types:
        if name not in _TYPES:
            raise ValueError(f"no type: {name}")
    parts = [*schema.get("properties", {}).values()]
    parts += [schema[k] for k in ("items", "additionalProperties", "not") if k in schema]
    for part in parts + [p for k in ("anyOf", "allOf", "oneOf") for p in schema.get(k, [])]:
        check_schema(part)


def _plain(value: Any) -> Any:
    """A value that equals another's exactly where JSON Schema takes both for equal."""
    if isinstance(value, dict):
        return ("object", frozenset((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, list):
        return ("array", tuple(map(_plain, value)))
    return (isinstance(value, bool), value)


def _broken(value: Any, rule: Any, path: str) -> Iterator[str]:
    """``path:rule`` of every rule that a value breaks; a value of a wrong type is judged no further."""
    if isinstance(rule, bool):
        if not rule:
            yield f"{path}:false"
        return
    if "type" in rule:
        types = [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
        if not any(_TYPES[t](value) for t in types):
            yield f"{path}:type"
            return
    if "enum" in rule and _plain(value) not in map(_plain, rule["enum"]):
        yield f"{path}:enum"
    if "const" in rule and _plain(value) != _plain(rule["const"]):
        yield f"{path}:const"
    if isinstance(value, str):
        sizes = ("minLength", "maxLength")
    elif isinstance(value, list):
        sizes = ("minItems", "maxItems")
    else:
        sizes = ("minProperties", "maxProperties")
    if isinstance(value, (str, list, dict)):
        if len(value) < rule.get(sizes[0], 0):
            yield f"{path}:{sizes[0]}"
        if sizes[1] in rule and len(value) > rule[sizes[1]]:
            yield f"{path}:{sizes[1]}"
    elif _TYPES["number"](value):
        if "minimum" in rule and value < rule["minimum"]:
            yield f"{path}:minimum"
        if "maximum" in rule and value > rule["maximum"]:
            yield f"{path}:maximum"
        if "exclusiveMinimum" in rule and value <= rule["exclusiveMinimum"]:
            yield f"{path}:exclusiveMinimum"
        if "exclusiveMaximum" in rule and value >= rule["exclusiveMaximum"]:
            yield f"{path}:exclusiveMaximum"
    if isinstance(value, dict):
        inner = f"{path}." if path else ""
        known, others = rule.get("properties", {}), rule.get("additionalProperties", True)
        yield from (f"{inner}{name}:required" for name in rule.get("required", []) if name not in value)
        for name, part in value.items():
            if name in known:
                yield from _broken(part, known[name], inner + name)
            elif others is False:
                yield f"{inner}{name}:additionalProperties"
            else:
                yield from _broken(part, others, inner + name)
    if isinstance(value, list):
        if rule.get("uniqueItems") and len(set(map(_plain, value))) < len(value):
            yield f"{path}:uniqueItems"
        for k, part in enumerate(value):
            yield from _broken(part, rule.get("items", True), f"{path}[{k}]")
    for part in rule.get("allOf", []):
        yield from _broken(value, part, path)
    for name, right in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if name in rule and not right(sum(not any(_broken(value, part, path)) for part in rule[name])):
            yield f"{path}:{name}"
    if "not" in rule and not any(_broken(value, rule["not"], path)):
        yield f"{path}:not"


def violations(arguments: Any, schema: dict) -> list[str]:
    """What JSON Schema finds wrong with the arguments, as sorted ``field:rule``.

    Fields inside others are ``outer.inner`` and ``list[0]``; rules of the arguments as a whole
    have no field. Keywords outside ``_RULES`` are refused by ``check_schema``.
    """
    if not isinstance(arguments, dict):
        return ["arguments:type"]
    return sorted(set(_broken(arguments, schema, "")))


def canonical(value: Any) -> str:
    """JSON with sorted keys, no blanks, and letters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _finite(digits: str) -> float:
    number = float(digits)
    if number in (float("inf"), float("-inf")):
        raise ValueError(f"no finite number: {digits}")
    return number


def _refuse(name: str) -> None:
    raise ValueError(f"no JSON: {name}")


def _parse(text: str | None) -> tuple[Any, bool]:
    """The value of a JSON text, or the text and False.

    What canonical JSON cannot hold is refused too: numbers that are not finite, halves of
    surrogate pairs, and values nested deeper than Python can follow.
    """
    try:
        value = json.loads(text or "", parse_float=_finite, parse_constant=_refuse)
        canonical(value).encode()
    except (ValueError, RecursionError):
        return text, False
    return value, True


def _write(schemas: dict[str, dict]):
    def line(kind, call_id, name, payload) -> tuple[str, str | None]:
        if kind == "message":
            return canonical({"type": kind, "role": name, "content": payload}), None
        if kind == "result":
            return canonical({"type": kind, "id": call_id, "content": payload}), None
        arguments, parsed = _parse(payload)
        if not parsed:
            errors = ["arguments:json"]
        elif name not in schemas:
            errors = ["name:unknown"]
        else:
            errors = violations(arguments, schemas[name])
        return canonical({"type": kind, "id": call_id, "name": name, "arguments": arguments}), ";".join(errors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            parts = [batch.column(names.index(c)).to_pylist() for c in ("kind", "call_id", "name", "payload")]
            lines = [line(*row) for row in zip(*parts)]
            kept = [n for n in names if n not in ("name", "payload")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(names.index(n)) for n in kept),
                    pa.array([m for m, _ in lines], pa.string()),
                    pa.array([e for _, e in lines], pa.string()),
                ],
                names=[*kept, "message", "errors"],
            )

    return run


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) of ``calls`` (call_id, parent_id): how many calls each one waits for.

    A parent that is no call counts as none. Every round each call looks twice as far up, so the
    rounds grow with the logarithm of the longest chain. Calls on or behind a cycle never reach
    a root; after more rounds than a chain of all calls needs, their depth is null.
    """
    total = calls.count()
    ids = calls.select(F.col("call_id").alias("parent_id"), F.lit(True).alias("there"))
    state = stage(
        calls.join(ids, "parent_id", "left").select(
            "call_id",
            F.when(F.col("there"), F.col("parent_id")).alias("up"),
            F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"),
        ),
        "depths",
    )
    for _ in range(total.bit_length() + 1):
        if state.where("up IS NOT NULL").isEmpty():
            break
        done = state.where("up IS NULL")
        open_ = state.where("up IS NOT NULL")
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        further = open_.join(above, "up").select(
            "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth")
        )
        state = stage(done.unionByName(further), "depths")
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(
    calls: DataFrame, results: DataFrame, schemas: dict[str, dict], messages: DataFrame | None = None
) -> DataFrame:
    """Calls and results of conversations as ordered, validated lines of canonical JSON.

    ``calls``: conv_id, turn, call_id, parent_id, name, arguments (JSON text); ``results``:
    conv_id, turn, call_id, content; ``messages``, the turns that are neither: conv_id, turn, role,
    content. Other columns are ignored. Returns conv_id, turn, kind,
    call_id, depth, step, status, message, errors, one row per input row. Sorting a conversation
    by (depth, step, turn) puts a call after the result it waits for, and a result after its call.

    An id, also of a parent, names a call of its own conversation; rows without a conv_id are one
    conversation. Schemas with keywords that are not judged raise ValueError.

    status: a call is ``linked`` or ``unanswered``; ``duplicate`` where an earlier row has its id
    (least turn, then arguments; equal rows are all first); ``cyclic`` where its parents never
    end. A result is ``linked`` or ``orphan`` (then its depth is null). Without an id a row is
    ``unidentified``. A message is ``plain`` and has no depth. errors: a call's violations of its schema, joined by ``;``. Null arguments
    are no JSON; null contents are written as null.
    """
    find_package(calls.sparkSession)
    for schema in schemas.values():
        check_schema(schema)
    # As a struct, so that null conversations are equal in joins too.
    own = F.struct("conv_id", "call_id")
    calls = calls.select("conv_id", "turn", "call_id", "parent_id", "name", "arguments").withColumn("id", own)
    results = results.select("conv_id", "turn", "call_id", "content").withColumn("id", own)
    first = stage(
        calls.where("call_id IS NOT NULL")
        .groupBy("id")
        .agg(F.min(F.struct("turn", "arguments", "parent_id")).alias("first"))
        .select("id", "first.*"),
        "calls",
    )
    answered = results.where("call_id IS NOT NULL").select("id").distinct()
    parent = F.struct("id.conv_id", F.col("parent_id").alias("call_id")).alias("parent_id")
    known = stage(
        first.withColumnRenamed("arguments", "first_arguments")
        .withColumnRenamed("turn", "first_turn")
        .drop("parent_id")
        .join(depths(first.select(F.col("id").alias("call_id"), parent)).withColumnRenamed("call_id", "id"), "id")
        .join(answered.withColumn("answered", F.lit(True)), "id", "left"),
        "known",
    )
    again = ~(F.col("turn").eqNullSafe(F.col("first_turn")) & F.col("arguments").eqNullSafe(F.col("first_arguments")))
    asked = calls.join(known, "id", "left").select(
        "conv_id",
        "turn",
        F.lit("call").alias("kind"),
        "call_id",
        "depth",
        F.lit(0).alias("step"),
        F.when(F.col("call_id").isNull(), "unidentified")
        .when(again, "duplicate")
        .when(F.col("depth").isNull(), "cyclic")
        .when(F.col("answered"), "linked")
        .otherwise("unanswered")
        .alias("status"),
        "name",
        F.col("arguments").alias("payload"),
    )
    replied = results.join(known.select("id", "depth", F.lit(True).alias("there")), "id", "left").select(
        "conv_id",
        "turn",
        F.lit("result").alias("kind"),
        "call_id",
        "depth",
        F.lit(1).alias("step"),
        F.when(F.col("call_id").isNull(), "unidentified").when(F.col("there"), "linked").otherwise("orphan").alias("status"),
        F.lit(None).cast("string").alias("name"),
        F.col("content").alias("payload"),
    )
    schema = (
        "conv_id long, turn long, kind string, call_id string, depth long, step int, status string, "
        "message string, errors string"
    )
    lines = asked.unionByName(replied)
    if messages is not None:
        said = messages.select(
            "conv_id",
            "turn",
            F.lit("message").alias("kind"),
            F.lit(None).cast("string").alias("call_id"),
            F.lit(None).cast("long").alias("depth"),
            F.lit(0).alias("step"),
            F.lit("plain").alias("status"),
            F.col("role").alias("name"),
            F.col("content").alias("payload"),
        )
        lines = lines.unionByName(said)
    return lines.mapInArrow(_write(schemas), schema)


#: Three tools for the query, so that every rule is met and broken somewhere.
TOOLS = {
    "search": {
        "required": ["limit", "text"],
        "properties": {
            "text": {"type": "string", "minLength": 1, "maxLength": 900},
            "limit": {"type": "integer", "minimum": 1, "maximum": 50},
        },
        "additionalProperties": False,
    },
    "lookup": {
        "required": ["limit", "text"],
        "properties": {"text": {"type": "string"}, "limit": {"type": "integer", "maximum": 40}},
        "additionalProperties": False,
    },
    "summarise": {
        "required": ["text"],
        "properties": {"text": {"type": "string", "maxLength": 1500}, "limit": {"type": "string"}},
    },
}


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All assistant turns as calls, all user turns as results of the turn before, others as messages.

    A call waits for the assistant's last one, two turns before. The tool follows from the turn,
    the limit from the length of the text; a limit of 0 is left out, and every seventh is text.
    """
    turns = table(spark, sf_dir, "conversations")

    def named(shift: int):
        return F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - shift).cast("string")))

    size = F.length("text") % 60
    limit = F.to_json(
        F.struct(
            F.when((size != 0) & (F.col("turn") % 7 != 6), size).alias("limit"),
            "text",
        )
    )
    quoted = F.to_json(F.struct(F.col("text"), F.when(size != 0, size.cast("string")).alias("limit")))
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        "turn",
        named(0).alias("call_id"),
        named(2).alias("parent_id"),
        F.element_at(F.array(F.lit("search"), F.lit("lookup"), F.lit("summarise")), (F.col("turn") % 3 + 1).cast("int")).alias("name"),
        F.when((F.col("turn") % 3 == 2) | (F.col("turn") % 7 == 6), quoted).otherwise(limit).alias("arguments"),
    )
    results = turns.where("role = 'user'").select("conv_id", "turn", named(1).alias("call_id"), F.col("text").alias("content"))
    other = ~(F.col("role").eqNullSafe("assistant") | F.col("role").eqNullSafe("user"))
    return link(calls, results, TOOLS, turns.where(other).withColumn("content", F.col("text")))


_SQL = """
WITH RECURSIVE a AS (
  SELECT conv_id, turn, text, length(text) % 60 AS size, md5(conv_id::VARCHAR || ':' || turn::VARCHAR) AS call_id,
         (turn % 3 = 2 OR turn % 7 = 6) AS quoted, ['search', 'lookup', 'summarise'][(turn % 3 + 1)::INT] AS name
  FROM conversations WHERE role = 'assistant'),
chain AS (
  SELECT conv_id, turn, 0::BIGINT AS depth FROM a
  WHERE NOT EXISTS (SELECT 1 FROM a p WHERE p.conv_id = a.conv_id AND p.turn = a.turn - 2)
  UNION ALL
  SELECT a.conv_id, a.turn, chain.depth + 1 FROM a JOIN chain ON a.conv_id = chain.conv_id AND a.turn = chain.turn + 2),
calls AS (
  SELECT a.*, chain.depth,
         CASE WHEN size = 0 THEN '' WHEN quoted THEN '"limit":"' || size::VARCHAR || '",' ELSE '"limit":' || size::VARCHAR || ',' END AS lim,
         EXISTS (SELECT 1 FROM conversations u WHERE u.role = 'user' AND u.conv_id = a.conv_id AND u.turn = a.turn + 1) AS answered
  FROM a JOIN chain USING (conv_id, turn)),
broken AS (
  SELECT *,
         CASE WHEN name = 'summarise' THEN ''
              WHEN size = 0 THEN 'limit:required'
              WHEN quoted THEN 'limit:type'
              WHEN name = 'search' AND size > 50 THEN 'limit:maximum'
              WHEN name = 'lookup' AND size > 40 THEN 'limit:maximum'
              ELSE '' END AS e1,
         CASE WHEN name = 'search' AND length(text) < 1 THEN 'text:minLength'
              WHEN name = 'search' AND length(text) > 900 THEN 'text:maxLength'
              WHEN name = 'summarise' AND length(text) > 1500 THEN 'text:maxLength'
              ELSE '' END AS e2
  FROM calls)
SELECT conv_id, turn, 'call' AS kind, call_id, depth, 0::INT AS step,
       CASE WHEN answered THEN 'linked' ELSE 'unanswered' END AS status,
       '{"arguments":{' || lim || '"text":' || to_json(text)::VARCHAR || '},"id":"' || call_id || '","name":"' || name || '","type":"call"}' AS message,
       CASE WHEN e1 <> '' AND e2 <> '' THEN e1 || ';' || e2 ELSE e1 || e2 END AS errors
FROM broken
UNION ALL
SELECT u.conv_id, u.turn, 'result', md5(u.conv_id::VARCHAR || ':' || (u.turn - 1)::VARCHAR), c.depth, 1::INT,
       CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END,
       '{"content":' || to_json(u.text)::VARCHAR || ',"id":"' || md5(u.conv_id::VARCHAR || ':' || (u.turn - 1)::VARCHAR) || '","type":"result"}',
       NULL
FROM conversations u LEFT JOIN calls c ON c.conv_id = u.conv_id AND c.turn = u.turn - 1
WHERE u.role = 'user'
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, 0::INT, 'plain',
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"type":"message"}',
       NULL
FROM conversations WHERE role IS DISTINCT FROM 'assistant' AND role IS DISTINCT FROM 'user'
"""

QUERIES = {"op10_tool_calls": op10_tool_calls}
ORACLES = {"op10_tool_calls": _SQL}
