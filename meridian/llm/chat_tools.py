"""Chat formatting: link tool calls to results, order them, validate arguments, write canonical JSON.

Input rows are messages: ``conv_id, turn, role, text`` plus ``calls`` (array of ``id, name,
arguments`` with arguments as JSON text) and ``call_id`` for a result. Calls and results
are hash-joined by conversation and identifier; the first call and the first result of an
identifier (by turn) are the ones that link, found by a pre-aggregated minimum, so a
repeated identifier never multiplies rows. Calls may use another call's result through
``{"$ref": "<call id>"}`` inside their arguments; rounds of joins give every call its level
in that graph. Rows stay rows: a conversation of any length is ordered by its sort columns
``order_turn, level, kind_rank, turn, item`` and never gathered.

Defined results: a call or result without id, or whose partner is missing, is
``unlinked``; later rows with the same identifier are ``duplicate``; calls on a reference
cycle, or that use an unknown call, are ``unordered`` and keep their own turn; arguments
that are not a JSON object, nest deeper than ``MAX_DEPTH`` or hold a number that is not finite or has
over 4,300 digits are invalid and kept as text; lone surrogates stay escaped and a reference that
holds one is unknown; a schema with an unsupported keyword or type fails by name before any row is
read; null texts are JSON null; a null conversation id is
a conversation of its own; repeated rows repeat (the repeated call is a duplicate only if
its turn or place differs).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import written

CALLS = "array<struct<id: string, name: string, arguments: string>>"
MAX_DEPTH = 200
_KINDS = {"null": type(None), "boolean": bool, "string": str, "array": list, "object": dict}
_KEYWORDS = {"type", "enum", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength",
             "maxLength"}
_NOTES = {"title", "description", "default", "examples", "$comment"}  # annotations say nothing about values
_SURROGATE = re.compile("[\ud800-\udfff]")


def _escaped(text: str) -> str:
    """Lone surrogates, which no UTF-8 text can hold, as JSON escapes."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def too_deep(value) -> bool:
    """Whether arrays and objects nest deeper than ``MAX_DEPTH``, found level by level."""
    level = [value]
    for _ in range(MAX_DEPTH + 1):
        level = [v for x in level if isinstance(x, list | dict) for v in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return False
    return any(isinstance(x, list | dict) for x in level)


def check_schema(schema: dict, at: str) -> None:
    """Fails on a keyword or type that ``violations`` would not test."""
    unknown = sorted(set(schema) - _KEYWORDS - _NOTES)
    if unknown:
        raise ValueError(f"{at}: schema keyword {unknown[0]!r} is not supported")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in {*_KINDS, "number", "integer"}:
            raise ValueError(f"{at}: type {kind!r} is not supported")
    parts = {f"{at}.{k}": v for k, v in schema.get("properties", {}).items()}
    parts |= {f"{at}[]": schema["items"]} if "items" in schema else {}
    extra = schema.get("additionalProperties", True)
    parts |= {} if isinstance(extra, bool) else {f"{at}.*": extra}
    for where, part in parts.items():
        if not isinstance(part, dict):
            raise ValueError(f"{where}: a schema has to be an object")
        check_schema(part, where)


def canonical(value) -> str:
    """JSON with sorted keys, no white space, shortest numbers (1.0 is 1) and unescaped Unicode
    (but for lone surrogates)."""

    def plain(x):
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("not a JSON number")
            return int(x) if x.is_integer() and abs(x) < 2**53 else x
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return _escaped(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of the schema keywords type, enum, required, properties, additionalProperties,
    items, minimum, maximum, minLength and maxLength; a ``$ref`` object stands for any value."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    found = []
    kinds = schema.get("type")
    if kinds is not None:
        number = isinstance(value, int | float) and not isinstance(value, bool)
        fits = {k: isinstance(value, t) for k, t in _KINDS.items()}
        fits |= {"number": number, "integer": number and (isinstance(value, int) or value.is_integer())}
        if not any(fits.get(k, False) for k in ([kinds] if isinstance(kinds, str) else kinds)):
            return [f"{at}: type"]
    # compared as JSON: true is not 1, 1.0 is
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        found.append(f"{at}: enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        extra = schema.get("additionalProperties", True)
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif extra is False:
                found.append(f"{at}.{k}: unknown")
            elif isinstance(extra, dict):
                found += violations(value[k], extra, f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        found += [e for i, v in enumerate(value) for e in violations(v, schema["items"], f"{at}[{i}]")]
    if isinstance(value, int | float) and not isinstance(value, bool):
        found += [f"{at}: minimum"] if value < schema.get("minimum", value) else []
        found += [f"{at}: maximum"] if value > schema.get("maximum", value) else []
    if isinstance(value, str):
        found += [f"{at}: minLength"] if len(value) < schema.get("minLength", 0) else []
        found += [f"{at}: maxLength"] if len(value) > schema.get("maxLength", len(value)) else []
    return found


def _references(value) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        return {r for v in value.values() for r in _references(v)}
    return {r for v in value for r in _references(v)} if isinstance(value, list) else set()


def from_json_turns(conversations: DataFrame) -> DataFrame:
    """Messages from turns whose text is JSON: ``{"tool_calls": [{id, function: {name, arguments}}]}``
    for calls, ``{"tool_call_id": ...}`` for results; any other text is an ordinary message."""
    parsed = F.from_json("text", "tool_calls array<struct<id: string, function: struct<name: string, arguments: string>>>,"
                                 " tool_call_id string")
    calls = F.transform(F.coalesce("_p.tool_calls", F.lit(None)),
                        lambda c: F.struct(c["id"].alias("id"), c["function"]["name"].alias("name"),
                                           c["function"]["arguments"].alias("arguments")))
    return (conversations.select("conv_id", "turn", "role", "text", parsed.alias("_p"))
            .select("conv_id", "turn", "role", "text", calls.cast(CALLS).alias("calls"),
                    F.col("_p.tool_call_id").alias("call_id")))


def from_exchanges(conversations: DataFrame) -> DataFrame:
    """Messages that read every exchange as a tool call: a user turn calls ``reply`` with its
    text, the assistant turn after it is the result."""
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    before = F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn")),
                          {"ignoreNullFields": "false"})
    return conversations.select(
        "conv_id", "turn", "role", "text",
        F.when(F.col("role") == "user", F.array(F.struct(
            key.alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments")))).cast(CALLS).alias("calls"),
        F.when(F.col("role") == "assistant", before).alias("call_id"))


def _levels(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """``conv_id, id, level, ready`` of calls in dependency order; calls never ready are left out.

    ``ready`` is the turn after which the call can stand: its own, or that of the last result it uses.
    """
    done = calls.where(F.size("refs") == 0).select(
        "conv_id", "id", F.lit(0).alias("level"), F.col("turn").alias("ready"),
        F.greatest("turn", F.coalesce("result_turn", "turn")).cast("long").alias("after"))
    waiting = calls.where(F.size("refs") > 0)
    if not waiting.limit(1).count():
        return done.drop("after")
    edges = written(spark, waiting.select("conv_id", "id", "turn", "result_turn", F.size("refs").alias("needs"),
                                          F.explode("refs").alias("ref")), "chat-refs")
    done = written(spark, done, "chat-levels")
    fresh, level = done, 1
    found = None
    while True:
        known = fresh.select(F.col("conv_id").alias("c"), F.col("id").alias("r"), "after")
        met = edges.join(known, edges.conv_id.eqNullSafe(F.col("c")) & (F.col("ref") == F.col("r"))).select(
            "conv_id", "id", F.col("after").cast("long").alias("after"))
        found = written(spark, met if found is None else found.unionByName(met), "chat-found")
        full = (found.groupBy("conv_id", "id").agg(F.count("*").alias("n"), F.max("after").alias("last"))
                .alias("f").join(edges.dropDuplicates(["conv_id", "id"]).alias("e"),
                                 F.expr("f.conv_id <=> e.conv_id and f.id = e.id and f.n = e.needs"))
                .select("e.conv_id", "e.id", "e.turn", "e.result_turn", "last"))
        ready = F.greatest("turn", "last")
        fresh = full.select("conv_id", "id", F.lit(level).alias("level"), ready.alias("ready"),
                            F.greatest(ready, F.coalesce("result_turn", "turn")).cast("long").alias("after"))
        fresh = written(spark, fresh.alias("f").join(done.alias("d"), F.expr("f.conv_id <=> d.conv_id and f.id = d.id"),
                                                     "left_anti"), "chat-fresh")
        if not fresh.limit(1).count():
            return done.drop("after")
        done = written(spark, done.unionByName(fresh), "chat-levels")
        level += 1


def link_tools(spark: SparkSession, messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, call and result: ``conv_id, turn, item, role, kind, id, name, status,
    valid, errors, order_turn, level, kind_rank, json``. A call of a tool without schema is invalid."""
    for tool, schema in schemas.items():
        check_schema(schema, tool)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("role", "text", "kind", "id", "name", "arguments")}
            texts, errors, refs = [], [], []
            for role, text, kind, key, name, raw in zip(*cols.values(), strict=True):
                wrong: list[str] = []
                used: set[str] = set()
                body: dict = {"role": role}
                if kind == "call":
                    try:
                        arguments = json.loads(raw)
                        deep = too_deep(arguments)
                        if not deep:
                            canonical(arguments)
                    except RecursionError:
                        deep = True
                    except (TypeError, ValueError):
                        deep, arguments, wrong = False, raw, ["$: not JSON"]
                    if deep:
                        arguments, wrong = raw, ["$: nested too deeply"]
                    elif not wrong:
                        used = _references(arguments)
                        if not isinstance(arguments, dict):
                            wrong = ["$: not an object"]
                        elif name not in schemas:
                            wrong = ["$: unknown tool"]
                        else:
                            wrong = violations(arguments, schemas[name])
                    body |= {"tool_call": {"id": key, "name": name, "arguments": arguments}}
                elif kind == "result":
                    body |= {"tool_call_id": key, "content": text}
                else:
                    body |= {"content": text}
                texts.append(canonical(body))
                errors.append([_escaped(e) for e in wrong] if kind == "call" else None)
                # an identifier is UTF-8 text, so a reference with a lone surrogate equals none
                refs.append([None if _SURROGATE.search(r) else r for r in sorted(used)])
            keep = [batch.column(n) for n in ("conv_id", "turn", "item", "role", "kind", "id", "name")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(errors, pa.list_(pa.string())), pa.array(refs, pa.list_(pa.string())),
                 pa.array(texts, pa.string())],
                names=["conv_id", "turn", "item", "role", "kind", "id", "name", "errors", "refs", "json"])

    base = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "calls", "call_id")
    plain = base.select("conv_id", "turn", F.lit(0).alias("item"), "role", "text",
                        F.when(F.col("call_id").isNotNull(), "result").otherwise("message").alias("kind"),
                        F.col("call_id").alias("id"), F.lit(None).cast("string").alias("name"),
                        F.lit(None).cast("string").alias("arguments"),
                        F.coalesce(F.size("calls"), F.lit(0)).alias("_calls"))
    # a turn that only carries calls gives no message row
    plain = plain.where((F.col("_calls") <= 0) | (F.col("kind") == "result")).drop("_calls")
    calls = base.select("conv_id", "turn", "role", "text", F.posexplode("calls").alias("item", "call")).select(
        "conv_id", "turn", "item", "role", "text", F.lit("call").alias("kind"), F.col("call.id").alias("id"),
        F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"))
    kind = base.schema["conv_id"].dataType.simpleString()
    rows = written(spark, plain.unionByName(calls).mapInArrow(
        check, f"conv_id {kind}, turn long, item int, role string, kind string, id string, name string, "
               "errors array<string>, refs array<string>, json string"), "chat-rows")

    named = rows.where("id is not null")
    first_call = named.where("kind = 'call'").groupBy("conv_id", "id").agg(
        F.min(F.struct("turn", "item", "refs")).alias("call"))
    first_result = named.where("kind = 'result'").groupBy("conv_id", "id").agg(F.min("turn").alias("result_turn"))
    linked = first_call.alias("c").join(first_result.alias("r"), F.expr("c.conv_id <=> r.conv_id and c.id = r.id"), "full").select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"), F.coalesce("c.id", "r.id").alias("id"),
        F.col("call.turn").alias("turn"), F.col("call.item").alias("item"), F.col("call.refs").alias("refs"), "result_turn")
    linked = written(spark, linked, "chat-linked")
    levels = _levels(spark, linked.where("turn is not null")).select(
        F.col("conv_id").alias("lc"), F.col("id").alias("li"), "level", "ready")
    links = linked.join(levels, F.expr("conv_id <=> lc and id = li"), "left").select(
        F.col("conv_id").alias("kc"), F.col("id").alias("ki"), F.col("turn").alias("call_turn"),
        F.col("item").alias("call_item"), "result_turn", "level", "ready")
    links = written(spark, links, "chat-links")

    joined = rows.join(links, F.expr("conv_id <=> kc and id = ki"), "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    own = F.when(is_call, F.col("turn").eqNullSafe(F.col("call_turn")) & (F.col("item") == F.col("call_item"))).otherwise(
        F.col("turn").eqNullSafe(F.col("result_turn")))
    status = (F.when(F.col("kind") == "message", F.lit(None))
              .when(F.col("ki").isNull() | F.col("call_turn").isNull(), "unlinked")
              .when(~own, "duplicate")
              .when(is_call & F.col("level").isNull(), "unordered")
              .when(F.col("result_turn").isNull(), "unlinked").otherwise("linked"))
    ready = F.greatest("turn", F.coalesce("ready", "call_turn", "turn"))
    return joined.select(
        "conv_id", "turn", "item", "role", "kind", "id", "name", status.cast("string").alias("status"),
        F.when(is_call, F.size("errors") == 0).alias("valid"), "errors",
        F.when(own & (is_call | is_result), ready).otherwise(F.col("turn")).alias("order_turn"),
        F.coalesce("level", F.lit(0)).alias("level"), F.when(is_result, 1).otherwise(0).alias("kind_rank"), "json")
