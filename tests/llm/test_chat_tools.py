import json

import pytest

from meridian.llm import chat_tools as C

SCHEMAS = {"f": {"type": "object", "required": ["a"], "properties": {
    "a": {"type": ["integer", "string"], "minimum": 0, "maxLength": 3}, "b": {"type": "array", "items": {"enum": [1, 2]}}},
    "additionalProperties": False}}
SHAPE = f"conv_id long, turn long, role string, text string, calls {C.CALLS}, call_id string, item string, status int"


def _messages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SHAPE)


def _call(key, arguments, name="f"):
    return (key, name, arguments if isinstance(arguments, str) or arguments is None else json.dumps(arguments))


def _run(spark, rows):
    out = C.link_tools(spark, _messages(spark, rows), SCHEMAS).collect()
    key = lambda r: (r.conv_id is not None, r.conv_id or 0, r.order_turn, r.level, r.kind_rank, r.turn, r.item)
    return sorted(out, key=key)


def test_links_order_and_canonical_json(spark):
    rows = [(1, 0, "user", "hé\"", None, None),
            (1, 2, "tool", "early", None, "x"),  # comes before its call
            (1, 3, "assistant", None, [_call("x", {"b": [1], "a": 1.0}), _call("y", {"a": {"$ref": "x"}})], None),
            (1, 4, "tool", None, None, "y"), (1, 5, "tool", "again", None, "y"), (1, 6, "tool", "lost", None, "q"),
            (2, 0, "assistant", None, [_call("x", {"a": "abcd"})], None), (None, 0, "user", None, None, None)]
    out = _run(spark, rows)
    got = {(r.conv_id, r.turn, r.item): r for r in out}
    assert len(out) == 9
    assert got[1, 3, 0].status == got[1, 2, 0].status == got[1, 3, 1].status == got[1, 4, 0].status == "linked"
    assert got[1, 5, 0].status == "duplicate" and got[1, 6, 0].status == got[2, 0, 0].status == "unlinked"
    assert got[1, 3, 0].valid and got[1, 3, 1].valid and not got[2, 0, 0].valid
    assert got[2, 0, 0].errors == ["$.a: maxLength"]
    order = [(r.turn, r.item, r.kind) for r in out if r.conv_id == 1]
    assert order.index((3, 0, "call")) < order.index((2, 0, "result")) and got[1, 3, 1].level == 1
    assert order.index((2, 0, "result")) < order.index((3, 1, "call")) < order.index((4, 0, "result"))
    assert got[1, 3, 0].json == '{"role":"assistant","tool_call":{"arguments":{"a":1,"b":[1]},"id":"x","name":"f"}}'
    assert got[1, 0, 0].json == '{"content":"hé\\"","role":"user"}' and got[1, 0, 0].status is None
    assert got[None, 0, 0].json == '{"content":null,"role":"user"}'


def test_cycles_unknown_references_and_bad_arguments(spark):
    rows = [(1, 0, "assistant", None, [_call("a", {"a": {"$ref": "b"}}), _call("b", {"a": {"$ref": "a"}}),
                                       _call("c", {"a": {"$ref": "nowhere"}}), _call("d", "{broken"), _call("e", None),
                                       _call("f", "[1]"), _call("g", {"z": 1}), _call("h", {}, "other"),
                                       _call(None, {"a": 1}), _call("e", {"a": 2})], None)]
    rows += [(1, i, "tool", "r", None, k) for i, k in enumerate("abcdefgh", start=1)]
    got = {r.item: r for r in _run(spark, rows) if r.kind == "call"}
    assert [got[i].status for i in range(3)] == ["unordered"] * 3
    assert [got[i].status for i in (3, 4, 5, 6, 7)] == ["linked"] * 5
    assert got[8].status == "unlinked" and got[9].status == "duplicate"
    assert [got[i].errors for i in (3, 4, 5, 7)] == [["$: not JSON"], ["$: not JSON"], ["$: not an object"], ["$: unknown tool"]]
    assert got[6].errors == ["$.a: required", "$.z: unknown"] and got[8].valid


def test_long_reference_chain_and_hot_identifier(spark):
    calls = [_call("c0", {"a": 1})] + [_call(f"c{i}", {"a": {"$ref": f"c{i - 1}"}}) for i in range(1, 6)]
    rows = [(1, 0, "assistant", None, calls, None)] + [(1, 10 + i, "tool", "r", None, f"c{i}") for i in range(6)]
    rows += [(2, i, "assistant", None, [_call("same", {"a": 1})], None) for i in range(200)]
    out = _run(spark, rows)
    assert [r.level for r in out if r.conv_id == 1 and r.kind == "call"] == list(range(6))
    assert [r.kind for r in out if r.conv_id == 1] == ["call", "result"] * 6
    assert sorted(r.status for r in out if r.conv_id == 2) == ["duplicate"] * 199 + ["unlinked"]


def test_json_turns_exchanges_and_empty_table(spark):
    call = json.dumps({"tool_calls": [{"id": "k", "function": {"name": "f", "arguments": '{"a":1}'}}]})
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", call),
                                   (1, 2, "tool", json.dumps({"tool_call_id": "k", "content": "ok"}))],
                                  "conv_id long, turn long, role string, text string")
    out = C.link_tools(spark, C.from_json_turns(turns), SCHEMAS).collect()
    assert sorted((r.turn, r.kind, r.status) for r in out) == [(0, "message", None), (1, "call", "linked"), (2, "result", "linked")]
    empty = turns.limit(0)
    assert C.link_tools(spark, C.from_exchanges(empty), SCHEMAS).count() == 0


def test_canonical_numbers_and_schema_keywords():
    assert C.canonical({"b": 1.0, "a": [0.5, None, True], "c": {"é": 2}}) == '{"a":[0.5,null,true],"b":1,"c":{"é":2}}'
    schema = {"type": "object", "properties": {"n": {"type": "number", "maximum": 3}, "s": {"minLength": 2}},
              "additionalProperties": {"type": "boolean"}}
    assert C.violations({"n": 4, "s": "x", "q": 1}, schema) == ["$.n: maximum", "$.q: type", "$.s: minLength"]
    assert C.violations({"n": True}, schema) == ["$.n: type"] and C.violations({"n": 2.5, "q": False}, schema) == []


def test_hostile_arguments_have_a_defined_result(spark):
    deep = "[" * 100_000 + "]" * 100_000
    raws = [r'{"a":"\ud800"}', r'{"\udfff":1,"a":1}', r'{"a":{"$ref":"\ud800"}}', '{"a":1' + "0" * 400 + "}", '{"a":' + "9" * 5000 + "}",
            '{"a":' + deep + "}", '{"a":' + "[" * 300 + "]" * 300 + "}", deep, '{"a":1e999}', '{"b":[true],"a":1}', '{"b":[1.0],"a":1}']
    rows = [(1, i, "assistant", None, [_call(f"k{i}", raw)], None) for i, raw in enumerate(raws)]
    got = {r.turn: r for r in _run(spark, rows)}
    assert [got[i].errors for i in range(11)] == [
        [], [r"$.\udfff: unknown"], [], [], ["$: not JSON"], *[["$: nested too deeply"]] * 3, ["$: not JSON"], ["$.b[0]: enum"], []]
    assert r'{"a":"\ud800"}' in got[0].json and got[2].status == "unordered" and "1" + "0" * 400 in got[3].json
    assert json.loads(got[7].json)["tool_call"]["arguments"] == deep
    assert C.too_deep([[1]] * 3) is False


@pytest.mark.parametrize("schema, word", [({"pattern": "a"}, "pattern"), ({"properties": {"q": {"oneOf": []}}}, "oneOf"),
                                          ({"items": {"type": "decimal"}}, "decimal"), ({"items": [{}]}, "object")])
def test_unsupported_schemas_are_refused_by_name(spark, schema, word):
    with pytest.raises(ValueError, match=word):
        C.link_tools(spark, _messages(spark, []), {"f": schema})
