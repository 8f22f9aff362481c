"""Tool calls linked, ordered, validated and serialised."""

import json
import random

import pytest

from pliego.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, json string"


def call(i, name, **arguments):
    return "<tool_call>" + json.dumps({"id": i, "name": name, "arguments": arguments}) + "</tool_call>"


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


TOOLS = json.dumps({"tools": [{"name": "add", "parameters": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"enum": [1, 2]}}, "additionalProperties": False}}]})


def run(spark, rows):
    got = chat.link_calls(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[5] or 0, r[6], r[1] or 0, r[2]))


def test_links_orders_and_validates(spark):
    rows = [
        (1, 0, "system", TOOLS),
        (1, 1, "user", "sum, please é"),
        (1, 2, "assistant", "ok " + call("y", "add", a={"$result": "x"}) + call("x", "add", a=2, b=1)),
        (1, 3, "tool", result("y", [1, {"b": 2.0, "a": 1}])),
        (1, 4, "tool", result("x", "three")),
        (1, 5, "assistant", call("z", "add", a=-1, c=1) + call("x", "add", a=1) + "<tool_call>{bad</tool_call>"),
        (1, 6, "tool", result("lost", None)),
        (2, 0, "tool", result("x", "other conversation")),
    ]
    got = run(spark, rows)
    kinds = [(r[3], r[4]) for r in got if r[0] == 1]
    assert kinds.count(("message", "ok")) == 4
    status = {json.loads(r[7]).get("id", json.loads(r[7]).get("tool_call_id")): r[4] for r in got if r[3] in ("call", "result") and r[4] != "duplicate" and r[3] == "call"}
    assert status == {"x": "ok", "y": "ok", "z": "invalid"}
    assert sum(r[4] == "duplicate" for r in got) == 1
    assert sum(r[4] == "malformed" for r in got) == 1
    assert [r[4] for r in got if r[3] == "result" and r[0] == 2] == ["orphan"]
    lines = [r[7] for r in got if r[0] == 1]
    at = lambda text: next(i for i, x in enumerate(lines) if text in x)
    assert at('"arguments":{"a":2,"b":1}') < at('"three"') < at('{"a":{"$result":"x"}}') < at('"tool_call_id":"y"')
    assert '{"content":[1,{"a":1,"b":2}],"role":"tool","tool_call_id":"y"}' in lines
    assert '{"content":"sum, please é","role":"user"}' in lines
    assert "below minimum" in lines[at('"errors"')] and "unknown" in lines[at('"errors"')]
    assert all(json.loads(x) is not None for x in lines)


def test_circles_missing_nulls_and_empty(spark):
    rows = [
        (1, 0, "assistant", call("a", "f", v={"$result": "b"}) + call("b", "f", v={"$result": "a"})),
        (1, 1, "assistant", call("c", "f", v={"$result": "nowhere"})),
        (None, None, None, None),
        (3, 0, "user", 'quote " and \\ and \n'),
        (3, 0, "user", 'quote " and \\ and \n'),
    ]
    chat_depth, chat.MAX_DEPTH = chat.MAX_DEPTH, 4
    try:
        got = run(spark, rows)
    finally:
        chat.MAX_DEPTH = chat_depth
    assert [r[4] for r in got if r[3] == "call"] == ["unresolved"] * 3
    assert [r[7] for r in got if r[0] is None] == ['{"content":"","role":""}']
    assert [json.loads(r[7])["content"] for r in got if r[0] == 3] == ['quote " and \\ and \n'] * 2
    assert run(spark, []) == []


def test_chains_of_any_length_are_no_circles(spark, monkeypatch):
    monkeypatch.setattr(chat, "MAX_DEPTH", 2)
    chain = [call("0", "f", v=1)] + [call(str(i), "f", v={"$result": str(i - 1)}) for i in range(1, 30)]
    rows = [(1, 0, "assistant", "".join(reversed(chain)))] + [(1, 1 + i, "tool", result(str(i), i)) for i in range(30)]
    rows += [(2, 0, "assistant", call("a", "f", v={"$result": "b"}) + call("b", "f", v={"$result": "a"}) + call("c", "f", v={"$result": "b"}) + call("d", "f", v=1) + call("e", "f", v={"$result": "d"}))]
    rows += [(3, 0, "assistant", call("y", "f", v={"$result": "x"}) + call("x", "f", v=1)), (None, 0, "assistant", "".join(chain))]
    got = run(spark, rows)
    calls = {(r[0], json.loads(r[7])["id"]): (r[4], r[6]) for r in got if r[3] == "call"}
    assert all(calls[1, str(i)] == ("ok", 2 * i) and calls[None, str(i)] == ("unanswered", 2 * i) for i in range(30))
    assert {i: calls[2, i][0] for i in "abcde"} == dict.fromkeys("abc", "unresolved") | dict.fromkeys("de", "unanswered")
    assert calls[3, "y"][1] == 2 and calls[2, "e"][1] == 2
    order = [json.loads(r[7]) for r in got if r[0] == 1 and r[3] in ("call", "result")]
    assert [x.get("id", x.get("tool_call_id")) for x in order] == [str(i) for i in range(30) for _ in range(2)]


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("<tool_call>" + "[" * 100_000 + "</tool_call>", "bad_call"),
        ('<tool_call>{"id": "x", "name": "f", "arguments": ' + "[" * 3000 + "]" * 3000 + "}</tool_call>", "bad_call"),
        ('<tool_call>{"id": "x", "name": "f", "arguments": "' + "[" * 3000 + '"}</tool_call>', "bad_call"),
        ('<tool_call>{"id": "x", "name": "\\ud800"}</tool_call>', "bad_call"),
        ('<tool_call>{"id": "\\udfff", "name": "f"}</tool_call>', "bad_call"),
        ('<tool_call>{"id": "x", "name": "f", "arguments": {"a": "\\ud800"}}</tool_call>', "call"),
        ('<tool_call>{"id": {"n": 1.0}, "name": "f", "arguments": 1e999}</tool_call>', "call"),
        ('<tool_call>{"id": "x", "name": "f", "arguments": ' + "9" * 5000 + "}</tool_call>", "bad_call"),
    ],
)
def test_no_input_crashes(spark, text, kind):
    rows = [(1, 0, "assistant", text), (1, 1, "tool", "[" * 100_000), (1, 2, "tool", '{"tool_call_id": "x", "content": "\\ud800"}'), (1, 3, "system", '{"tools": [5, {"name": "\\ud800"}, {"name": "g", "parameters": 5}]}')]
    got = run(spark, rows)
    assert [r[4] for r in got if r[3] == kind] == (["malformed"] if kind == "bad_call" else [next(r[4] for r in got if r[3] == "call")])
    assert sum(r[3] == "bad_tool" for r in got) == 2
    assert all(json.loads(r[7]) is not None for r in got)


@pytest.mark.parametrize("schema", [{"enum": 5}, {"minimum": "0"}, {"required": 5}, {"required": ["a", 1]}, {"properties": [1]}, {"type": {"a": 1}}, {"type": ["object", 3]}, {"items": 7}, {"type": "text"}, 5, {"properties": {"a": {"maximum": "z"}}}])
def test_malformed_schemas_are_reported(schema):
    assert chat.malformed_keywords(schema)


def test_schemas():
    ok = lambda value, schema: not chat.malformed_keywords(schema) and not chat.violations(value, schema)
    assert ok({"a": 1}, {"additionalProperties": {"type": "integer"}}) and not ok({"a": "x"}, {"additionalProperties": {"type": "integer"}})
    assert not ok(True, {"enum": [1]}) and ok(1.0, {"enum": [1]}) and ok([1, 2.0], {"items": {"type": "integer"}})
    assert not ok(True, {"type": "integer"}) and ok(None, {"type": ["null", "string"]}) and ok(5, True) and not ok(5, False)


def plain_links(rows):
    """What link_calls says of each call and result, one conversation after the other."""
    out = []
    for conv in {r[0] for r in rows}:
        parts = sorted((t, n, p) for c, t, role, text in rows if c == conv for n, p in ((n, tuple(sorted(p.items(), key=lambda x: x[0]))) for n, p in chat.parse(role, text)))
        parts = [(t, n, dict(p)) for t, n, p in parts]
        defined, first, answers = {}, {}, {}
        for t, n, p in parts:
            if p["kind"] == "call":
                first.setdefault(p["id"], (t, n, p))
            elif p["kind"] == "result":
                answers[p["id"]] = min(t, answers.get(p["id"], t))
        any_tool = any(p["kind"] == "tool" for _, _, p in parts)
        place, state = {}, {}

        def solve(i, first=first, answers=answers, place=place, state=state):
            """Turn and level of a call's answer; None in a circle or after one."""
            if state.get(i) == "open":
                return None
            if i not in state:
                state[i] = "open"
                t, _, p = first[i]
                cited = [solve(c) for c in p["cites"] if c in first]
                state[i] = "circle" if None in cited else "missing" if len(cited) < len(p["cites"]) else "ok"
                at, level = max([t, *(c[0] for c in cited if c)]), max([0, *(c[1] + 2 for c in cited if c)])
                place[i] = (max(at, answers.get(i, t)), level, at)
            return None if state[i] == "circle" else place[i][:2]

        for i in first:
            solve(i)
        for t, n, p in parts:
            if p["kind"] == "tool":
                defined[p["name"]] = p["value"]
            elif p["kind"] == "call":
                value, schema = json.loads(p["value"]), defined.get(p["name"])
                if first[p["id"]][:2] != (t, n):
                    status = "duplicate"
                elif state[p["id"]] != "ok":
                    status = "unresolved"
                elif schema is None and any_tool:
                    status = "undefined"
                elif schema is not None and chat.malformed_keywords(json.loads(schema)):
                    status = "bad_schema"
                elif schema is not None and chat.violations(value, json.loads(schema)):
                    status = "invalid"
                else:
                    status = "ok" if p["id"] in answers else "unanswered"
                out.append((conv, t, n, "call", status, None if status == "unresolved" else (place[p["id"]][2], place[p["id"]][1]) if status != "duplicate" else (t, 0)))
            elif p["kind"] == "result":
                known = p["id"] in first
                out.append((conv, t, n, "result", "ok" if known else "orphan", None if known and state[p["id"]] != "ok" else (max(t, place[p["id"]][2]), place[p["id"]][1] + 1) if known else (t, 0)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2, 1024])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rnd = random.Random(block)
    forms = [{"type": "object", "required": ["a"]}, {"properties": {"a": {"type": "integer"}}}, {"enum": 5}, {}]
    rows = []
    for conv in range(70):
        for turn in range(rnd.randint(1, 9)):
            kind = rnd.random()
            if kind < 0.25 and conv % 3:
                rows.append((conv, turn, "system", json.dumps({"tools": [{"name": rnd.choice("fg"), "parameters": rnd.choice(forms)} for _ in range(rnd.randint(1, 2))]})))
            elif kind < 0.7:
                rows.append((conv, turn, "assistant", "".join(call(rnd.choice("abcdef"), rnd.choice("fg"), **{rnd.choice("ab"): rnd.choice([1, "x", {"$result": rnd.choice("abcdefz")}])}) for _ in range(rnd.randint(1, 3)))))
            else:
                rows.append((conv, turn, "tool", json.dumps([{"tool_call_id": rnd.choice("abcdefy"), "content": turn}])))
    got = run(spark, rows)
    lost = {(r[0], json.loads(r[7])["id"]) for r in got if r[4] == "unresolved"}
    seen = []
    for r in got:
        if r[3] in ("call", "result"):
            line = json.loads(r[7])
            hidden = (r[0], line.get("id", line.get("tool_call_id"))) in lost and r[4] != "duplicate"
            seen.append((r[0], r[1], r[2], r[3], r[4], None if hidden else (r[5], r[6])))
    assert sorted(seen, key=repr) == plain_links(rows)
    assert {x[4] for x in seen} == {"ok", "duplicate", "unresolved", "undefined", "bad_schema", "invalid", "unanswered", "orphan"}


def test_repeated_rows_and_a_definition_after_the_call(spark):
    rows = [(1, 0, "assistant", call("x", "add", a="no"))] * 2 + [(1, 1, "system", TOOLS), (1, 2, "assistant", call("y", "add", a="no")), (1, 3, "assistant", call("z", "sub"))]
    status = {(json.loads(r[7])["id"], r[4]) for r in run(spark, rows) if r[3] == "call"}
    assert status == {("x", "undefined"), ("x", "duplicate"), ("y", "invalid"), ("z", "undefined")}


def test_the_query_links_a_table_of_calls(spark, tmp_path):
    from pliego.llm.queries import QUERIES

    rows = [(1, 0, "assistant", call("x", "f", a=1)), (1, 1, "tool", result("x", "long " * 400_000)), (2, 0, "user", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op7_chat_formatting"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.kind, r.status) for r in got) == [(1, "call", "ok"), (1, "message", "ok"), (1, "result", "ok"), (2, "message", "ok")]
    assert max(len(r.json) for r in got) > 2_000_000
