"""Chat formatting with tool-call linking.

Assistant turns may hold calls, ``<tool_call>{"id", "name", "arguments"}</tool_call>``; tool turns
hold results, ``{"tool_call_id", "content"}`` or a list of them; system turns may define tools,
``{"tools": [{"name", "parameters"}]}``. Calls and results are hash-joined by conversation and
identifier, calls and definitions by conversation and name; arguments are validated against the
definition's schema; messages, calls and results are put in topological order (a result after its call, a
call after the results that it cites as ``{"$result": id}``); and each becomes one line of
canonical JSON (sorted keys, no spaces, shortest numbers, UTF-8).

The order of a conversation is given as a sort key, not as a running number, so no task ever holds a
conversation. A call is validated against the definition that is in force where it stands: the last
one of its tool at or before it.

Status of a call, the first that holds: ``duplicate`` (an identifier's first call by turn is the one
that results and citations meet), ``unresolved`` (it cites what can't be met, or runs in a circle),
``undefined`` (its conversation defines tools, but not this one by then), ``bad_schema`` (the
definition's schema is malformed), ``invalid`` (its arguments break the schema), ``unanswered`` (no
result), ``ok``. Results without a call are ``orphan``. What can't be read as a call, result or
definition is ``malformed`` and kept as text: no JSON, nested deeper than ``MAX_NESTING``, or with an
identifier or name that is no Unicode text. Lone surrogates in values stay escaped in the output.

Nulls are empty contents and roles; repeated rows become repeated messages, of which calls are
duplicates; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pliego.llm.cluster import bounded_batches, saved

LINKING = ("call", "result", "tool")
CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
#: Rounds of the longest-path relaxation over all conversations; those with a longer chain or a
#: circle are solved each by itself, from the identifiers of its calls alone.
MAX_DEPTH = 64
#: Depth of JSON that is read. Deeper values would need more stack than a worker has.
MAX_NESTING = 200
#: Turns in a block of the two-level search for the definition in force.
BLOCK_TURNS = 1024
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    """Canonical JSON: sorted keys, no spaces; whole floats as integers; not-a-numbers as null; lone surrogates escaped."""

    def plain(v):
        if isinstance(v, float):
            return None if v != v or v in (float("inf"), float("-inf")) else int(v) if v.is_integer() and abs(v) < 1 << 53 else v
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode("utf-8", "backslashreplace").decode()


def _number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool)


def malformed_keywords(schema: object, at: str = "$") -> list[str]:
    """Where a schema of types, enums, bounds, required and further properties, and items is none."""
    if isinstance(schema, bool):
        return []
    if not isinstance(schema, dict):
        return [f"{at}: no schema"]
    kind = schema.get("type", [])
    wrong = [] if all(isinstance(k, str) and k in _TYPES for k in (kind if isinstance(kind, list) else [kind])) else ["type"]
    wrong += ["enum"] if not isinstance(schema.get("enum", []), list) else []
    wrong += [k for k in ("minimum", "maximum") if not _number(schema.get(k, 0))]
    required = schema.get("required", [])
    wrong += ["required"] if not (isinstance(required, list) and all(isinstance(x, str) for x in required)) else []
    properties = schema.get("properties", {})
    wrong += ["properties"] if not isinstance(properties, dict) else []
    out = [f"{at}: malformed {k}" for k in wrong]
    if isinstance(properties, dict):
        out += [x for k in sorted(properties) for x in malformed_keywords(properties[k], f"{at}.{k}")]
    further = schema.get("additionalProperties", True)
    return out + malformed_keywords(further, f"{at}.*") + (malformed_keywords(schema["items"], f"{at}[]") if "items" in schema else [])


def violations(value: object, schema: object, at: str = "$") -> list[str]:
    """Where value breaks a well-formed schema. A value that cites a result fits any."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    kind = schema.get("type")
    kinds = kind if isinstance(kind, list) else [kind] if kind else []
    fits = lambda k: isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number"))
    if kinds and not any(fits(k) or k == "integer" and isinstance(value, float) and value.is_integer() for k in kinds):
        return [f"{at}: not {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not in enum")
    if _number(value):
        out += [f"{at}: below minimum"] if "minimum" in schema and value < schema["minimum"] else []
        out += [f"{at}: above maximum"] if "maximum" in schema and value > schema["maximum"] else []
    if isinstance(value, dict):
        known, further = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif further is False:
                out.append(f"{at}.{k}: unknown")
            else:
                out += violations(value[k], further, f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        out += [x for i, v in enumerate(value) for x in violations(v, schema["items"], f"{at}[{i}]")]
    return out


def citations(value: object) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$result"}:
            return [_id(value["$result"])]
        return [x for v in value.values() for x in citations(v)]
    return [x for v in value for x in citations(v)] if isinstance(value, list) else []


def _id(value: object) -> str:
    """An identifier as text: a string as it stands, anything else as canonical JSON."""
    return value.encode("utf-8", "backslashreplace").decode() if isinstance(value, str) else canonical(value)


def _unicode(value: object) -> bool:
    return isinstance(value, str) and not any("\ud800" <= c <= "\udfff" for c in value)


def _shallow(value: object, left: int = MAX_NESTING) -> bool:
    level = [value]
    while level and left:
        level = [x for v in level if isinstance(v, dict | list) for x in (v.values() if isinstance(v, dict) else v)]
        left -= 1
    return not level


def _load(text: str) -> object:
    """The JSON value of a text; None where it is none or nested too deeply."""
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if _shallow(value) else None


def _part(kind: str, value: str, name: str | None = None, id: str | None = None, cites: list[str] | None = None) -> dict:
    return {"kind": kind, "id": id, "name": name, "value": value, "cites": cites or []}


def _call(text: str) -> dict:
    call = _load(text)
    if isinstance(call, dict) and _unicode(call.get("name")) and call.get("id") is not None and (_unicode(call["id"]) or not isinstance(call["id"], str)):
        arguments = call.get("arguments", {})
        if isinstance(arguments, str):
            arguments, given = _load(arguments), arguments
            if arguments is None and given.strip() != "null":
                return _part("bad_call", canonical(text.strip()))
        return _part("call", canonical(arguments), call["name"], _id(call["id"]), sorted(set(citations(arguments))))
    return _part("bad_call", canonical(text.strip()))


def parse(role: str | None, text: str | None, linking: bool | None = None) -> list[tuple[int, dict]]:
    """The numbered parts of one turn: its message, and its calls, results or tool definitions.

    linking: only those that link (calls, results, definitions), or only the others; None: all.
    """
    role, text = role or "", text or ""
    parts, content = [], text
    if role == "assistant" and "<tool_call>" in text:
        parts = [_call(m[1]) for m in CALL.finditer(text)]
        content = CALL.sub("", text).strip()
    elif role == "tool":
        found = _load(text)
        results = found if isinstance(found, list) else [found]
        if results and all(isinstance(r, dict) and r.get("tool_call_id") is not None for r in results):
            parts, content = [_part("result", canonical(r.get("content")), id=_id(r["tool_call_id"])) for r in results], None
    elif role == "system" and '"tools"' in text and isinstance(found := _load(text), dict) and isinstance(found.get("tools"), list):
        for tool in found["tools"]:
            ok = isinstance(tool, dict) and _unicode(tool.get("name"))
            parts.append(_part("tool", canonical(tool.get("parameters", {})), tool["name"]) if ok else _part("bad_tool", canonical(tool)))
    every = enumerate(parts if content is None else [_part("message", canonical(content), role), *parts])
    return [(n, p) for n, p in every if linking is None or linking == (p["kind"] in LINKING)]


def peel(table: pa.Table) -> pa.Table:
    """Time and level of the calls of one conversation, each after all that it cites; circular: in a circle or after one."""
    ids, at, done, cites = (table[c].to_pylist() for c in ("l_id", "at", "done", "cites"))
    index = {x: i for i, x in enumerate(ids)}
    users: list[list[int]] = [[] for _ in ids]
    left, level = [0] * len(ids), [0] * len(ids)
    for i, cited in enumerate(cites):
        for c in {index[c] for c in cited or () if c in index}:
            users[c].append(i)
            left[i] += 1
    ready = [i for i, n in enumerate(left) if not n]
    for i in ready:
        for u in users[i]:
            at[u] = max((x for x in (at[u], at[i], done[i]) if x is not None), default=None)
            level[u] = max(level[u], level[i] + 2)
            left[u] -= 1
            if not left[u]:
                ready.append(u)
    kinds = {c: table.schema.field(c).type for c in ("at", "done")}
    return pa.table({"l_conv": table["l_conv"], "l_id": table["l_id"], "at": pa.array(at, kinds["at"]), "done": pa.array(done, kinds["done"]), "level": pa.array(level, pa.int32()), "circular": pa.array([n > 0 for n in left], pa.bool_())})


def in_force(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """calls with schema, that of the last definition of the call's tool at or before it (null: none).

    The search has two levels, blocks of turns and turns inside a block, so that a conversation with
    many calls of one tool is spread over tasks.
    """
    block = F.floor(F.col("turn").cast("double") / BLOCK_TURNS)
    both = calls.withColumn("schema", F.lit(None).cast("string")).unionByName(tools.withColumn("schema", F.col("value"))).withColumn("block", block)
    key = ("conv", "name")
    blocks = both.groupBy(*key, "block").agg(F.max_by("schema", F.when(F.col("kind") == "tool", F.struct("turn", "part"))).alias("last"))
    before = F.last("last", True).over(Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", before).select(*(F.col(c).alias(f"b_{c}") for c in (*key, "block")), "before")
    # A definition in the call's own turn counts if it stands before it.
    inside = F.last("schema", True).over(Window.partitionBy(*key, "block").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = lambda c: F.col(c).eqNullSafe(F.col(f"b_{c}"))
    found = both.withColumn("schema", inside).filter("kind = 'call'").join(blocks, same("conv") & same("name") & same("block"))
    return found.withColumn("schema", F.coalesce("schema", "before")).select(*calls.columns, "schema")


def link_calls(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, part, kind, status, order_turn, order_level and json of every part of every turn; sort by (conv, order_turn, order_level, turn, part)."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    types = {c: rows.schema[c].dataType.simpleString() for c in ("conv", "turn")}

    def split(linking: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(i, n, p) for i, (r, t) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)) for n, p in parse(r, t, linking)]
                at = pa.array([i for i, _, _ in found], pa.int64())
                yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array([n for _, n, _ in found], pa.int32()), *(pa.array([p[k] for _, _, p in found], pa.string()) for k in ("kind", "id", "name", "value")), pa.array([p["cites"] for _, _, p in found], pa.list_(pa.string()))], names=["conv", "turn", "part", "kind", "id", "name", "value", "cites"])

        return run

    schema = f"conv {types['conv']}, turn {types['turn']}, part int, kind string, id string, name string, value string, cites array<string>"
    may_link = F.coalesce((F.col("role") == "tool") | (F.col("role") == "assistant") & F.contains("text", F.lit("<tool_call>")) | (F.col("role") == "system") & F.contains("text", F.lit('"tools"')), F.lit(False))
    linking = saved(rows.filter(may_link).mapInArrow(split(True), schema))
    quoted = lambda c: F.to_json(F.struct(F.col(c).alias("r"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("r")))) - 6)
    text_of = F.when(F.col("kind") == "message", F.concat(F.lit('{"content":'), "value", F.lit(',"role":'), quoted("name"), F.lit("}"))).otherwise(F.concat(F.lit('{"malformed":'), "value", F.lit("}")))
    plain = rows.mapInArrow(split(False), schema).select("conv", "turn", "part", "kind", F.when(F.col("kind") == "message", "ok").otherwise("malformed").alias("status"), F.col("turn").alias("order_turn"), F.lit(0).alias("order_level"), text_of.alias("json"))

    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    calls = linking.filter("kind = 'call'")
    place = F.struct("turn", "part")
    firsts = calls.groupBy(F.col("conv").alias("f_conv"), F.col("id").alias("f_id")).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    tools = linking.filter("kind = 'tool'")
    defining = tools.select(F.col("conv").alias("t_conv"), F.lit(True).alias("defines")).distinct()
    answers = linking.filter("kind = 'result'").groupBy(F.col("conv").alias("a_conv"), F.col("id").alias("a_id")).agg(F.min("turn").alias("answer_turn"))
    calls = (
        in_force(calls, tools)
        .join(firsts, same("conv", "f_conv") & same("id", "f_id"))
        .join(defining, same("conv", "t_conv"), "left")
        .join(answers, same("conv", "a_conv") & same("id", "a_id"), "left")
        .withColumn("is_first", F.col("first").eqNullSafe(place) & (F.row_number().over(Window.partitionBy("conv", "id", "turn", "part").orderBy("name", "value")) == 1))
    )
    calls = saved(calls.select("conv", "turn", "part", "id", "name", "value", "cites", "schema", (F.col("schema").isNull() & F.col("defines").isNotNull()).alias("undefined"), "is_first", F.col("a_id").isNotNull().alias("answered"), F.coalesce("answer_turn", "turn").alias("done")))

    # Longest paths over citations, one step of every chain a round; most corpora need none.
    edges = saved(calls.filter("is_first").select(F.col("conv").alias("e_conv"), F.col("id").alias("e_id"), F.explode("cites").alias("cited")))
    level = saved(calls.filter("is_first").groupBy(F.col("conv").alias("l_conv"), F.col("id").alias("l_id")).agg(F.min("turn").alias("at"), F.min("done").alias("done"), F.min(F.lit(0)).alias("level")))
    unresolved = None
    if not edges.isEmpty():
        target = level.select(F.col("l_conv").alias("g_conv"), F.col("l_id").alias("g_id"))
        missing = edges.join(target, same("e_conv", "g_conv") & same("cited", "g_id"), "left_anti").select("e_conv", "e_id").distinct()
        start = level
        for _ in range(MAX_DEPTH + 1):
            cited = level.select(F.col("l_conv").alias("c_conv"), F.col("l_id").alias("c_id"), F.greatest("at", "done").alias("c_at"), F.col("level").alias("c_level"))
            need = edges.join(cited, same("e_conv", "c_conv") & same("cited", "c_id")).groupBy("e_conv", "e_id").agg(F.max("c_at").alias("n_at"), F.max("c_level").alias("n_level"))
            step = level.join(need, same("l_conv", "e_conv") & same("l_id", "e_id"), "left").select("l_conv", "l_id", F.greatest("at", F.coalesce("n_at", "at")).alias("at"), "done", F.greatest("level", F.coalesce(F.col("n_level") + 2, F.lit(0))).alias("level"), (F.coalesce(F.col("n_level") + 2, F.lit(0)) > F.col("level")).alias("moved"))
            step = saved(step)
            level = step.select("l_conv", "l_id", "at", "done", "level")
            if step.filter("moved").isEmpty():
                break
        else:
            deep = saved(step.filter("moved").select(F.col("l_conv").alias("d_conv")).distinct())
            cited = edges.groupBy("e_conv", "e_id").agg(F.collect_set("cited").alias("cites"))
            graph = start.join(deep, same("l_conv", "d_conv"), "left_semi").join(cited, same("l_conv", "e_conv") & same("l_id", "e_id"), "left").select("l_conv", "l_id", "at", "done", "cites")
            solved = saved(graph.groupBy("l_conv").applyInArrow(peel, f"l_conv {types['conv']}, l_id string, at {types['turn']}, done {types['turn']}, level int, circular boolean"))
            level = level.join(deep, same("l_conv", "d_conv"), "left_anti").unionByName(solved.drop("circular"))
            missing = missing.unionByName(solved.filter("circular").select(F.col("l_conv").alias("e_conv"), F.col("l_id").alias("e_id")))
        unresolved = missing
        unresolved = unresolved.groupBy(F.col("e_conv").alias("u_conv"), F.col("e_id").alias("u_id")).agg(F.lit(True).alias("unresolved"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states, lines = [], []
            for v, i, n, s, undefined in zip(*(batch.column(c).to_pylist() for c in ("value", "id", "name", "schema", "undefined")), strict=True):
                value, form = json.loads(v), json.loads(s or "{}")
                wrong = malformed_keywords(form)
                states.append("undefined" if undefined else "bad_schema" if wrong else "")
                wrong = wrong or violations(value, form)
                states[-1] = states[-1] or ("invalid" if wrong else "ok")
                lines.append(canonical({"arguments": value, "id": i, "name": n, "type": "tool_call"} | ({"errors": "; ".join(wrong)} if wrong else {})))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "turn", "part", "id", "is_first", "answered")), pa.array(states, pa.string()), pa.array(lines, pa.string())], names=["conv", "turn", "part", "id", "is_first", "answered", "state", "json"])

    checked = calls.mapInArrow(check, f"conv {types['conv']}, turn {types['turn']}, part int, id string, is_first boolean, answered boolean, state string, json string")
    checked = checked.join(level, same("conv", "l_conv") & same("id", "l_id"), "left")
    if unresolved is not None:
        checked = checked.join(unresolved, same("conv", "u_conv") & same("id", "u_id"), "left")
    else:
        checked = checked.withColumn("unresolved", F.lit(False))
    status = F.when(~F.col("is_first"), "duplicate").when(F.coalesce("unresolved", F.lit(False)), "unresolved").when(F.col("state") != "ok", F.col("state")).when(~F.col("answered"), "unanswered").otherwise("ok")
    order = F.when(F.col("is_first"), F.greatest("turn", F.coalesce("at", "turn"))).otherwise(F.col("turn"))
    call_rows = checked.select("conv", "turn", "part", F.lit("call").alias("kind"), status.alias("status"), order.alias("order_turn"), F.when(F.col("is_first"), F.coalesce("level", F.lit(0))).otherwise(0).alias("order_level"), "json")
    results = linking.filter("kind = 'result'").join(level, same("conv", "l_conv") & same("id", "l_id"), "left")
    result_rows = results.select("conv", "turn", "part", F.lit("result").alias("kind"), F.when(F.col("l_id").isNull(), "orphan").otherwise("ok").alias("status"), F.greatest("turn", F.coalesce("at", "turn")).alias("order_turn"), (F.coalesce("level", F.lit(-1)) + 1).alias("order_level"), F.concat(F.lit('{"content":'), "value", F.lit(',"role":"tool","tool_call_id":'), quoted("id"), F.lit("}")).alias("json"))
    tool_rows = linking.filter("kind = 'tool'").select("conv", "turn", "part", "kind", F.lit("ok").alias("status"), F.col("turn").alias("order_turn"), F.lit(0).alias("order_level"), F.concat(F.lit('{"name":'), quoted("name"), F.lit(',"parameters":'), "value", F.lit("}")).alias("json"))
    every = plain.unionByName(call_rows).unionByName(result_rows).unionByName(tool_rows)
    return every.withColumnsRenamed({"conv": conv, "turn": turn}) if (conv, turn) != ("conv", "turn") else every
