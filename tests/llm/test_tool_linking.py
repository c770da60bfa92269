import json

from millrace.llm.tool_linking import format_chat

TOOLS = {"tools": [
    {"name": "add", "parameters": {"type": "object", "required": ["a", "b"], "additionalProperties": False,
     "properties": {"a": {"type": "integer"}, "b": {"type": "number"}, "unit": {"type": "string", "enum": ["m", "s"]}}}},
    {"function": {"name": "say", "parameters": {"properties": {"x": {"type": "array"}, "y": {"type": "object"}}}}},
]}


def call(id, name, arguments, after=None):
    text = arguments if isinstance(arguments, str) else json.dumps(arguments)
    return {"id": id, "function": {"name": name, "arguments": text}, **({"after": after} if after else {})}


def chat(spark, *messages):
    rows = [(c, t, r, x if x is None or isinstance(x, str) else json.dumps(x)) for c, t, r, x in messages]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return sorted(format_chat(df).collect(), key=lambda r: (r.conv_id or -1, r.order_turn or -1, r.order_step, r.turn or -1, r.json))


def test_calls_results_and_checks(spark):
    calls = [
        call("c1", "add", {"b": 1.5, "a": 1, "unit": "m"}),
        call("c2", "add", {"a": "one", "unit": "km", "z": 0}),
        call("c3", "say", {"y": {"k": [1]}, "x": [2]}),
        call("c4", "say", "not json"),
        call("c5", "other", {}),
    ]
    got = chat(
        spark,
        (1, 0, "system", TOOLS), (1, 1, "user", 'Hi "you"\n'),
        (1, 2, "assistant", {"content": "wait", "tool_calls": calls}),
        (1, 3, "tool", {"tool_call_id": "c1", "content": "2.5"}),
        (1, 4, "tool", {"tool_call_id": "nobody", "content": "?"}),
        (2, 3, "tool", {"tool_call_id": "c2", "content": "of another conversation"}),
    )
    assert [r.turn for r in got] == [0, 1, 2, 3, 4, 3]
    assert got[1].json == '{"content":"Hi \\"you\\"\\n","role":"user"}'
    assert (got[2].n_calls, got[2].n_linked, got[2].n_invalid) == (5, 1, 3)
    assert [r.answers for r in got] == [None, None, None, True, False, False]
    written = json.loads(got[2].json)
    assert got[2].json == json.dumps(written, separators=(",", ":"), sort_keys=True)
    assert [c["errors"] for c in written["calls"]] == [
        [], ["enum unit", "missing b", "type a", "unknown z"], [], ["no object"], ["no such tool"]
    ]
    assert written["calls"][0]["arguments"] == {"a": 1, "b": 1.5, "unit": "m"}
    assert [c["linked"] for c in written["calls"]] == [True, False, False, False, False]


def test_order_of_late_calls_and_needs(spark):
    got = chat(
        spark,
        (1, 0, "tool", {"tool_call_id": "a", "content": "early"}),
        (1, 1, "user", "q"),
        (1, 2, "assistant", {"tool_calls": [call("b", "f", {}, after=["a"])]}),
        (1, 3, "assistant", {"tool_calls": [call("a", "f", {})]}),
        (1, 4, "tool", {"tool_call_id": "b", "content": "late"}),
    )
    assert [(r.turn, r.order_turn, r.order_step) for r in got] == [(1, 1, 0), (3, 3, 0), (0, 3, 1), (2, 3, 2), (4, 4, 0)]
    assert not any(r.cyclic for r in got)


def test_cycles_duplicates_and_edges(spark):
    got = chat(
        spark,
        (1, 0, "assistant", {"tool_calls": [call("a", "f", {}, after=["b"])]}),
        (1, 1, "tool", {"tool_call_id": "a"}),
        (1, 2, "assistant", {"tool_calls": [call("b", "f", {}, after=["a"])]}),
        (1, 3, "tool", {"tool_call_id": "b"}),
        (2, 0, "assistant", {"tool_calls": [call("a", "f", {}), call("a", "f", {}), call(None, "f", {})]}),
        (2, 1, "tool", {"tool_call_id": "a"}), (2, 2, "tool", {"tool_call_id": "a"}),
        (3, 0, "user", None), (None, None, None, None), (3, 1, "user", "{broken"), (3, 1, "user", "{broken"),
        (4, 0, "assistant", {"tool_calls": []}),
    )
    assert len(got) == 12
    one = {(r.conv_id, r.turn): r for r in got}
    assert all(one[1, t].cyclic and one[1, t].order_turn == t for t in range(4))
    assert (one[2, 0].n_calls, one[2, 0].n_linked) == (3, 1)
    assert (one[2, 1].answers, one[2, 2].answers) == (True, False)
    assert one[3, 0].json == '{"role":"user"}' and one[None, None].json == "{}"
    assert one[3, 1].json == '{"content":"{broken","role":"user"}'
    assert one[4, 0].json == '{"role":"assistant"}'


def test_nothing_that_is_said_is_lost(spark):
    calls = [
        {"type": "function", "id": "c1", "after": ["c0"], "linked": 1, "name": "other",
         "function": {"name": "add", "arguments": "{\"a\": 1,", "strict": True}},
        {"id": "c2", "name": "add", "arguments": {"b": 2, "a": [None]}},
    ]
    messages = [
        (1, 0, "system", {**TOOLS, "name": "x", "content": "c", "role": "me", "n": None}),
        (1, 1, "assistant", {"z": {"k": [1, {"b": 1, "a": None}]}, "tool_calls": calls, "calls": 3}),
        (1, 2, "tool", {"tool_call_id": "c1", "name": "add", 'is "error"': False}),
        (1, 3, "user", {"tool_calls": calls, "tools": []}),
        (1, 4, "assistant", '{"tools": [], "x": {"a": 1, "a": 2}}'),
    ]
    got = chat(spark, *messages)
    wrote = [json.loads(r.json) for r in got]
    assert all(r.json == json.dumps(w, separators=(",", ":"), sort_keys=True) for r, w in zip(got, wrote))
    assert wrote[0] == {**TOOLS, "name": "x", "content": "c", "role": "system", "_role": "me"}
    errors = ["missing b", "no object"]
    one, two = wrote[1].pop("calls")
    assert wrote[1] == {"_calls": 3, "role": "assistant", "z": {"k": [1, {"b": 1, "a": None}]}}
    assert one == {"after": ["c0"], "_linked": 1, "_name": "other", "arguments": "{\"a\": 1,", "errors": errors[1:],
                   "function": {"strict": True}, "id": "c1", "linked": True, "name": "add", "type": "function"}
    assert (two["arguments"], two["id"], two["name"]) == ({"a": [None], "b": 2}, "c2", "add")
    assert wrote[2] == {"tool_call_id": "c1", "name": "add", 'is "error"': False, "role": "tool"}
    assert wrote[3] == {"role": "user", "tool_calls": calls, "tools": []}
    assert wrote[4]["_text"] == messages[4][3]


def test_schemas_at_all_depths(spark):
    deep = {"type": "object", "properties": {
        "o": {"type": ["object", "null"], "required": ["k"], "additionalProperties": False,
              "properties": {"k": {"type": "integer", "minimum": 1, "exclusiveMaximum": 5}}},
        "l": {"type": "array", "maxItems": 2, "items": {"type": "object", "properties": {"s": {"type": "string", "minLength": 2}}}},
        "c": {"const": 1.0}, "e": {"enum": [1, "x", None]}, "f": False, "t": {"title": "any", "default": 3},
    }, "additionalProperties": {"type": "string"}}
    odd = {"properties": {"a": {"anyOf": [{"type": "string"}]}, "b": {"$ref": "#/x"}, "t": {"type": "text"}, "p": {"pattern": "^a"}}}
    tools = {"tools": [{"name": "deep", "parameters": deep}, {"name": "odd", "parameters": odd}, {"name": "free"}]}
    wanted = [
        ("deep", {"o": {"k": 4}, "l": [{"s": "ab"}, {}], "c": 1, "e": None, "t": [1], "more": "x"}, []),
        ("deep", {"o": None, "e": "x"}, []),
        ("deep", {"o": {"k": 5, "z": 1}}, ["exclusiveMaximum o.k", "unknown o.z"]),
        ("deep", {"o": {}, "l": [{"s": "a"}, 3, {"s": 1}]}, ["maxItems l", "minLength l[0].s", "missing o.k", "type l[1]", "type l[2].s"]),
        ("deep", {"o": {"k": 0.5}, "c": 2, "e": "1", "f": 0, "more": 1},
         ["const c", "enum e", "minimum o.k", "not allowed f", "type more", "type o.k"]),
        ("deep", {"o": "text"}, ["type o"]),
        ("odd", {}, []),
        ("odd", {"a": "x", "b": 1, "t": "x", "p": "b"}, ["unsupported $ref b", "unsupported anyOf a", "unsupported pattern p", "unsupported type t"]),
        ("free", {"any": {"thing": []}}, []),
    ]
    calls = [call(f"c{i}", name, args) for i, (name, args, _) in enumerate(wanted)]
    got = chat(spark, (1, 0, "system", tools), (1, 1, "assistant", {"tool_calls": calls}))
    assert [c["errors"] for c in json.loads(got[1].json)["calls"]] == [errors for _, _, errors in wanted]
    assert got[1].n_invalid == 5
