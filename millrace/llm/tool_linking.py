"""Chat formatting: tool calls are linked with their results, ordered, checked, and written as JSON.

DataFrame functions only. Messages are rows (conv_id, turn, role, text). A text that is a JSON object
may hold `content`, and:

- of any role, `tools`: [{"name", "parameters"}], the schemas of the conversation's tools;
- of an assistant, `tool_calls`: [{"id", "name", "arguments", "after"}], or the same with name and
  arguments inside "function"; `after` lists ids of calls whose results the call needs;
- of a tool, `tool_call_id`: the call that its content answers.

Any other text is the message's content as it stands.

1. Calls and results of a conversation are joined by the call's identifier. Of several calls with one
   id, and of several results of one call, the first by turn and place is the one that counts.
2. Messages are ordered topologically: a result follows its call, and a call the results it needs.
   A message keeps its turn unless it must move behind another; (order_turn, order_step) sorts a
   conversation. Messages on a cycle keep their turn and are marked.
3. Arguments are an object that is checked against their tool's schema at all depths, in rounds, one for
   each level: the keywords in `KEYWORDS`. Keywords that only describe (`NOTES`) say nothing; any other, as
   anyOf, $ref or pattern, is an error "unsupported", so that no call passes for what was not looked at.
4. A message is written as canonical JSON: sorted keys, no spaces, no NULLs beside them. All else that it
   says is written too: tools, `after`, and further keys of messages, calls and their functions, those with
   an underscore before that share a name with one of ours. Arguments that are no JSON are a string. A text
   with a repeated key within is also written whole, as `_text`.

The result has a row for each message, so no conversation is gathered in one task, however long. A
NULL conversation or id links nothing. NULL text has no content. Repeated rows are answered alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

MESSAGE = (
    "content STRING, tool_call_id STRING, "
    "tools ARRAY<STRUCT<name: STRING, parameters: STRING, function: STRUCT<name: STRING, parameters: STRING>>>, "
    "tool_calls ARRAY<STRUCT<id: STRING, name: STRING, arguments: STRING, after: ARRAY<STRING>, "
    "function: STRUCT<name: STRING, arguments: STRING>>>"
)
TYPES = ["string", "integer", "number", "boolean", "object", "array", "null"]
SIZES = [
    ("minLength", "maxLength", lambda v: F.length(F.try_variant_get(v, "$", "string")), "STRING"),
    ("minItems", "maxItems", lambda v: F.size(F.try_variant_get(v, "$", "array<variant>")), "ARRAY"),
    ("minProperties", "maxProperties", lambda v: F.size(F.try_variant_get(v, "$", ENTRIES)), "OBJECT"),
]
BOUNDS = [
    ("minimum", lambda a, b: a < b), ("maximum", lambda a, b: a > b),
    ("exclusiveMinimum", lambda a, b: a <= b), ("exclusiveMaximum", lambda a, b: a >= b),
]
KEYWORDS = ["type", "enum", "const", "required", "properties", "additionalProperties", "items"]
KEYWORDS += [k for k, _ in BOUNDS] + [k for low, high, _, _ in SIZES for k in (low, high)]
NOTES = [
    "$comment", "$defs", "$id", "$schema", "default", "definitions", "deprecated", "description", "example",
    "examples", "format", "readOnly", "strict", "title", "writeOnly",
]
CALL = ["conv_id", "id"]
ENTRIES = "map<string,variant>"


def parse(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, said): `said` is NULL for a text that is no object with tool fields."""
    is_object = F.col("text").rlike(r"^\s*\{")
    said = F.when(is_object, F.from_json("text", MESSAGE))
    rows = messages.select("conv_id", "turn", "role", "text", F.explode(F.array(said)).alias("said"))
    fields = [F.col(f"said.{c}").isNotNull() for c in ("tool_calls", "tools", "tool_call_id")]
    speaks = fields[0] | fields[1] | fields[2]
    return rows.withColumn("said", F.when(speaks, F.col("said")))


def calls_of(tool_messages: DataFrame) -> DataFrame:
    """(mid, conv_id, turn, nth, id, name, arguments, after, more): one row per call.

    `more` are its other keys as (key, json).
    """
    raw = F.from_json("text", "tool_calls array<map<string,variant>>")["tool_calls"]
    calls = F.posexplode(F.arrays_zip(F.col("said.tool_calls").alias("call"), raw.alias("raw"))).alias("nth", "_")
    rows = tool_messages.where("role = 'assistant'").select("mid", "conv_id", "turn", calls)
    rows = rows.select("mid", "conv_id", "turn", "nth", "_.call", "_.raw")
    function = F.try_variant_get(F.try_element_at("raw", F.lit("function")), "$", ENTRIES)
    rest = F.map_filter(function, lambda k, v: ~k.isin("name", "arguments"))
    spare = [F.lit("id"), F.lit("function")]
    spare += [F.when(F.col(f"call.function.{k}").isNull(), k) for k in ("name", "arguments")]
    more = _others(F.col("raw"), spare, ["arguments", "errors", "linked", "name"])
    rest = F.when(F.size(rest) > 0, F.array(F.struct(F.lit("function").alias("key"), F.to_json(rest).alias("json"))))
    return rows.select(
        "mid", "conv_id", "turn", "nth", F.col("call.id").alias("id"),
        F.coalesce("call.function.name", "call.name").alias("name"),
        F.coalesce("call.function.arguments", "call.arguments").alias("arguments"),
        F.col("call.after").alias("after"),
        F.concat(more, F.coalesce(rest, _none())).alias("more"),
    )


def _others(entries: Column, without: list[Column], ours: list[str]) -> Column:
    """(key, json) of the entries but those named in `without` and NULLs; `_` is put before `ours`."""
    kept = F.filter(F.map_entries(entries), lambda e: ~F.array_contains(F.array_compact(F.array(*without)), e["key"]))
    kept = F.filter(kept, lambda e: ~F.is_variant_null(e["value"]))
    key = lambda e: F.when(e["key"].isin(ours), F.concat(F.lit("_"), e["key"])).otherwise(e["key"])
    return F.coalesce(F.transform(kept, lambda e: F.struct(key(e).alias("key"), F.to_json(e["value"]).alias("json"))), _none())


def _none() -> Column:
    return F.from_json(F.lit("[]"), "array<struct<key: string, json: string>>")


def _quoted(text: Column) -> Column:
    """The text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substr(whole, F.lit(6), F.length(whole) - 6))


def _object(more: Column, **ours: Column) -> Column:
    """An object of the entries `more` and of `ours`, values being JSON; those that are NULL are left out."""
    own = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("json")) for k, v in ours.items()])
    entries = F.array_sort(F.filter(F.concat(more, own), lambda e: e["json"].isNotNull()))
    written = F.transform(entries, lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["json"]))
    return F.concat(F.lit("{"), F.array_join(written, ","), F.lit("}"))


def link(tool_messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with `linked`, `duplicate` and the result's `result_mid`; results with `call_mid`."""
    calls = calls_of(tool_messages)
    first = calls.groupBy(*CALL).agg(F.min(F.struct("turn", "nth", "mid")).alias("first"))
    answers = tool_messages.where("role = 'tool' AND said.tool_call_id IS NOT NULL").select(
        "mid", "conv_id", "turn", F.col("said.tool_call_id").alias("id")
    )
    answer = answers.groupBy(*CALL).agg(F.min(F.struct("turn", "mid")).alias("answer"))
    firsts = stage(first.join(answer, CALL, "left").where("id IS NOT NULL AND conv_id IS NOT NULL"))
    is_first = F.struct("turn", "nth", "mid") == F.col("first")
    calls = calls.join(firsts, CALL, "left")
    calls = calls.withColumn("duplicate", F.coalesce(~is_first, F.lit(False)))
    counts = F.col("first").isNotNull() & ~F.col("duplicate")
    calls = calls.withColumn("result_mid", F.when(counts, F.col("answer.mid")))
    calls = calls.withColumn("linked", F.col("result_mid").isNotNull()).drop("first", "answer")
    results = answers.join(firsts, CALL, "left").select(
        "mid", F.when(F.col("answer.mid") == F.col("mid"), F.col("first.mid")).alias("call_mid")
    )
    return calls, results


def schemas_of(tool_messages: DataFrame) -> DataFrame:
    """(conv_id, name, schema): a conversation's tools; the last one of a name counts."""
    rows = tool_messages.where("said.tools IS NOT NULL").select(
        "conv_id", "turn", F.posexplode("said.tools").alias("nth", "tool")
    )
    name = F.coalesce("tool.function.name", "tool.name").alias("name")
    parameters = F.coalesce("tool.function.parameters", "tool.parameters").alias("parameters")
    rows = rows.select("conv_id", name, F.struct("turn", "nth", parameters).alias("one"))
    last = rows.groupBy("conv_id", "name").agg(F.max("one").alias("one"))
    return last.select("conv_id", "name", F.col("one.parameters").alias("schema"))


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _is_type(value: Column, wanted: Column) -> Column:
    """Whether a variant is of a JSON schema's type."""
    kind = F.schema_of_variant(value)
    whole = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    return (
        F.when(wanted == "string", kind == "STRING")
        .when(wanted == "integer", whole)
        .when(wanted == "number", whole | kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"))
        .when(wanted == "boolean", kind == "BOOLEAN")
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "array", kind.startswith("ARRAY"))
        .when(wanted == "null", kind == "VOID")
        .otherwise(F.lit(False))
    )


def _is_number(value: Column) -> Column:
    return _kind(value).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _text(value: Column) -> Column:
    """Equal texts for equal values: numbers without trailing zeros."""
    number = F.try_variant_get(value, "$", "decimal(38,18)").cast("string")
    return F.when(_is_number(value), F.coalesce(number, F.to_json(value))).otherwise(F.to_json(value))


def _beyond(value: Column, bound: Column, is_beyond) -> Column:
    both = [[F.try_variant_get(x, "$", kind) for x in (value, bound)] for kind in ("decimal(38,18)", "double")]
    return _is_number(value) & F.coalesce(*[is_beyond(*pair) for pair in both])


def _look(level: DataFrame) -> tuple[Column, Column]:
    """Errors of a level's rows (path, value, rule, rules, parts), and (path, value, rule) of what is inside."""
    value, path = F.col("value"), F.col("path")
    shown = F.when(path == "", F.lit("$")).otherwise(path)
    texts = "array<string>"

    def rule(key: str) -> Column:
        return F.try_element_at("rules", F.lit(key))

    def inside(key: Column) -> Column:
        return F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))

    def said(word: str, condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.array(F.concat(F.lit(word + " "), shown)))

    def all_said(word: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.concat(F.lit(word + " "), inside(k)))

    def is_schema(v: Column) -> Column:
        return _kind(v).isin("OBJECT", "BOOLEAN")

    kind = _kind(value)
    wanted = F.when(_kind(rule("type")) == "STRING", F.array(F.try_variant_get(rule("type"), "$", "string")))
    wanted = F.when(_kind(rule("type")) == "ARRAY", F.try_variant_get(rule("type"), "$", texts)).otherwise(wanted)
    no_type = rule("type").isNotNull() & ~F.coalesce(F.forall(wanted, lambda w: F.coalesce(w.isin(*TYPES), F.lit(False))), F.lit(False))
    listed = F.try_variant_get(rule("enum"), "$", "array<variant>")
    required = F.try_variant_get(rule("required"), "$", texts)
    properties = F.try_variant_get(rule("properties"), "$", ENTRIES)
    named = F.coalesce(F.map_keys(properties), F.array().cast(texts))
    others = F.filter(F.map_keys("parts"), lambda k: ~F.array_contains(named, k))
    rest, items = rule("additionalProperties"), rule("items")
    elements = F.when(kind == "ARRAY", F.try_variant_get(value, "$", "array<variant>"))
    none = F.to_json(rest) == "false"
    malformed = [
        ("enum", listed), ("required", required), ("properties", properties), ("additionalProperties", F.when(is_schema(rest), True)),
        ("items", F.when(is_schema(items), True)),
        *[(k, F.when(_is_number(rule(k)), True)) for k in KEYWORDS if k.startswith(("min", "max", "exclusive"))],
    ]
    strange = F.filter(F.map_keys("rules"), lambda k: ~k.isin(*KEYWORDS, *NOTES))
    strange = F.concat(
        strange, F.array_compact(F.array(
            F.when(no_type, F.lit("type")), *[F.when(rule(k).isNotNull() & read.isNull(), F.lit(k)) for k, read in malformed]
        ))
    )
    errors = [
        said("type", ~no_type & ~F.exists(wanted, lambda w: _is_type(value, w))),
        said("enum", ~F.exists(listed, lambda x: _text(x) == _text(value))),
        said("const", _text(rule("const")) != _text(value)),
        *[said(k, _beyond(value, rule(k), is_beyond)) for k, is_beyond in BOUNDS],
        *[said(k, (kind == of) & is_beyond(size(value), F.try_variant_get(rule(k), "$", "double")))
          for low, high, size, of in SIZES for k, is_beyond in ((low, lambda a, b: a < b), (high, lambda a, b: a > b))],
        F.when(kind == "OBJECT", all_said("missing", F.array_except(required, F.map_keys("parts")))),
        F.when(none, all_said("unknown", others)),
        said("not allowed", F.to_json("rule") == "false"),
        said("unsupported schema", ~is_schema(F.col("rule"))),
        F.transform(strange, lambda k: F.concat(F.lit("unsupported "), k, F.lit(" "), shown)),
    ]
    row = lambda path, value, rule: F.struct(path.alias("path"), value.alias("value"), rule.alias("rule"))
    deeper = [
        F.transform(
            F.filter(F.map_keys("parts"), lambda k: F.array_contains(named, k)),
            lambda k: row(inside(k), F.try_element_at("parts", k), F.try_element_at(properties, k)),
        ),
        F.when(_kind(rest) == "OBJECT", F.transform(others, lambda k: row(inside(k), F.try_element_at("parts", k), rest))),
        F.when(is_schema(items), F.transform(
            elements, lambda x, i: row(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), x, items)
        )),
    ]
    return _joined(errors), _joined(deeper)


def _joined(lists: list[Column]) -> Column:
    return F.flatten(F.array_compact(F.array(*lists)))


def check_arguments(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` with `errors`, a sorted array of texts; a call of an unknown tool has one error."""
    args = F.try_parse_json("arguments")
    rows = stage(calls.join(schemas.withColumn("known", F.lit(True)), ["conv_id", "name"], "left"))
    is_object = F.coalesce(_kind(args) == "OBJECT", F.lit(False))
    asked = rows.where(F.col("known") & is_object & F.col("schema").isNotNull())
    rule = F.coalesce(F.try_parse_json("schema"), F.parse_json(F.lit('"no JSON"')))
    level = asked.select("mid", "nth", F.lit("").alias("path"), args.alias("value"), rule.alias("rule"))
    found = []
    while not found or level.limit(1).count():
        read = level.withColumns({
            "rules": F.try_variant_get("rule", "$", ENTRIES),
            "parts": F.when(_kind(F.col("value")) == "OBJECT", F.try_variant_get("value", "$", ENTRIES)),
        })
        errors, deeper = _look(read)
        looked = stage(read.select("mid", "nth", errors.alias("errors"), F.transform(deeper, lambda d: F.struct(
            d["path"].alias("path"), F.to_json(d["value"]).alias("value"), F.to_json(d["rule"]).alias("rule")
        )).alias("deeper")))
        found.append(looked.select("mid", "nth", F.explode("errors").alias("error")))
        level = looked.select("mid", "nth", F.explode("deeper").alias("d")).select(
            "mid", "nth", "d.path", F.parse_json("d.value").alias("value"), F.parse_json("d.rule").alias("rule")
        )
    wrong = _union(found).groupBy("mid", "nth").agg(F.array_sort(F.collect_list("error")).alias("wrong"))
    errors = (
        F.when(F.col("known").isNull(), F.array(F.lit("no such tool")))
        .when(~is_object, F.array(F.lit("no object")))
        .otherwise(F.coalesce("wrong", F.array().cast("array<string>")))
    )
    return rows.join(wrong, ["mid", "nth"], "left").withColumn("errors", errors).drop("schema", "known", "wrong")


def order(tool_messages: DataFrame, calls: DataFrame, results: DataFrame) -> DataFrame:
    """(mid, order_turn, order_step, cyclic) of the messages that depend on others or are depended on.

    Messages are settled in rounds, those first that wait for nothing: a round for each step of the
    longest chain. No message comes to the driver.
    """
    needs = calls.select("mid", "conv_id", F.explode("after").alias("id"))
    met = needs.join(calls.where("linked").select(*CALL, "result_mid"), CALL).select("mid", F.col("result_mid").alias("on"))
    edges = results.where("call_mid IS NOT NULL").select("mid", F.col("call_mid").alias("on")).union(met)
    edges = stage(edges.distinct())
    nodes = edges.select("mid").union(edges.select("on")).distinct()
    nodes = stage(nodes.join(tool_messages.select("mid", "turn"), "mid"))
    place = F.struct(F.col("turn").alias("turn"), F.lit(0).alias("step")).alias("place")
    waiting = edges.select("mid").distinct()
    settled = [stage(nodes.join(waiting, "mid", "left_anti").select("mid", place))]
    while settled[-1].limit(1).count():
        done = stage(_union(settled))
        behind = F.struct(F.col("place.turn").alias("turn"), (F.col("place.step") + 1).alias("step"))
        left = edges.join(done.select("mid"), "mid", "left_anti")
        seen = left.join(done.toDF("on", "place"), "on", "left").groupBy("mid").agg(
            F.bool_and(F.col("place").isNotNull()).alias("all"), F.max(behind).alias("behind")
        )
        free = nodes.join(seen.where("all"), "mid")
        settled.append(stage(free.select("mid", F.greatest(place, F.col("behind")).alias("place"))))
    ordered = nodes.join(_union(settled), "mid", "left")
    return ordered.select(
        "mid",
        F.coalesce("place.turn", "turn").alias("order_turn"),
        F.coalesce("place.step", F.lit(0)).alias("order_step"),
        F.col("place").isNull().alias("cyclic"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def format_chat(messages: DataFrame) -> DataFrame:
    """A row for each message, in whatever order rows come; (order_turn, order_step) sorts them.

    (conv_id, turn, role, order_turn, order_step, n_calls, n_linked, n_invalid, answers, cyclic, json):
    `answers` is whether a tool's message answers a call, NULL for other messages.
    """
    rows = parse(messages)
    tools = rows.where("said IS NOT NULL").distinct().withColumn("mid", F.monotonically_increasing_id())
    tools = stage(tools)
    calls, results = link(tools)
    checked = stage(check_arguments(calls, schemas_of(tools)))
    results = stage(results)
    call = _object(
        F.col("more"),
        arguments=F.coalesce(F.to_json(F.try_parse_json("arguments")), _quoted(F.col("arguments"))),
        errors=F.to_json(F.array_sort("errors")), id=_quoted(F.col("id")),
        linked=F.col("linked").cast("string"),
        name=_quoted(F.col("name")),
    )
    listed = checked.groupBy("mid").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("nth", call.alias("json")))), lambda c: c["json"]).alias("calls"),
        F.count_if("linked").alias("n_linked"),
        F.count_if(F.size("errors") > 0).alias("n_invalid"),
    )
    known = tools.join(listed, "mid", "left").join(results, "mid", "left").join(order(tools, checked, results), "mid", "left")
    entries = F.from_json("text", ENTRIES)
    spare = [F.lit("content"), F.lit("tool_call_id"), F.when((F.col("role") == "assistant"), F.lit("tool_calls"))]
    written = _object(
        _others(entries, spare, ["calls", "role", "_text"]),
        content=_quoted(F.col("said.content")), role=_quoted(F.col("role")),
        tool_call_id=_quoted(F.col("said.tool_call_id")),
        calls=F.when(F.size("calls") > 0, F.concat(F.lit("["), F.array_join("calls", ","), F.lit("]"))),
        _text=F.when(F.try_parse_json("text").isNull(), _quoted(F.col("text"))),
    )
    known = known.select(
        "conv_id", "turn", "role", "text",
        F.coalesce("order_turn", "turn").alias("order_turn"),
        F.coalesce("order_step", F.lit(0)).alias("order_step"),
        F.coalesce(F.size("calls"), F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("n_invalid", F.lit(0)).cast("long").alias("n_invalid"),
        F.when(F.col("role") == "tool", F.col("call_mid").isNotNull()).alias("answers"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        written.alias("json"),
    )
    same = ["conv_id", "turn", "role", "text"]
    told = rows.where("said IS NOT NULL").select(*[F.col(c).alias(f"_{c}") for c in same])
    is_same = _all(F.col(f"_{c}").eqNullSafe(F.col(c)) for c in same)
    plain = rows.where("said IS NULL").select(
        "conv_id", "turn", "role",
        F.col("turn").alias("order_turn"),
        F.lit(0).alias("order_step"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_calls", "n_linked", "n_invalid")],
        F.when(F.col("role") == "tool", F.lit(False)).alias("answers"),
        F.lit(False).alias("cyclic"),
        F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("json"),
    )
    return plain.unionByName(told.join(known, is_same).select(*plain.columns))


def _all(conditions) -> Column:
    whole = F.lit(True)
    for condition in conditions:
        whole = whole & condition
    return whole
