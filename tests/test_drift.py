"""Schema drift: paths, kinds and absences, against a plain walk."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from millrace.operators import drift
from millrace.operators.drift import declared_paths, drift_report, path_counts


def walk(value, path, counts):
    kinds = {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", type(None): "null"}
    whole = isinstance(value, float) and value == int(value)
    counts[path, "integer" if whole else kinds.get(type(value), "number")] += 1
    inner = []
    if isinstance(value, dict):
        inner = [(f".{k}" if k.isalpha() else f'."{k}"', v) for k, v in value.items()]
    elif isinstance(value, list):
        inner = [("[]", v) for v in value]
    for step, v in inner:
        walk(v, path + step, counts)


def made(rng, depth):
    if depth and rng.random() < 0.6:
        if rng.random() < 0.4:
            return [made(rng, depth - 1) for _ in range(rng.randrange(4))]
        return {k: made(rng, depth - 1) for k in rng.sample(["a", "b", "c.d", "e f", "1"], rng.randrange(5))}
    return rng.choice([None, True, 3, -7, 2.5, 4.0, "x", "", 10**17, {}, []])


@pytest.mark.parametrize("levels", [1, 4])
def test_counts_equal_a_plain_walk(spark, levels):
    rng = random.Random(levels)
    values = [made(rng, 6) for _ in range(200)]
    counts = Counter()
    for v in values:
        walk(v, "$", counts)
    texts = [(json.dumps(v), "k") for v in values]
    texts += [("{torn", "k"), ("", "k"), ('{"a":1,"a":2}', "k"), (None, "k")]
    counts["$", "malformed"] = 3
    bodies = spark.createDataFrame(texts, "text string, path string").repartition(3)
    got = path_counts(bodies, "text", levels).collect()
    assert {(r.path, r.kind): r.n_values for r in got} == counts


def test_report(spark):
    bodies = [('{"a":1,"b":{"x":"s"},"n":7}',), ('{"a":"1","b":{},"c.d":[1]}',), ('{"a":null,"n":1.5}',)]
    declared = T.StructType.fromDDL("a int, b struct<x: string, y: date>, n double, l array<struct<z: int>>")
    report = drift_report(path_counts(spark.createDataFrame(bodies, "body string")), declared)
    assert {tuple(r) for r in report.collect()} == {
        ("$", "declared", "object", "object", 3, None),
        ("$.a", "declared", "integer", "integer", 1, 0),
        ("$.a", "retyped", "integer", "string", 1, 0),
        ("$.a", "declared", "integer", "null", 1, 0),
        ("$.b", "declared", "object", "object", 2, 1),
        ("$.b.x", "declared", "string", "string", 1, 1),
        ("$.b.y", "missing", "string", None, 0, 2),
        ('$."c.d"', "new", None, "array", 1, 2),
        ('$."c.d"[]', "new", None, "integer", 1, None),
        ("$.n", "declared", "number", "integer", 1, 1),
        ("$.n", "declared", "number", "number", 1, 1),
        ("$.l", "missing", "array", None, 0, 3),
        ("$.l[]", "missing", "object", None, 0, None),
        ("$.l[].z", "missing", "integer", None, 0, 0),
    }


def test_counts_of_batches_add_up(spark):
    declared = T.StructType.fromDDL("a int")
    one, two = (spark.createDataFrame([(b,) for b in bodies], "body string")
                for bodies in (['{"a":1}', "7"], ['{"a":2}', '{"b":[]}']))
    apart = path_counts(one).union(path_counts(two))
    whole = drift_report(path_counts(one.union(two)), declared)
    assert sorted(map(str, drift_report(apart, declared).collect())) == sorted(map(str, whole.collect()))


def test_empty_and_undeclarable(spark):
    none = spark.createDataFrame([], "body string")
    report = drift_report(path_counts(none), T.StructType.fromDDL("a int")).collect()
    assert {(r.path, r.status) for r in report} == {("$", "missing"), ("$.a", "missing")}
    with pytest.raises(ValueError):
        declared_paths(T.BinaryType())


def test_bodies_are_parsed_once_and_only_counts_are_shuffled(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(drift, "stage", lambda df: plans.append(df) or df)
    path_counts(spark.createDataFrame([("[1]",)], "body string"))
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
    optimized = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("try_parse_json") + optimized.count("parse_json(") <= 2
