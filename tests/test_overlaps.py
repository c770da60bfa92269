"""Overlapping runs against all pairs of a small log."""

import random
from datetime import datetime, timedelta

from millrace.operators.overlaps import overlapping_runs

RUNS = "dataset string, a timestamp_ntz, b timestamp_ntz, id long"
T0 = datetime(2024, 1, 1)


def found(spark, runs):
    got = overlapping_runs(spark.createDataFrame(runs, RUNS).repartition(4), "dataset", "a", "b", "id")
    assert got.columns == ["dataset", "a", "b", "id", "n_running", "n_overlaps"]
    return {r.id: (r.n_running, r.n_overlaps) for r in got.collect()}


def test_equal_to_all_pairs(spark):
    rng = random.Random(4)
    runs = []
    for i in range(300):
        at = T0 + timedelta(seconds=rng.randrange(400))
        until = rng.choice([None, at, at - timedelta(seconds=3)]) if i % 25 == 0 else at + timedelta(seconds=rng.randrange(12))
        runs.append((rng.choice(["hot", "hot", "hot", "b", None]), at, until, i))
    spans = {}
    for of, at, until, i in runs:
        until = max(until or datetime(9999, 12, 31), at + timedelta(microseconds=1))
        spans[i] = (of, at, until)
    wanted = {}
    for i, (of, at, until) in spans.items():
        others = [j for j, (o, a, b) in spans.items() if j != i and o == of and a < until and b > at]
        wanted[i] = sum((spans[j][1:], j) < ((at, until), i) for j in others), len(others)
    assert found(spark, runs) == wanted


def test_touching_empty_and_missing(spark):
    def s(n):
        return T0 + timedelta(seconds=n)

    assert found(spark, []) == {}
    assert found(spark, [("x", s(0), s(5), 1), ("x", s(5), s(9), 2), ("y", s(0), s(9), 3), ("x", None, s(9), 4)]) == {
        1: (0, 0), 2: (0, 0), 3: (0, 0)
    }


def test_no_run_is_joined_to_runs(spark):
    runs = spark.createDataFrame([("x", T0, T0, 1)], RUNS)
    plan = overlapping_runs(runs, "dataset", "a", "b", "id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
