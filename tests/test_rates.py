"""Trailing counts and newest rows against brute force."""

import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.latest import latest_per_key
from millrace.operators.rates import RATE_LIMITS, rate_audit, trailing_counts

START = datetime(2024, 1, 1)


def _log(n, span_s, seed):
    """A third of the rows has one key; whole seconds make equal times and exact window edges."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rng.random() < 1 / 3 else rng.randrange(1, 6)
        at = START + timedelta(seconds=rng.randrange(span_s), microseconds=rng.choice([0, 0, 1]))
        out.append((i, key, at))
    return out


def _brute(log, seconds):
    w = timedelta(seconds=seconds)
    return {
        i: sum(1 for _, k2, t2 in log if k2 == k and t - w <= t2 <= t) for i, k, t in log
    }


def test_trailing_counts_equal_brute_force(spark):
    for ddl in ("id int, k int, ts timestamp", "id int, k int, ts timestamp_ntz"):
        log = _log(600, 900, seed=7)
        df = spark.createDataFrame(log, ddl).repartition(4)
        out = trailing_counts(df, ["k"], "ts", {"a": 1, "b": 7, "c": 120}).collect()
        assert len(out) == 600
        for name, seconds in (("a", 1), ("b", 7), ("c", 120)):
            assert {r.id: r[name] for r in out} == _brute(log, seconds)


def test_times_before_1970_and_without_a_time(spark):
    log = [(1, 1, datetime(1969, 12, 31, 23, 59, 59)), (2, 1, datetime(1970, 1, 1)), (3, 1, None)]
    df = spark.createDataFrame(log, "id int, k int, ts timestamp_ntz")
    out = trailing_counts(df, ["k"], "ts", {"n": 1})
    assert {r.id: r.n for r in out.collect()} == {1: 1, 2: 2, 3: None}


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(1, None, START), (2, None, START)], "id int, k int, ts timestamp_ntz")
    assert {r.id: r.n for r in trailing_counts(df, ["k"], "ts", {"n": 5}).collect()} == {1: 2, 2: 2}


def test_limits_of_the_source(spark):
    assert RATE_LIMITS == {1: 20, 120: 100}
    times = [(i, START + timedelta(milliseconds=40 * i)) for i in range(25)]
    df = spark.createDataFrame(times, "id int, ts timestamp_ntz").withColumn("k", F.lit("key"))
    out = {r.id: r for r in rate_audit(df, ["k"], "ts").collect()}
    assert out[19].in_1s == 20 and not out[19].over_1s
    assert out[20].in_1s == 21 and out[20].over_1s
    assert out[24].in_120s == 25 and not out[24].over_120s


def test_a_hot_key_is_spread_over_slots_of_each_window(spark):
    df = spark.range(0, 1000).select(
        (F.col("id") % 2).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("ts")
    )
    plan = trailing_counts(df, ["k"], "ts", {"a": 120, "b": 3600})._jdf.queryExecution().executedPlan().toString()
    swept = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_slot" in line]
    assert len(swept) == 1 and "_by_0" in swept[0] and "_window" in swept[0]


def test_a_hot_key_in_one_slot_is_counted_before_it_is_swept(spark):
    """20,000 rows of one key and three times: what the running sums read does not grow with the rows."""
    df = spark.range(0, 20_000, 1, 4).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") % 3).alias("ts")
    )
    counted = trailing_counts(df, ["k"], "ts", {"a": 1, "b": 60})
    got = counted.groupBy("ts", "a", "b").count().orderBy("ts").collect()
    assert [(r.a, r.b, r["count"]) for r in got] == [
        (6667, 6667, 6667), (13334, 13334, 6667), (13333, 20000, 6666)
    ]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window ["):]
    assert below.index("_slot") < below.index("partial_count")


def test_clashing_names_and_no_rows(spark):
    log = [(1, 1, START, 5), (2, 1, START, 6)]
    df = spark.createDataFrame(log, "id int, _by_0 int, _t timestamp_ntz, _slot int")
    assert {r.id: r.n for r in trailing_counts(df, ["_by_0"], "_t", {"n": 5}).collect()} == {1: 2, 2: 2}
    assert trailing_counts(df.limit(0), ["_by_0"], "_t", {"n": 5}).count() == 0


def _brute_latest(log, start, count):
    out = []
    for key in {k for _, k, _ in log}:
        mine = sorted((r for r in log if r[1] == key), key=lambda r: (r[2], r[0]), reverse=True)
        out += mine[start : start + count]
    return sorted(out, key=repr)


def test_latest_equals_brute_force(spark):
    log = _log(500, 60, seed=3)
    df = spark.createDataFrame(log, "id int, k int, ts timestamp_ntz").repartition(5)
    for start, count in ((0, 1), (0, 20), (10, 20), (400, 5)):
        got = rows(latest_per_key(df, ["k"], "ts", "id", count, start))
        assert got == _brute_latest(log, start, count)


def test_latest_with_a_filter(spark):
    log = [(1, 1, START), (2, 1, START + timedelta(1)), (3, 2, START)]
    df = spark.createDataFrame(log, "id int, k int, ts timestamp_ntz")
    assert rows(latest_per_key(df, ["k"], "ts", "id", 1, where=F.col("id") != 2)) == [log[0], log[2]]


def test_map_side_cut_below_the_threshold(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 AS k", "id AS ts")
    plan = latest_per_key(df, ["k"], "ts", "id", 20)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_salted_cut_above_the_threshold(spark, conf):
    conf(spark__sql__optimizer__windowGroupLimitThreshold="3")
    log = _log(500, 60, seed=4)
    df = spark.createDataFrame(log, "id int, k int, ts timestamp_ntz").repartition(6)
    out = latest_per_key(df, ["k"], "ts", "id", count=20, start=5)
    assert "_salt" in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == _brute_latest(log, 5, 20)
