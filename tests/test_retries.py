"""The retry plan against a plain walk over each request's responses, in batch and as a stream."""

import random
import time
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.responses import with_action
from millrace.operators.retries import retry_plan, retry_runs
from millrace.streaming.retries import retry_stream

START = datetime(2024, 1, 1)
SCHEMA = "key string, id long, ts timestamp, status int, rate_limit_type string, retry_after int"


def log_rows(seed, n_keys, longest):
    rng = random.Random(seed)
    found, n = [], 0
    for k in [*range(n_keys), None]:
        for _ in range(rng.randint(1, longest)):
            n += 1
            status = rng.choice([429, 429, 429, 200, 404, 500])
            kind = rng.choice(["application", "method", "service", None])
            at = START + timedelta(seconds=rng.randint(0, 60))
            found.append((None if k is None else f"k{k}", n, at, status, kind, rng.choice([None, 5, 9])))
    rng.shuffle(found)
    return found


def plain_plan(table, most):
    found = []
    for key in {r[0] for r in table}:
        attempts, state = [], None
        for _, _, at, status, kind, after in sorted((r for r in table if r[0] == key), key=lambda r: (r[2], r[1])):
            if status == 429:
                wait = (after or 1) if kind in ("application", "method") else 2
                attempts.append((at, wait))
            else:
                attempts, state, last = [], {200: "done", 404: "not_found", 500: "failed"}[status], at
        if attempts:
            last, waiting = attempts[-1][0], len(attempts) < most
            due = last + timedelta(seconds=attempts[-1][1]) if waiting else None
            found.append((key, "waiting" if waiting else "given_up", len(attempts), attempts[0][0], last, due))
        else:
            found.append((key, state, 0, None, last, None))
    return sorted(found, key=repr)


def test_plan_equals_a_plain_walk(spark):
    table = log_rows(1, 60, 12)
    log = with_action(spark.createDataFrame(table, SCHEMA).repartition(4))
    assert rows(retry_plan(log, ["key"], "ts", "id", 3)) == plain_plan(table, 3)
    assert retry_plan(log.limit(0), ["key"], "ts", "id", 3).count() == 0
    assert retry_plan(log.withColumn("ts", F.lit(None).cast("timestamp")), ["key"], "ts", "id", 3).count() == 0


def test_waits_of_the_three_kinds(spark):
    log = [("a", 1, START, 429, "application", 5), ("m", 2, START, 429, "method", 3), ("s", 3, START, 429, "service", None),
           ("n", 4, START, 404, None, None), ("x", 5, None, 200, None, None)]
    plan = retry_plan(with_action(spark.createDataFrame(log, SCHEMA)), ["key"], "ts", "id", 3).collect()
    due = {r.key: r.next_due and (r.next_due - START).seconds for r in plan}
    assert due == {"a": 5, "m": 3, "s": 2, "n": None}


def test_runs_are_islands(spark):
    table = [("k", n, START + timedelta(seconds=n), s, "method", 4) for n, s in enumerate([429, 429, 200, 404, 429, 500, 429])]
    runs = retry_runs(with_action(spark.createDataFrame(table, SCHEMA)), ["key"], "ts", "id").orderBy("run").collect()
    assert [(r.attempts, r.waited_s, r.outcome) for r in runs] == [(3, 8, "parse"), (1, 0, "not_found"), (2, 4, "fail"), (1, 4, None)]


def test_a_hot_request_is_counted_in_the_map_tasks(spark, executed):
    log = spark.range(0, 200_000, 1, 8).selectExpr(
        "'hot' AS key", "id", "timestamp_seconds(id) AS ts", "429 AS status", "'method' AS rate_limit_type", "1 AS retry_after"
    )
    plan = retry_plan(with_action(log), ["key"], "ts", "id", 10**9)
    assert plan.first().attempts == 200_000
    assert "Window" not in executed(plan)


def test_stream_equals_the_batch_plan(spark, conf, tmp_path, parts=3):
    """Responses arrive in any order, in several micro-batches; timers in the past fire as due."""
    conf(spark__sql__shuffle__partitions="2")
    table = [r for r in log_rows(3, 6, 8) if r[0] is not None]
    landing = tmp_path / "in"
    for n in range(parts):
        spark.createDataFrame(table[n::parts], SCHEMA).coalesce(1).write.mode("append").parquet(str(landing))
    seen = []
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(landing))
    plan = retry_stream(with_action(stream), ["key"], "ts", "id", 3)

    def keep(batch, number):
        seen.append([tuple(r) for r in batch.collect()])

    query = plan.writeStream.outputMode("update").foreachBatch(keep)
    query = query.option("checkpointLocation", str(tmp_path / "state")).start()
    until = time.monotonic() + 90  # a query with timers has no end of its own
    while time.monotonic() < until and query.isActive and not (len(seen) > parts and any(r[1] == "due" for r in seen[-1])):
        time.sleep(0.2)
    query.stop()
    last = {}
    for batch in seen:
        last |= {r[0]: r for r in batch if r[1] != "due"}
    assert sorted(last.values(), key=repr) == plain_plan(table, 3)
    waiting = {r[0]: r for r in last.values() if r[1] == "waiting"}
    due = [r for batch in seen for r in batch if r[1] == "due"]
    assert waiting and due and all(r[5] is not None for r in due)
