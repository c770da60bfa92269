from datetime import datetime

from conftest import rows

from millrace.operators.responses import with_action
from millrace.operators.runlog import batch_counters

DDL = "id int, status int, rate_limit_type string, retry_after int"


def test_actions(spark):
    log = [
        (1, 200, None, None),
        (2, 429, "application", 5),
        (3, 429, "method", 3),
        (4, 429, "method", None),
        (5, 429, "service", None),
        (6, 429, None, 9),
        (7, 404, None, None),
        (8, 403, None, None),
        (9, 503, "application", 5),
        (10, None, None, None),
        (11, 304, None, None),
    ]
    out = with_action(spark.createDataFrame(log, DDL)).select("id", "action", "wait_s")
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, "parse", None),
        (2, "retry_after", 5),
        (3, "retry_after", 3),
        (4, "retry_after", 1),
        (5, "retry_service", 2),
        (6, "retry_service", 2),
        (7, "not_found", None),
        (8, "fail", None),
        (9, "fail", None),
        (10, "fail", None),
        (11, "parse", None),
    ]


def test_batch_counters_and_outcomes(spark):
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    log = [
        ("good", 200, t[0]),
        ("good", 429, t[1]),
        ("good", 200, t[2]),
        ("part", 200, t[1]),
        ("part", 404, t[0]),
        ("bad", 500, t[0]),
        ("none", 429, t[0]),
        ("none", 429, t[1]),
    ]
    df = spark.createDataFrame(
        [(b, b, s, None, None, at) for b, s, at in log],
        "batch_id string, id string, status int, rate_limit_type string, retry_after int, ts timestamp_ntz",
    )
    out = batch_counters(with_action(df), ["batch_id"], "ts", ["id"])
    assert rows(out) == [
        ("bad", t[0], t[0], 0, 0, 1, 0, 0, "FAILED"),
        ("good", t[0], t[2], 2, 1, 0, 0, 0, "SUCCESS"),
        ("none", t[0], t[1], 0, 2, 0, 0, 1, "FAILED"),
        ("part", t[0], t[1], 1, 0, 1, 0, 0, "PARTIAL"),
    ]
