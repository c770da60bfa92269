"""When to ask again: what each request's logged responses come to, and the runs of attempts they form.

A request is asked again after a 429, by the waits of `with_action`. An attempt counts from the last response
that was no 429; after `max_attempts` of them in a row a request is given up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETRIES = ("retry_after", "retry_service")
STATES = {"parse": "done", "not_found": "not_found", "fail": "failed"}  # of requests that are answered for good


def _is_retry() -> Column:
    return F.coalesce(F.col("action").isin(*RETRIES), F.lit(False))


def retry_plan(actions: DataFrame, by: list[str], at: str, tie: str, max_attempts: int) -> DataFrame:
    """(by, state, attempts, first_at, last_at, next_due): one row per request of a log `with_action`.

    state: done, not_found or failed, by the last response; or waiting until `next_due`, the last
    response and its wait; or given_up. `attempts` counts the 429s since the last other response,
    `first_at` is the first of them. Responses are ordered by `at` and `tie`. Rows without a time are left out;
    a request's columns may be NULL.

    Two aggregates with partial ones in the map tasks: where each request's last other response lies, and
    what came after it. No request's responses are sorted or gathered, so a hot one is harmless.
    """
    keys = [f"_by_{i}" for i in range(len(by))]
    rows = actions.where(F.col(at).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)],
        F.struct(F.col(at).alias("at"), F.col(tie).alias("tie")).alias("_place"),
        F.col("action").alias("_action"),
        F.col("wait_s").alias("_wait"),
        _is_retry().alias("_retry"),
    )
    ends = rows.groupBy(*keys).agg(
        F.max(F.when(~F.col("_retry"), F.col("_place"))).alias("_end"),
        F.max(F.struct("_place", "_action", "_wait", "_retry")).alias("_last"),
    )
    ends = ends.select(*[F.col(k).alias(f"{k}_end") for k in keys], "_end", "_last")
    same = [rows[k].eqNullSafe(ends[f"{k}_end"]) for k in keys]
    open_rows = rows.where("_retry").join(ends.select(*[f"{k}_end" for k in keys], "_end"), same)
    open_rows = open_rows.where(F.col("_end").isNull() | (F.col("_place") > F.col("_end")))
    since = open_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_place.at").alias("_first"))
    joined = ends.join(since, [ends[f"{k}_end"].eqNullSafe(since[k]) for k in keys], "left")
    attempts = F.coalesce("_n", F.lit(0)).cast("bigint")
    waiting = F.col("_last._retry") & (attempts < max_attempts)
    state = F.when(waiting, "waiting").when(F.col("_last._retry"), "given_up")
    for action, name in STATES.items():
        state = state.when(F.col("_last._action") == action, name)
    last_at = F.col("_last._place.at")
    due = last_at + F.make_dt_interval(secs=F.col("_last._wait").cast("decimal(18,6)"))
    return joined.select(
        *[F.col(f"{k}_end").alias(c) for c, k in zip(by, keys)],
        state.alias("state"),
        attempts.alias("attempts"),
        F.col("_first").alias("first_at"),
        last_at.alias("last_at"),
        F.when(waiting, due).alias("next_due"),
    )


def retry_runs(actions: DataFrame, by: list[str], at: str, tie: str) -> DataFrame:
    """(by, run, attempts, started, ended, waited_s, outcome): the islands of attempts of each request.

    A run ends with the first response that is no 429; `outcome` is its action, or NULL for a run that is
    still open. `attempts` counts all its responses, `waited_s` the waits asked for. Runs of one response
    that is no 429 are requests answered at once.

    A request's responses are sorted in one task, which holds none of them but spills where they
    are many; `retry_plan` does without.
    """
    rows = actions.where(F.col(at).isNotNull())
    before = Window.partitionBy(*by).orderBy(at, tie).rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum((~_is_retry()).cast("bigint")).over(before), F.lit(0))
    rows = rows.select(*by, F.col(at).alias("_at"), F.when(_is_retry(), F.col("wait_s")).alias("_wait"),
                       F.when(~_is_retry(), F.col("action")).alias("_ended"), run.alias("run"))
    return rows.groupBy(*by, "run").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min("_at").alias("started"),
        F.max("_at").alias("ended"),
        F.coalesce(F.sum("_wait"), F.lit(0)).cast("bigint").alias("waited_s"),
        F.max("_ended").alias("outcome"),
    )
