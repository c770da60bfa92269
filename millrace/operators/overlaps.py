"""Runs of one dataset that overlapped, against the rule of one writer per table at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.batching import numbered
from millrace.session import stage

STILL_OPEN = "TIMESTAMP_NTZ '9999-12-31 00:00:00'"


def overlapping_runs(runs: DataFrame, by: str, start: str, end: str, tie: str) -> DataFrame:
    """(by, start, end, tie, n_running, n_overlaps): a row per run that has a start.

    `n_overlaps` counts the other runs of the same `by` that ran at some time of it, `n_running` those
    of them that began before it; runs that begin together count by `end` and `tie`. Runs are half-open, so one that
    begins when another ends does not overlap it. A run lasts a microsecond at least. One without an end is
    still open. NULL is a dataset like any other; runs may repeat.

    A sweep over starts and ends without a join of runs to runs: a run's overlaps are the starts before
    its end less the ends before its start. Both counts come from distributed numberings of the starts, of the
    ends and of both together, so that no dataset is held or sorted in one task.
    """
    at = F.col(start).cast("timestamp_ntz")
    until = F.coalesce(F.col(end).cast("timestamp_ntz"), F.expr(STILL_OPEN))
    until = F.greatest(until, at + F.expr("INTERVAL '0.000001' SECOND"))
    named = runs.where(F.col(start).isNotNull()).select(
        F.col(by).alias("of"), at.alias("at"), until.alias("until"), F.col(tie).alias("tie"),
        F.col(start).alias("began"), F.col(end).alias("ended"),
    )
    starts = stage(numbered(named, ["of", "at", "until", "tie"], "run"))
    ends = starts.select("of", F.col("until").alias("at"), F.lit(0).alias("begins"), "run")
    both = ends.union(starts.select("of", "at", F.lit(1).alias("begins"), "run"))
    # The order of the starts among `both` is that of `run`, and that of the ends is that of `nth_end`.
    placed = numbered(both, ["of", "at", "begins", "run"], "place")
    nth_end = numbered(ends, ["of", "at", "run"], "nth_end").select("run", "nth_end")
    places = placed.groupBy("run").agg(
        F.max(F.when(F.col("begins") == 1, F.col("place"))).alias("start_place"),
        F.max(F.when(F.col("begins") == 0, F.col("place"))).alias("end_place"),
    )
    # Datasets before this one add as many starts as ends to each, and so nothing to their differences.
    ends_before = F.col("start_place") - F.col("run")
    starts_before = F.col("end_place") - F.col("nth_end")
    return starts.join(places, "run").join(nth_end, "run").select(
        F.col("of").alias(by),
        F.col("began").alias(start),
        F.col("ended").alias(end),
        F.col("tie").alias(tie),
        (F.col("run") - ends_before).alias("n_running"),
        (starts_before - ends_before - 1).alias("n_overlaps"),
    )
