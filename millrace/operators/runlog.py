"""Counters and outcome of each batch, from the response log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def batch_counters(
    actions: DataFrame, by: list[str], at: str, request: list[str], retried: bool = True
) -> DataFrame:
    """Per batch: first and last response, successful requests, 429s, and what went wrong.

    `actions` is a log with the `action` column of `with_action`; `request` names the columns that tell
    requests apart. `_rejects`, if the log has it, is the number of rejects of a response, and
    `_malformed` whether all of it is one. Where a response has several rows, `_response` marks one of
    them, and the others count by their rejects only. `unanswered` counts requests that got nothing but
    429s. With `retried` false the log is known to have no 429s; requests are not told apart then.

    SUCCESS: nothing failed for good, was rejected or stayed unanswered; FAILED: no request brought
    anything; PARTIAL: some did. Both shuffles are pre-aggregated.
    """
    action = F.col("action")
    response = F.col("_response") if "_response" in actions.columns else F.lit(True)
    parsed = action == "parse"
    rejects = F.col("_rejects") if "_rejects" in actions.columns else F.lit(0)
    malformed = F.col("_malformed") if "_malformed" in actions.columns else F.lit(False)
    per_request = actions.groupBy(*by, *(request if retried else [])).agg(
        F.min(at).alias("run_start"),
        F.max(at).alias("run_end"),
        F.count_if(parsed & response).alias("requests_made"),
        F.count_if(parsed & response & ~malformed).alias("_good"),
        F.count_if((F.col("status") == 429) & response).alias("count_429"),
        F.count_if(action.isin("not_found", "fail") & response).alias("failures"),
        F.sum(F.when(parsed, rejects).otherwise(0)).alias("rejected"),
        F.count_if(~action.startswith("retry")).alias("_final"),
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("requests_made", "count_429", "failures", "rejected", "_good")]
    counters = per_request.groupBy(*by).agg(
        F.min("run_start").alias("run_start"),
        F.max("run_end").alias("run_end"),
        *sums,
        F.count_if((F.col("_final") == 0) & F.lit(retried)).alias("unanswered"),
    )
    failed = F.col("failures") + F.col("rejected") + F.col("unanswered")
    return counters.withColumn("status", outcome(F.col("_good"), failed)).drop("_good")


def outcome(succeeded: Column, failed: Column) -> Column:
    return F.when(failed == 0, "SUCCESS").when(succeeded == 0, "FAILED").otherwise("PARTIAL")
