"""Audit of request rates: how many requests fell into the window that ends at each one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.timing import epoch_micros, floor_div

# Requests allowed per window, as {window seconds: requests}.
RATE_LIMITS = {1: 20, 120: 100}


def trailing_counts(
    rows: DataFrame, by: list[str], at: str, windows: Mapping[str, int]
) -> DataFrame:
    """Add, per window, the number of rows of the same key in [at - seconds, at].

    `windows` maps the new column to its length in seconds. Equal to a count over a RANGE frame, but
    that frame walks the whole window again for every row and keeps all of a key in one task.
    Rows are counted per key and time first, with partial counts in the map tasks, so rows that share a
    time are one from there on. For each window, time is cut into slots as long as that window. A count
    enters the slot of its time, and leaves in the next slot, in which it must end. So a row's window
    holds what has entered its slot and what is still to leave it: running sums within (key, window, slot)
    groups, over which a hot key is spread. The sums are joined back to the rows, which are shuffled
    once; AQE splits a hot key and time there. Rows without a time get NULL counts.
    """
    keys = [f"_by_{i}" for i in range(len(by))]
    timed = rows.select(
        F.struct(*rows.columns).alias("_row"),
        *[F.col(c).alias(k) for c, k in zip(by, keys)],
        epoch_micros(rows, at).alias("_t"),
    )
    per_time = timed.where("_t IS NOT NULL").groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_n"))

    def step(window: int, slot: Column, at_us: Column, entered: Column, left: Column) -> Column:
        parts = {"_window": F.lit(window), "_slot": slot, "_at": at_us, "_entered": entered, "_left": left}
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    t, n, none, steps = F.col("_t"), F.col("_n"), F.lit(0).cast("bigint"), []
    for window, seconds in enumerate(windows.values()):
        length = seconds * 1_000_000
        slot = floor_div(t, length)
        steps += [step(window, slot, t, n, none), step(window, slot + 1, t + (length + 1), none, n)]
    group = Window.partitionBy(*keys, "_window", "_slot").orderBy("_at")
    so_far = group.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = group.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.sum(F.col("_entered") - F.col("_left")).over(so_far) + F.sum("_left").over(whole)
    swept = per_time.select(*keys, F.inline(F.array(*steps))).withColumn("_held", held).where("_entered > 0")
    counts = swept.groupBy(*keys, F.col("_at").alias("_t")).agg(
        *[F.max(F.when(F.col("_window") == i, F.col("_held"))).alias(name) for i, name in enumerate(windows)]
    )
    same = [timed[k].eqNullSafe(counts[k]) for k in keys] + [timed["_t"] == counts["_t"]]
    return timed.join(counts, same, "left").select("_row.*", *windows)


def rate_audit(
    log: DataFrame, by: list[str], at: str, limits: Mapping[int, int] = RATE_LIMITS
) -> DataFrame:
    """Add `in_<s>s` (requests in the trailing window) and `over_<s>s` (more than allowed).

    These are the stated limits. A token bucket lets up to twice as many through in one window.
    """
    counted = trailing_counts(log, by, at, {f"in_{s}s": s for s in limits})
    return counted.withColumns({f"over_{s}s": F.col(f"in_{s}s") > n for s, n in limits.items()})
