"""Numbers without gaps, and the batches of requests that they make under rate limits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.rates import RATE_LIMITS
from millrace.session import stage

IN_PART = 33  # low bits of monotonically_increasing_id: a row's place in its partition


def numbered(rows: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """`rows` with their number from 0 in the order of `order`; equal rows in any order.

    A distributed prefix sum: rows are sorted by range and staged with their place in their partition; the
    partitions' sizes, one number each, become offsets. No window holds all rows, and a hot value is split
    over partitions where further columns of `order` tell its rows apart.
    """
    place, part, offset = (_free(rows, c) for c in ("_place", "_part", "_offset"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn(place, F.monotonically_increasing_id()))
    part_of = F.shiftright(place, IN_PART)
    sizes = placed.groupBy(part_of.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    listed = F.sort_array(F.collect_list(F.struct("part", "size")))
    none = F.array().cast("array<struct<part:bigint,offset:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("next"), none.alias("found"))
    offsets = sizes.agg(listed.alias("listed")).select(
        F.aggregate("listed", start, lambda so_far, one: F.struct(
            (so_far["next"] + one["size"]).alias("next"),
            F.array_append(so_far["found"], F.struct(one["part"].alias("part"), so_far["next"].alias("offset"))).alias("found"),
        ))["found"].alias("found")
    )
    offsets = stage(offsets.select(F.inline("found")).toDF(part, offset))
    number = F.col(offset) + F.col(place).bitwiseAND(F.lit((1 << IN_PART) - 1))
    return placed.withColumn(part, part_of).join(offsets, part).select(*rows.columns, number.alias(name))


def earliest_start(number: Column, limits: Mapping[int, int] = RATE_LIMITS) -> Column:
    """Seconds after the first request at which the request of a number may start at the earliest.

    As many as the shortest window allows start at a time, until a longer window is full; half-open
    windows, so that the next ones start when the window is over.
    """
    start, rest = F.lit(0).cast("bigint"), number
    for seconds, requests in _longest_first(limits):
        start, rest = start + F.floor(rest / requests) * seconds, rest % requests
    return start.cast("bigint")


def batch_of(number: Column, limits: Mapping[int, int] = RATE_LIMITS) -> Column:
    """The number of the batch, from 0, of requests that may start together."""
    levels = _longest_first(limits)
    batch, rest = F.lit(0).cast("bigint"), number
    for i, (_, requests) in enumerate(levels):
        batches = 1
        for (_, more), (_, fewer) in zip(levels[i:], levels[i + 1 :]):
            batches *= -(-more // fewer)
        batch, rest = batch + F.floor(rest / requests) * batches, rest % requests
    return batch.cast("bigint")


def request_batches(
    keys: DataFrame, order: list[str], limits: Mapping[int, int] = RATE_LIMITS
) -> DataFrame:
    """`keys` with `n`, `batch` and `earliest_s`: what to ask for together, and when."""
    n = F.col("n")
    return numbered(keys, order).withColumns({"batch": batch_of(n, limits), "earliest_s": earliest_start(n, limits)})


def _longest_first(limits: Mapping[int, int]) -> list[tuple[int, int]]:
    levels = sorted(limits.items(), reverse=True)
    for (long, more), (short, fewer) in zip(levels, levels[1:]):
        if fewer > more or -(-more // fewer) * short > long:
            raise ValueError(f"{fewer} in {short} s can't fill {more} in {long} s: leave the longer window out")
    return levels


def _free(rows: DataFrame, name: str) -> str:
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name
