"""Sharding: a contiguous partition of ordered groups of equal texts with the smallest largest shard.

Rows of equal texts are one group that no cut divides. Groups are ordered by the hash of their text,
so that neighbours have nothing in common and each shard is a fair mix. A shard's capacity is
feasible if filling shards greedily in that order needs no more than `shards` of them; the smallest
feasible capacity is found by binary search, and the groups are cut where the greedy filling with it
ends its shards.

Groups are sums made in the map tasks. Their sizes stay in a staged table, cut into `2^BUCKET_BITS`
buckets of the order. The driver holds only the buckets' sums, a number that the data don't change, and
reads the groups of a bucket where a shard may end in it, a few buckets at a time. A cut is the hash
of a shard's last group, so that assigning rows is a projection.

Slots number the rows of a shard without gaps: rows are staged as they are, their tasks' counts per
shard are summed up, and each task's rows are numbered from there. No shard passes through one task.

A NULL text has no bytes; all NULL texts are one group, other than the empty texts. Repeated rows are
rows of their own. With fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import fresh
from millrace.session import stage

ROW_BYTES = 8
BUCKET_BITS = 17


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text and a constant for the rest of the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def text_group(text: Column) -> Column:
    """The place of a text's group in the order."""
    return F.when(text.isNull(), F.xxhash64(F.lit(0))).otherwise(F.xxhash64(text))


class GroupSizes:
    """Ordered group sizes, of which only the sums of buckets are in memory."""

    def __init__(self, groups: DataFrame, bits: int = BUCKET_BITS):
        """`groups`: (group long, size long, bucket long), staged."""
        self.groups = groups
        per = groups.groupBy("bucket").agg(
            F.sum("size").alias("size"), F.max("size").alias("most"), F.count("size").alias("n")
        )
        sums = np.zeros(1 << bits, np.int64)
        self.most = n = 0
        for row in per.collect():  # 2^bits rows at most
            sums[row["bucket"]] = row["size"]
            self.most, n = max(self.most, row["most"]), n + row["n"]
        self.ends = np.cumsum(sums)
        self.total = int(self.ends[-1])
        self.mean = self.total // max(n, 1)
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bucket(self, total: int) -> int:
        return int(np.searchsorted(self.ends, total, side="right"))

    def forget(self) -> None:
        self.read.clear()

    def load(self, spans: list[tuple[int, int]]) -> None:
        """Read the groups of the buckets in which these spans of running totals lie."""
        spans = sorted((self.bucket(max(low, 0)), self.bucket(high)) for low, high in spans)
        within = reduce(or_, (F.col("bucket").between(*span) for span in spans), F.lit(False))
        rows = self.groups.where(within).toArrow()
        columns = (rows.column(c).to_numpy() for c in ("bucket", "group", "size"))
        bucket, keys, sizes = columns
        order = np.lexsort((keys, bucket))
        bucket, keys, sizes = bucket[order], keys[order], sizes[order]
        found, begins = np.unique(bucket, return_index=True)
        for b, at, to in zip(found.tolist(), begins, [*begins[1:], len(bucket)]):
            before = self.ends[b - 1] if b else 0
            self.read[b] = keys[at:to], before + np.cumsum(sizes[at:to])

    def last_within(self, total: int) -> tuple[int, int | None]:
        """The largest running total that is not above `total`, and the group that ends there.

        The group is None where that is the end of an earlier bucket.
        """
        b = self.bucket(total)
        if b == len(self.ends):
            return self.total, None
        if b not in self.read:
            self.load([(total, total)])
        keys, ends = self.read[b]
        i = bisect_right(ends, total) - 1
        if i < 0:
            return int(self.ends[b - 1]) if b else 0, None
        return int(ends[i]), int(keys[i])

    def first_from(self, total: int) -> int:
        """The smallest running total that is not below `total`."""
        if total <= 0 or total >= self.total:
            return min(max(total, 0), self.total)
        b = int(np.searchsorted(self.ends, total, side="left"))
        if int(self.ends[b]) == total:
            return total
        if b not in self.read:
            self.load([(total, total)])
        ends = self.read[b][1]
        return int(ends[bisect_left(ends, total)])

    def large(self, shards: int) -> list[tuple[int, int]]:
        """(begin, end) of the groups above an even share of what smaller groups leave; fewer than `shards`."""
        found, rest = [], self.total
        while len(found) < shards:
            share = rest / (shards - len(found))
            if self.most <= share:
                break
            more = self.groups.where(F.col("size") > F.lit(share)).select("bucket", "group", "size").collect()
            if len(more) == len(found):
                break
            found, rest = more, self.total - sum(r["size"] for r in more)
        places = []
        for row in found:
            b = row["bucket"]
            if b not in self.read:
                begin = int(self.ends[b - 1]) if b else 0
                self.load([(begin, begin)])
            keys, ends = self.read[b]
            end = int(ends[bisect_left(keys, row["group"])])
            places.append((end - row["size"], end))
        return sorted(places)


def greedy_ends(sizes: GroupSizes, capacity: int, shards: int) -> list[int] | None:
    """Running totals at the ends of shards filled up to `capacity`; None if they don't suffice."""
    ends, at = [], 0
    # Each shard leaves about half a group's size free, so its end lies close below a multiple.
    full = [(i, (i + 1) * capacity) for i in range(shards)]
    sizes.forget()
    sizes.load([(end - (i + 1) * sizes.mean, end) for i, end in full if end < sizes.total])
    while at < sizes.total and len(ends) < shards:
        at, _ = sizes.last_within(min(sizes.total, at + capacity))
        ends.append(at)
    return ends if at >= sizes.total else None


def smallest_capacity(sizes: GroupSizes, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the ends of its shards."""
    low = max(sizes.most, -(-sizes.total // shards))
    high = max(low, -(-sizes.total // shards) + sizes.most)  # filling to at least the mean suffices
    best = greedy_ends(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        ends = greedy_ends(sizes, middle, shards)
        if ends is None:
            low = middle + 1
        else:
            high, best = middle, ends
    return high, best or []


def even_ends(sizes: GroupSizes, capacity: int, shards: int) -> list[int]:
    """Running totals at the ends of shards that are as even as may be, none above a feasible capacity."""
    sizes.forget()
    mean, total = sizes.total // shards, sizes.total
    spans = [(total - i * capacity, total - i * capacity + i * sizes.mean) for i in range(1, shards)]
    spans += [(i * mean - sizes.mean, i * mean + sizes.mean) for i in range(1, shards)]
    sizes.load([(low, min(high, total - 1)) for low, high in spans if high >= 0 and low < total])
    # From latest[i] on, i shards suffice.
    latest = [total]
    for _ in range(shards - 1):
        latest.append(sizes.first_from(latest[-1] - capacity))
    large, ends, at = sizes.large(shards), [], 0
    while at < total:
        left = shards - len(ends)
        large = [span for span in large if span[0] >= at]
        if large and large[0][0] == at:
            end = large[0][1]
        else:
            share = (total - at - sum(end - begin for begin, end in large)) / max(1, left - len(large))
            # As many shards up to the next large group as come nearest to the share, even among themselves.
            run = (large[0][0] if large else total) - at
            aim = at + -(-run // max(1, round(run / share)))
            low, end = sizes.last_within(min(aim, total))[0], sizes.first_from(aim)
            if low > at and aim - low <= end - aim:
                end = low
            end = min(end, sizes.last_within(min(total, at + capacity))[0])
        end = max(end, latest[left - 1])
        ends.append(end)
        at = end
    return ends


def cuts(rows: DataFrame, shards: int, group: Column, size: Column, bits: int = BUCKET_BITS) -> list[int]:
    """The first group of each shard but the first, in order; at most `shards` - 1 of them."""
    groups = rows.select(group.alias("group"), size.alias("size"))
    groups = groups.groupBy("group").agg(F.sum("size").alias("size"))
    # The order is that of signed numbers: the sign bit is turned for the bucket's number.
    bucket = F.shiftrightunsigned(F.col("group").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits)
    groups = groups.withColumn("bucket", bucket)
    # Sorted files, of which a read of some buckets skips most.
    sizes = GroupSizes(stage(groups.repartitionByRange("bucket").sortWithinPartitions("bucket")), bits)
    capacity, _ = smallest_capacity(sizes, shards)
    ends = even_ends(sizes, capacity, shards) if sizes.total else []
    return [_group_after(sizes, end) for end in ends[:-1]]


def _group_after(sizes: GroupSizes, end: int) -> int:
    """The first group behind a running total that is some group's end."""
    if sizes.bucket(end) not in sizes.read:
        sizes.load([(end, end)])
    keys, ends = sizes.read[sizes.bucket(end)]
    return int(keys[bisect_right(ends, end)])


def assign_shards(
    rows: DataFrame,
    shards: int = 24,
    group: Column | None = None,
    size: Column | None = None,
    text: str = "text",
    bits: int = BUCKET_BITS,
    columns: tuple[str, str, str] = ("size", "shard", "slot"),
) -> DataFrame:
    """`rows` with the row's size, its shard from 0 and its slot in the shard from 0.

    `group` and `size` may replace the text's group and bytes, where they are columns already and the
    rows need not carry the text.
    """
    group = text_group(F.col(text)) if group is None else group
    size = row_size(F.col(text)) if size is None else size
    size_name, shard, slot = columns
    part, nth, begin = fresh(rows.withColumns({c: F.lit(0) for c in columns}), "_part", "_nth", "_begin")
    after = [(group >= cut).cast("int") for cut in cuts(rows, shards, group, size, bits)]
    placed = stage(rows.withColumns({
        size_name: size,
        shard: sum(after, F.lit(0)),
        part: F.spark_partition_id(),
        nth: F.monotonically_increasing_id(),
    }))
    counts = placed.groupBy(shard, part).agg(F.count(F.lit(1)).alias(begin))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begins = stage(counts.withColumn(begin, F.coalesce(F.sum(begin).over(before), F.lit(0))))
    within = F.row_number().over(Window.partitionBy(shard, part).orderBy(nth)) - 1
    numbered = placed.withColumn(slot, within.cast("long")).join(begins, [shard, part])
    kept = [c for c in rows.columns if c not in columns]
    return numbered.withColumn(slot, F.col(slot) + F.col(begin)).select(*kept, *columns)
