"""Insert-only merge: new keys are added, known keys are left as they are."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.pending import distinct_keys
from millrace.session import stage


class Merge(NamedTuple):
    """`inserts`: source rows whose key the target lacks. `merged`: target and inserts together."""

    target: DataFrame
    inserts: DataFrame

    @property
    def merged(self) -> DataFrame:
        return self.target.unionByName(self.inserts.select(*self.target.columns))


def insert_only_merge(
    source: DataFrame,
    target: DataFrame,
    on: list[str],
    dedupe_by: list[str] | None = None,
    reject_null_keys: bool = False,
    batch_keys: DataFrame | None = None,
) -> Merge:
    """First write wins across runs.

    As with MERGE, copies of a new key inside one source are all inserted, and a NULL key never
    matches, so it is inserted again by each run. `dedupe_by` keeps only the first source row per
    key in that order; `reject_null_keys` drops rows with a NULL in the key.
    The result is one lazy plan. `batch_keys`, if given, holds the keys of a source with wide rows: the
    new keys are then settled first, on narrow columns, and staged (see `keep_new`).
    """
    if reject_null_keys:
        source = source.where(keyed(on))
    if batch_keys is None:
        inserts = drop_known(source, target, on)
    else:
        inserts = keep_new(source, target, on, batch_keys)
    if dedupe_by:  # of the new keys only, so that known rows are not shuffled
        inserts = first_per_key(inserts, on, dedupe_by)
    return Merge(target, inserts)


def drop_known(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in `known`, as one lazy anti join. A NULL in the key never matches.

    Copies of a known key collapse in the map tasks. The join also compares a hash of the key: it needs
    an exchange of its own for that, and only between plain exchanges does AQE split a hot key.
    """
    match = F.xxhash64(*on).alias("_match")
    listed = distinct_keys(known, on).select("*", match)
    columns = rows.columns
    return rows.select("*", match).join(listed, [*on, "_match"], "left_anti").select(*columns)


def keep_new(rows: DataFrame, known: DataFrame, on: list[str], batch_keys: DataFrame) -> DataFrame:
    """Rows whose key is in `batch_keys` and not in `known`, and rows with a NULL in the key.

    The new keys are settled on narrow columns and staged, which gives Spark their real size: wide
    rows are joined to a list that is broadcast if it is small, and are not shuffled then. Rows are let
    in by that list only, so a source that grows meanwhile brings in nothing that was not looked at.
    """
    batch = distinct_keys(batch_keys, on, where=keyed(on))
    new = stage(batch.join(distinct_keys(known, on), on, "left_anti")).withColumn("_new", F.lit(True))
    return rows.join(new, on, "left").where(F.col("_new") | ~keyed(on)).select(*rows.columns)


def keep_listed(rows: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in `listed`."""
    return rows.join(stage(distinct_keys(listed, on, where=keyed(on))), on, "left_semi").select(*rows.columns)


def first_per_key(rows: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """The first row per key. Spark cuts each map task to one row per key before the shuffle.

    Rows with a NULL in the key are no copies of one another and are all kept, each as a key of its
    own, so that they are spread over the tasks.
    """
    own = F.when(~keyed(on), F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(*on, "_own").orderBy(*order))
    ranked = rows.withColumn("_own", own).withColumn("_place", place)
    return ranked.where("_place = 1").select(*rows.columns)


def keyed(on: list[str]) -> Column:
    """No part of the key is NULL."""
    return reduce(and_, (F.col(k).isNotNull() for k in on))
