"""Membership checks against a list of known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.pending import distinct_keys, pending_keys
from millrace.session import stage, staging


class UnknownKeys(ValueError):
    """Keys that the list of known keys does not have."""


def unknown_keys(rows: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Distinct keys in upper case that `known` does not list."""
    return pending_keys(rows.select(F.upper(on).alias(on)), known.select(F.upper(on).alias(on)), on)


def known_text(known: DataFrame, on: str) -> DataFrame:
    """The known keys as one sorted line for a message: for lists that are short by nature."""
    keys = distinct_keys(known.select(F.upper(on).alias(on)), on)
    return keys.agg(F.array_join(F.sort_array(F.collect_list(on)), ", ").alias("known"))


def require_known(rows: DataFrame, known: DataFrame, on: str, named: int = 10) -> None:
    """Raise if any key is unknown, with their number and the first `named` of them.

    `unknown_keys` has them all, as rows to reject.
    """
    with staging(rows.sparkSession):
        unknown = stage(unknown_keys(rows, known, on))
        count = unknown.count()
        names = [str(r[0]) for r in unknown.orderBy(on).limit(named).collect()] if count else []
    if count:
        more = f" and {count - len(names)} more" if count > len(names) else ""
        raise UnknownKeys(f"{count} unknown {on}: {', '.join(names)}{more}")


def missing_keys(required: DataFrame, listed: DataFrame, on: str) -> DataFrame:
    """Required keys that are not listed; empty if `listed` contains them all."""
    return pending_keys(required, listed, on)
