"""Which keys are still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def distinct_keys(rows: DataFrame, on: str | list[str], where: Column | None = None) -> DataFrame:
    """Distinct keys of the rows that pass `where`. Only the key and filter columns are read."""
    if where is not None:
        rows = rows.where(where)
    return rows.select(*_names(on)).distinct()


def pending_keys(
    keys: DataFrame, landed: DataFrame, on: str | list[str], where: Column | None = None
) -> DataFrame:
    """Distinct keys of `keys` that `landed` does not have yet. NULL keys never match, so they stay.

    Both sides are made distinct before the join: copies of a hot key collapse inside each map task,
    and the shuffle of the aggregate is the one the join needs, so there is no extra exchange.
    """
    on = _names(on)
    return distinct_keys(keys, on, where).join(distinct_keys(landed, on), on, "left_anti")


def _names(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)
