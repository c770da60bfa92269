"""Paged listings end at the first empty page."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def next_pages(pages: DataFrame, scope: list[str], page: str, empty: str) -> DataFrame:
    """(scope, page) still to be asked for: the one after the last page, unless an empty one has landed.

    `empty` is a boolean column that marks the answer that ends a scope's paging.
    """
    last = pages.groupBy(*scope).agg((F.max(page) + 1).alias(page), F.bool_or(empty).alias("_ended"))
    return last.where(~F.coalesce("_ended", F.lit(False))).drop("_ended")


def before_first_empty(
    pages: DataFrame, scope: list[str], page: str, empty_pages: DataFrame
) -> DataFrame:
    """Pages that come before the first empty one of their scope; all of them if none is empty.

    `empty_pages` holds scope and page number of the empty ones. The stop page per scope is a
    pre-aggregated minimum. It is staged, so that pages with large bodies are shuffled only if the
    scopes are too many to broadcast.
    """
    stops = stage(
        empty_pages.groupBy(*[F.col(c).alias(f"_stop_{c}") for c in scope])
        .agg(F.min(page).alias("_stop"))
    )
    same_scope = reduce(and_, (pages[c].eqNullSafe(stops[f"_stop_{c}"]) for c in scope))
    return (
        pages.join(stops, same_scope, "left")
        .where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
        .select(*[pages[c] for c in pages.columns])
    )
