"""Constant audit columns of one run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Batch:
    """Identity of a run: one id and one time for all its rows, fixed when the run starts."""

    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    ingested_at: datetime = field(default_factory=utc_now)


def with_audit(rows: DataFrame, batch: Batch, **extra: Column | str | int) -> DataFrame:
    """Add `_batch_id`, `_ingested_at` and an underscored column for each extra value."""
    columns = {f"_{k}": v if isinstance(v, Column) else F.lit(v) for k, v in extra.items()}
    columns["_batch_id"] = F.lit(batch.batch_id)
    columns["_ingested_at"] = F.lit(batch.ingested_at)
    return rows.withColumns(columns)
