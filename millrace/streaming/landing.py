"""The same landing and merge for responses that keep arriving as files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.schemas import RESPONSE_LOG
from millrace.session import staging
from millrace.sources.tables import merge_into


def merge_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    on: list[str],
    land: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    files_per_trigger: int | None = None,
    reject_null_keys: bool = False,
) -> StreamingQuery:
    """Merge every response file not yet taken in, then stop.

    `land` turns a response log into rows of `table`. A micro-batch that is repeated after a failure
    inserts nothing twice, as its keys are known by then. Rows with a NULL key are never known: they are
    kept, as by a batch run, and again if a micro-batch is repeated, unless `reject_null_keys` is set.
    """
    reader = spark.readStream.schema(RESPONSE_LOG)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def merge(batch: DataFrame, _: int) -> None:
        with staging(spark):
            merge_into(land(batch), table, on, reject_null_keys=reject_null_keys)

    return (
        reader.json(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
