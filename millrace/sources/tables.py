"""Tables: typed DDL, scans by name, and the insert-only write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merge import insert_only_merge
from millrace.session import staging


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def scan(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, with what other sessions have written since it was last read."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def ensure_table(
    spark: SparkSession,
    name: str,
    columns: str,
    partition_by: list[str] | None = None,
    bucket_by: tuple[list[str], int] | None = None,
) -> DataFrame:
    """Create the table unless it exists and return its scan.

    Buckets on the merge key let pending-key and merge joins read the table without a shuffle. Write
    to such a table, or to a partitioned one, with `rebalance_by`.
    """
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    buckets = ""
    if bucket_by:
        buckets = f" CLUSTERED BY ({', '.join(bucket_by[0])}) INTO {bucket_by[1]} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{buckets}")
    return scan(spark, name)


def append(rows: DataFrame, table: str) -> None:
    """Append by column name, as the table orders and types them."""
    target = rows.sparkSession.table(table)
    rows.selectExpr(*_as_in(target)).write.insertInto(table)


def merge_into(
    source: DataFrame,
    table: str,
    on: list[str],
    dedupe_by: list[str] | None = None,
    reject_null_keys: bool = False,
    batch_keys: DataFrame | None = None,
    rebalance_by: list[str] | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Insert the source rows whose key the table lacks; return how many were written.

    Rows are written by the tasks that read them, without a shuffle. `rebalance_by` shuffles them
    first, so that a bucket or partition is not spread over a file of every task; AQE sets the file
    sizes and splits hot values. `then` is what else is to be done to the rows that are new.

    The count is taken from the write itself. Parquet tables have no transactions: let one writer
    at a time merge into a table. A run that died may be repeated, as landed keys are skipped.
    """
    target = scan(source.sparkSession, table)
    with staging(source.sparkSession):
        inserts = insert_only_merge(source, target, on, dedupe_by, reject_null_keys, batch_keys).inserts
        if then is not None:
            inserts = then(inserts)
        if rebalance_by:
            inserts = inserts.hint("rebalance", *rebalance_by)
        return insert_counted(inserts, table)


def insert_counted(rows: DataFrame, table: str) -> int:
    """Append the rows by column name; return how many were written, as the write itself counts."""
    written = Observation()
    target = rows.sparkSession.table(table)
    counted = rows.selectExpr(*_as_in(target)).observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.insertInto(table)
    return written.get.get("rows") or 0


def _as_in(target: DataFrame) -> list[str]:
    return [f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in target.dtypes]
