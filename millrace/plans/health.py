"""Health check: the layer schemas exist, and a table can be created, filled, read and dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.validate import missing_keys
from millrace.sources.tables import append, ensure_schema

LAYERS = ("bronze", "silver", "gold")


def declare_layers(spark: SparkSession, prefix: str = "", folder: str | None = None) -> None:
    """Create the layer schemas where they are missing. `prefix` may name a catalog: 'main.'."""
    for layer in LAYERS:
        ensure_schema(spark, prefix + layer, f"{folder}/{prefix}{layer}" if folder else None)


def listed_schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    of = f" IN {catalog}" if catalog else ""
    return spark.sql(f"SHOW SCHEMAS{of}").toDF("name")  # the column's name differs by setting


def missing_schemas(
    spark: SparkSession, required: list[str], catalog: str | None = None
) -> DataFrame:
    wanted = spark.createDataFrame([(name,) for name in required], "name string")
    return missing_keys(wanted, listed_schemas(spark, catalog), "name")


def require_schemas(spark: SparkSession, required: list[str], catalog: str | None = None) -> None:
    missing = sorted(r[0] for r in missing_schemas(spark, required, catalog).collect())
    if missing:
        raise RuntimeError(f"schemas not found: {', '.join(missing)}")


def roundtrip(spark: SparkSession, table: str, rows: DataFrame | None = None) -> int:
    """Create `table` anew, insert, count and drop it, also on failure. Returns the count.

    Without `rows` one literal row is inserted; fewer rows than one is an error.
    """
    columns = "id BIGINT, msg STRING"
    if rows is not None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")
        if rows is None:
            spark.sql(f"INSERT INTO {table} VALUES (1, 'smoke')")
        else:
            append(rows, table)
        count = spark.sql(f"SELECT COUNT(*) AS cnt FROM {table}").first()["cnt"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if count < 1:
        raise RuntimeError(f"{table}: expected at least 1 row, got {count}")
    return count


def health_check(spark: SparkSession, prefix: str = "", catalog: str | None = None) -> int:
    """Both checks. An error means that the workspace is not usable."""
    require_schemas(spark, [prefix + layer for layer in LAYERS], catalog)
    place = f"{catalog}.{prefix}" if catalog else prefix
    return roundtrip(spark, f"{place}bronze.smoke_test")
