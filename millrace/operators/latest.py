"""The newest rows of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    rows: DataFrame,
    key: list[str],
    newest: str,
    tie_break: str,
    count: int,
    start: int = 0,
    where: Column | None = None,
) -> DataFrame:
    """Rows start+1 .. start+count of each key, newest first.

    Spark cuts every map task to start+count rows per key before the shuffle, so a hot key reaches
    its reducer as a short list per task. It does so only up to a threshold; above it the same cut
    is made per (key, salt) first, with as many salts as there are shuffle partitions. The salt is the
    partition number, which a rerun task keeps.
    """
    if where is not None:
        rows = rows.where(where)
    last = start + count
    threshold = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if last > threshold:
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
        rows = _ranked(salted, [*key, "_salt"], newest, tie_break).where(F.col("_rank") <= last)
        rows = rows.drop("_rank", "_salt")
    ranked = _ranked(rows, key, newest, tie_break).where(F.col("_rank") <= last)
    return ranked.where(F.col("_rank") > start).drop("_rank")


def _ranked(rows: DataFrame, key: list[str], newest: str, tie_break: str) -> DataFrame:
    order = [F.col(newest).desc(), F.col(tie_break).desc()]
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
