"""Readers for landed responses and for the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import RESPONSE_LOG


def read_response_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in the form of RESPONSE_LOG, with the body as a string.

    A line that is cut off or no JSON is kept in `_corrupt_record`, with NULL in all other columns; see
    `torn_lines`. Columns that the folder's partitions give are taken from there.
    """
    return parse_lines(spark.read.text(path))


def parse_lines(lines: DataFrame) -> DataFrame:
    """RESPONSE_LOG and `_corrupt_record` from lines (value, …); other columns of these names take part as they are."""
    lines = lines.where(r"value RLIKE '\\S'")
    schema = f"{RESPONSE_LOG}, _corrupt_record STRING"
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.select("*", F.explode(F.array(parsed)).alias("_row"))
    torn = F.col("_row").isNull() | F.col("_row._corrupt_record").isNotNull()
    columns = []
    for name in (c.split()[0] for c in RESPONSE_LOG.split(", ")):
        found = F.col(name) if name in lines.columns else F.col(f"_row.{name}")
        columns.append(F.when(~torn, found).alias(name))
    return rows.select(*columns, F.when(torn, F.col("value")).alias("_corrupt_record"))


def torn_lines(log: DataFrame) -> DataFrame:
    """(line): what `read_response_log` could not read. None in a log without `_corrupt_record`."""
    if "_corrupt_record" not in log.columns:
        return log.sparkSession.range(0).select(F.lit(None).cast("string").alias("line"))
    return log.where("_corrupt_record IS NOT NULL").select(F.col("_corrupt_record").alias("line"))


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row (key, body) per file: the key is the file name without its ending.

    A file is read whole by one task, as one response is one document.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    key = F.url_decode(F.regexp_replace(name, r"\.[^.]*$", ""))
    return spark.read.text(path, wholetext=True).select(key.alias("key"), F.col("value").alias("body"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table kept as one parquet file or folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
