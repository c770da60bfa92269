"""Clock arithmetic in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(rows: DataFrame, column: str) -> Column:
    """Microseconds since 1970-01-01: of the instant, or of the wall clock for TIMESTAMP_NTZ."""
    if isinstance(rows.schema[column].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), F.col(column))
    return F.unix_micros(F.col(column).cast("timestamp"))


def floor_div(number: Column, width: int) -> Column:
    """Integer division that rounds down, also below zero."""
    return F.call_function("div", number - F.pmod(number, F.lit(width)), F.lit(width))


def epoch_millis(rows: DataFrame, column: str) -> Column:
    """Whole milliseconds since 1970-01-01, rounded down."""
    return floor_div(epoch_micros(rows, column), 1000)
