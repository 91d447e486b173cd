"""Time arithmetic that gives the same answer in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970 of a zoned or zone-less time column."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, TimestampType):
        return F.unix_seconds(col)
    day = F.unix_date(col.cast("date")).cast("bigint")
    return day * 86_400 + F.hour(col) * 3_600 + F.minute(col) * 60 + F.second(col)


def time_cell(df: DataFrame, column: str, seconds: int) -> Column:
    """Start, in epoch seconds, of the fixed-width cell that holds the time."""
    if seconds < 1:
        raise ValueError("a time cell must be at least one second wide")
    at = epoch_seconds(df, column)
    return at - F.pmod(at, F.lit(seconds))


def seconds_interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def month_start(column: str) -> Column:
    """First day of the month of a date or time column."""
    return F.trunc(F.col(column).cast("date"), "month")


def month_label(column: str) -> Column:
    """``yyyy-MM`` of a date column."""
    return F.substring(F.col(column).cast("string"), 1, 7)


def day_label(column: str) -> Column:
    """``yyyy-MM-dd`` of a date or time column."""
    return F.col(column).cast("date").cast("string")
