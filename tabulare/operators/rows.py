"""Selecting, paging and stacking rows. None of these moves data between tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_like(df: DataFrame, column: str, value) -> Column:
    """``value`` in the type of ``column``, so that the comparison reaches the scan."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def filtered_rows(df: DataFrame, date: str, start, end, code: str, codes: list) -> DataFrame:
    """Rows with ``start <= date < end`` whose code is listed."""
    return df.where(
        (F.col(date) >= literal_like(df, date, start))
        & (F.col(date) < literal_like(df, date, end))
        & F.col(code).isin(codes)
    )


def dataset_page(df: DataFrame, value: str, key: str, after: tuple | None, size: int) -> DataFrame:
    """The ``size`` rows that follow the position ``after`` in order of value, then key.

    ``after`` is the (value, key) of the last row already seen, or ``None`` for
    the first page. Rows without a value come last. ``key`` must be unique.
    Each task hands on at most one page to the task that merges them.
    """
    if size < 1:
        raise ValueError("a page must have at least one row")
    if after is not None:
        last_value, last_key = after
        beyond_key = F.col(key) > literal_like(df, key, last_key)
        if last_value is None:
            df = df.where(F.col(value).isNull() & beyond_key)
        else:
            last = literal_like(df, value, last_value)
            at_or_beyond = F.col(value).isNull() | (F.col(value) >= last)
            beyond = F.col(value).isNull() | (F.col(value) > last) | beyond_key
            df = df.where(at_or_beyond & beyond)
    return df.orderBy(F.col(value).asc_nulls_last(), F.col(key).asc()).limit(size)


def stacked_rows(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, repeats included; columns are matched by name."""
    return reduce(lambda upper, lower: upper.unionByName(lower), tables)
