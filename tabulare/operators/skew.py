"""Keeping the rows of one busy key from landing in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulare.session import work_table


def same_keys(keys: list[str], prefix: str) -> Column:
    """Whether the keys equal those of a table whose key columns were given a prefix; null keys match."""
    return reduce(lambda a, b: a & b, (F.col(key).eqNullSafe(F.col(f"{prefix}{i}")) for i, key in enumerate(keys)))


def prefixed(keys: list[str], prefix: str) -> list[Column]:
    return [F.col(key).alias(f"{prefix}{i}") for i, key in enumerate(keys)]


def split_busy(df: DataFrame, keys: list[str], order: list[str], cell_rows: float) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with up to ``cell_rows`` rows, and those of all others cut into pieces, if there are any.

    The others get a column ``_cell``, which rises with the order of a key's
    rows. Their rows are cut where their number asks for it, by Spark's own
    range partitioning over keys and order: into ranges of half of
    ``cell_rows`` rows on average, whatever the values in between are. Rows
    without a time, or many in one second, are cut like others as long as the
    columns of ``order`` tell them apart. The ranges are written to the shared
    folder, so that a task that runs again finds them unchanged.

    Rows are counted per key when this is called; nothing but that count is
    computed early if no key is busy. A key is busy at most once for each
    ``cell_rows`` rows of the table; Spark chooses how to join that list, whose
    size it knows.
    """
    counted = df.groupBy(*prefixed(keys, "_k")).agg(F.count("*").alias("_rows")).where(F.col("_rows") > cell_rows)
    busy = work_table(counted, "busy")
    total = busy.agg(F.sum("_rows")).first()[0]
    if not total:
        return df, None
    listed = busy.drop("_rows")
    ranges = int(2 * total / max(cell_rows, 1)) + 1
    cut = (
        df.join(listed, same_keys(keys, "_k"), "left_semi")
        .repartitionByRange(ranges, *keys, *order)
        .withColumn("_cell", F.spark_partition_id())
    )
    return df.join(listed, same_keys(keys, "_k"), "left_anti"), work_table(cut, "cells")
