"""Comparing two tables.

Both tables are stacked and grouped once. Grouping treats nulls as equal,
reduces repeats before the shuffle and forms no pairs, which a join on
repeated keys would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """Keys that were added, removed or changed between two snapshots, with the changed columns.

    A key that a snapshot holds more than once is reported as ``repeated``,
    because its rows cannot be told apart.
    """

    def side(df: DataFrame, is_old: bool) -> DataFrame:
        return df.select(*keys, F.struct(*compared).alias("_row"), F.lit(is_old).alias("_is_old"))

    is_old = F.col("_is_old")
    grouped = (
        side(old, True)
        .unionByName(side(new, False))
        .groupBy(*keys)
        .agg(
            F.count_if(is_old).alias("_olds"),
            F.count_if(~is_old).alias("_news"),
            F.max(F.when(is_old, F.col("_row"))).alias("_old"),
            F.max(F.when(~is_old, F.col("_row"))).alias("_new"),
        )
    )

    def differs(column: str) -> Column:
        return ~F.col(f"_old.{column}").eqNullSafe(F.col(f"_new.{column}"))

    change = (
        F.when((F.col("_olds") > 1) | (F.col("_news") > 1), "repeated")
        .when(F.col("_olds") == 0, "added")
        .when(F.col("_news") == 0, "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    changed = F.concat_ws(",", *(F.when(differs(c), F.lit(c)) for c in compared))
    return (
        grouped.withColumn("change", change)
        .where(F.col("change").isNotNull())
        .withColumn("changed_columns", F.when(F.col("change") == "changed", changed).otherwise(""))
        .select(*keys, "change", "changed_columns")
    )


def _membership(first: DataFrame, second: DataFrame) -> DataFrame:
    both = first.withColumn("_first", F.lit(True)).unionByName(second.withColumn("_first", F.lit(False)))
    return both.groupBy(*first.columns).agg(
        F.bool_or("_first").alias("_in_first"), F.bool_or(~F.col("_first")).alias("_in_second")
    )


def rows_only_in_first(first: DataFrame, second: DataFrame) -> DataFrame:
    """Different rows of the first table that the second does not hold (set difference)."""
    return _membership(first, second).where("_in_first AND NOT _in_second").drop("_in_first", "_in_second")


def rows_in_both(first: DataFrame, second: DataFrame) -> DataFrame:
    """Different rows that both tables hold (set intersection)."""
    return _membership(first, second).where("_in_first AND _in_second").drop("_in_first", "_in_second")
