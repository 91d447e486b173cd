"""Consecutive numbers for the rows of a table in a given order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulare.session import work_table


def numbered(rows: DataFrame, order: list[str], name: str = "_place") -> DataFrame:
    """``rows``, written by ranges of ``order``, with one more column: the place of each row from 0 on.

    A range's rows are numbered in one task, after the numbers of rows in the
    ranges before, of which there are as many as there are partitions. Rows that
    agree in all columns of the order are spread over ranges too, in any order.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = work_table(tied.repartitionByRange(*order, "_tie").withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(F.col("_part").alias("_p")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = work_table(sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_before")), "offsets")
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_tie"))
    return (
        ranged.withColumn("_n_in_part", number)
        .join(offsets, F.col("_part") == F.col("_p"))
        .withColumn(name, F.col("_before") + F.col("_n_in_part") - 1)
        .drop("_tie", "_part", "_p", "_before", "_n_in_part")
    )
