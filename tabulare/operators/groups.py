"""Grouped summaries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from tabulare.operators.skew import prefixed, same_keys
from tabulare.session import work_table


def rollup_totals(df: DataFrame, levels: list[str], measures: dict[str, Column]) -> DataFrame:
    """Totals for each level of a hierarchy, with a 0/1 flag per level: 1 where it is summed over.

    The measures are expressions over rows that should already be grouped to
    the finest level: a rollup copies each input row once per level.
    """
    flags = [F.grouping(level).cast("bigint").alias(f"{level}_is_total") for level in levels]
    return df.rollup(*levels).agg(*(measure.alias(name) for name, measure in measures.items()), *flags)


def distinct_entities(df: DataFrame, keys: list[str], entity: str) -> DataFrame:
    """Exact number of different entities per group.

    Spark reduces to distinct (group, entity) pairs, spread by both, before it
    counts, so a hot group is not held by one task.
    """
    return df.groupBy(*keys).agg(F.count_distinct(entity).alias("entities"))


def distinct_entities_approx(df: DataFrame, keys: list[str], entity: str, error: float = 0.02) -> DataFrame:
    """The same from one fixed-size sketch per group and task, within a relative error."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(entity, error).alias("entities"))


def distinct_within_bound(df: DataFrame, keys: list[str], entity: str, error: float = 0.02) -> DataFrame:
    """The exact number per group, and whether the sketch's is within three times its relative error of it.

    Rows are reduced to distinct (group, entity) pairs first. Next to a distinct
    count Spark would keep a sketch for each pair; so there is one per group and task.
    """
    exact, near = F.count(entity), F.approx_count_distinct(entity, error)
    within = F.abs(F.col("_near") - F.col("entities")) <= F.col("entities") * (3 * error)
    return (
        df.select(*keys, entity)
        .distinct()
        .groupBy(*keys)
        .agg(exact.alias("entities"), near.alias("_near"))
        .withColumn("within_bound", within)
        .drop("_near")
    )


def crosstab(df: DataFrame, rows: list[str], column: str, values: list[str], other: str = "other") -> DataFrame:
    """Number of rows per group with one column for each listed value, zero where there is none, and one for the rest.

    Rows with a value that is not listed, or none, are counted as ``other``, so
    that the columns of a group add up to its rows. Counting by condition needs
    one shuffle of partial counts; ``pivot`` groups by the category first and
    so needs two.
    """
    if other in values:
        raise ValueError(f"{other} is a listed value; name the column of the rest differently")
    listed = F.coalesce(F.col(column).isin(values), F.lit(False))
    return df.groupBy(*rows).agg(
        *(F.count_if(F.col(column) == value).alias(value) for value in values), F.count_if(~listed).alias(other)
    )


def median_by_group(df: DataFrame, keys: list[str], value: str, ranges: int | None = None) -> DataFrame:
    """Exact median per group, nulls ignored, without holding a group in one task.

    Different values are counted, and what is left is cut into ``ranges`` of
    keys and values, as many as there are shuffle partitions if not said
    otherwise. The ranges hold equally many values, however these are spread.
    Sums per range tell which one holds the middle ranks of a group, and only
    its values are ordered. The ranges are written to the shared folder when
    this is called, so that a task that runs again finds them unchanged.

    The mean of two whole numbers or decimals is a decimal, and exact.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (
        df.where(F.col(value).isNotNull())
        .select(*keys, F.col(value).alias("_v"))
        .groupBy(*keys, "_v")
        .agg(F.count("*").alias("_n"))
    )
    cells = work_table(
        counted.repartitionByRange(ranges, *keys, "_v").withColumn("_cell", F.spark_partition_id()), "median"
    )
    upward = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    middle_ranks = F.array_distinct(F.array(F.expr("(_all + 1) div 2"), F.expr("_all div 2 + 1")))
    holding = (
        cells.groupBy(*keys, "_cell")
        .agg(F.sum("_n").alias("_in"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_in").over(upward), F.lit(0)),
                "_all": F.sum("_in").over(Window.partitionBy(*keys)),
            }
        )
        .withColumn("_ranks", F.filter(middle_ranks, lambda r: r.between(F.col("_before") + 1, F.col("_before") + F.col("_in"))))
        .where(F.size("_ranks") > 0)
        .select(*prefixed(keys, "_k"), F.col("_cell").alias("_held"), "_before", "_ranks")
    )
    matched = same_keys(keys, "_k") & (F.col("_cell") == F.col("_held")) if keys else F.col("_cell") == F.col("_held")
    by_value = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        cells.join(holding, matched)
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(by_value))
        .where(F.exists("_ranks", lambda r: (r > F.col("_upto") - F.col("_n")) & (r <= F.col("_upto"))))
        .groupBy(*keys)
        .agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    return found.select(*keys, _mean(df.schema[value].dataType).alias("median"))


def _mean(kind: DataType) -> Column:
    """The mean of the two middle values: exact where the type allows, and the value itself where both are equal."""
    low, high = F.col("_low"), F.col("_high")
    if isinstance(kind, (FloatType, DoubleType)):
        low, high = low.cast("double"), high.cast("double")
        return F.when(low.eqNullSafe(high), low).when(F.abs(low) + F.abs(high) < 1e308, (low + high) / 2).otherwise(
            low / 2 + high / 2
        )
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    wide = f"decimal(38,{scale + 1})"
    return ((low.cast(wide) + high.cast(wide)) * F.lit(Decimal("0.5"))).cast(wide)
