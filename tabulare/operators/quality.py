"""Reports on the state of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulare.operators.rows import stacked_rows


def column_profile(df: DataFrame, exact: bool = False, error: float = 0.02) -> DataFrame:
    """One row per column: rows, nulls, different values, least and greatest value as text.

    By default a single pass with sketches. With ``exact`` each column is read
    and reduced to its distinct values on its own, which moves every column
    once; exact counts in a single pass would copy each row once per column.
    """
    return _profile_exact(df) if exact else _profile_approx(df, error)


def _profile_approx(df: DataFrame, error: float) -> DataFrame:
    measures = []
    for i, name in enumerate(df.columns):
        col = F.col(name)
        measures += [
            F.count("*").alias(f"rows_{i}"),
            F.count_if(col.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(col, error).alias(f"distinct_{i}"),
            F.min(col).cast("string").alias(f"least_{i}"),
            F.max(col).cast("string").alias(f"greatest_{i}"),
        ]
    lines = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"rows_{i}").alias("rows"),
                F.col(f"nulls_{i}").alias("nulls"),
                F.col(f"distinct_{i}").alias("distinct_values"),
                F.col(f"least_{i}").alias("least"),
                F.col(f"greatest_{i}").alias("greatest"),
            )
            for i, name in enumerate(df.columns)
        )
    )
    return df.agg(*measures).select(F.inline(lines))


def _profile_exact(df: DataFrame) -> DataFrame:
    def one(name: str) -> DataFrame:
        values = df.groupBy(F.col(name).alias("_v")).agg(F.count("*").alias("_n"))
        return values.agg(
            F.lit(name).alias("column_name"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
            F.count("_v").alias("distinct_values"),
            F.min("_v").cast("string").alias("least"),
            F.max("_v").cast("string").alias("greatest"),
        )

    return stacked_rows(*(one(name) for name in df.columns))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def duplicate_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """Texts that several rows share, with the number of rows and the least key among them."""
    return (
        df.where(F.col(text).isNotNull())
        .groupBy(text)
        .agg(F.count("*").alias("rows"), F.min(key).alias("first_key"))
        .where(F.col("rows") > 1)
    )


def inexact_amounts(df: DataFrame, columns: list[str], decimals: int = 2) -> DataFrame:
    """Per column the number of amounts with more than ``decimals`` decimals, which sums in whole units would round."""
    scale = 10**decimals

    def inexact(column: str) -> Column:
        scaled = F.col(column).cast("double") * scale
        # A double with the decimals is off by its own spacing at most.
        return F.abs(scaled - F.rint(scaled)) > F.greatest(F.abs(scaled) * 4e-16, F.lit(1e-9))

    counts = df.agg(*(F.count_if(inexact(c)).alias(f"_{i}") for i, c in enumerate(columns)))
    lines = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("rows")) for i, c in enumerate(columns)))
    return counts.select(F.inline(lines))
