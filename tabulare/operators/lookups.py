"""Joins of a table with its code lists and with its detail rows.

No join here carries a broadcast hint: Spark broadcasts a side only while its
size is below ``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joins it
otherwise, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_lookup(df: DataFrame, code: str, codes: DataFrame, codes_key: str, labels: dict[str, str]) -> DataFrame:
    """Attach the label columns of a code list; rows with an unknown code stay.

    ``labels`` maps columns of the code list to their names in the result. The
    code list must hold each code once.
    """
    picked = codes.select(
        F.col(codes_key).alias("_code"), *(F.col(source).alias(name) for source, name in labels.items())
    )
    return df.join(picked, F.col(code) == F.col("_code"), "left").drop("_code")


def detail_counts(
    parents: DataFrame, key: str, details: DataFrame, details_key: str, name: str = "details"
) -> DataFrame:
    """Each parent with the number of its detail rows, zero included.

    Details are counted per key before the join, so a parent with a great many
    of them adds one row per task to the shuffle.
    """
    counts = details.groupBy(F.col(details_key).alias("_key")).agg(F.count("*").alias("_details"))
    return (
        parents.join(counts, F.col(key) == F.col("_key"), "left")
        .withColumn(name, F.coalesce("_details", F.lit(0).cast("bigint")))
        .drop("_key", "_details")
    )


def parents_with_detail(parents: DataFrame, key: str, details: DataFrame, details_key: str) -> DataFrame:
    """Parents that have at least one detail row."""
    present = details.select(F.col(details_key).alias("_key")).distinct()
    return parents.join(present, F.col(key) == F.col("_key"), "left_semi")


def orphan_report(parents: DataFrame, key: str, details: DataFrame, details_key: str) -> DataFrame:
    """Parents without a detail row; a parent without a key is one of them."""
    present = details.select(F.col(details_key).alias("_key")).distinct()
    return parents.join(present, F.col(key) == F.col("_key"), "left_anti")
