"""Writing a table as one folder per partition value, and reading it back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def export_partitioned(
    df: DataFrame, path: str, name: str, value: Column, max_records_per_file: int = 5_000_000
) -> None:
    """Write ``df`` below ``path`` in one folder per ``value``, in a column called ``name``.

    The rebalance hint groups rows by that value so that a folder gets few
    files, and lets adaptive execution split a value that holds too many rows
    for one task. An existing path is left alone and raises.
    """
    (
        df.withColumn(name, value)
        .hint("rebalance", F.col(name))
        .write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(name)
        .parquet(path)
    )


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read an export with a stated schema, so that no partition value is guessed."""
    return spark.read.schema(schema).parquet(path)
