"""Time buckets over a stream of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabulare.session import require_utc


def file_stream(
    spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files at ``path`` as a stream; new files are picked up by later runs.

    Without a limit all files that wait form one batch, in which no row is
    late. A limit keeps batches small, and then files should arrive in the
    order of their times: rows older than the watermark of an earlier batch
    are dropped.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_buckets(
    stream: DataFrame, time: str, keys: list[str], size: str, delay: str, measures: dict[str, Column]
) -> DataFrame:
    """Measures per time bucket and group of a stream.

    A bucket is emitted once, when the latest time seen is ``delay`` past its
    end. Rows that arrive after that are dropped. State holds one row per open
    bucket and group.
    """
    require_utc(stream.sparkSession)
    names = list(measures)
    return (
        stream.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, delay)
        .groupBy(F.window(time, size), *keys)
        .agg(*(measure.alias(name) for name, measure in measures.items()))
        .withColumn("bucket_start", F.col("window.start").cast("timestamp_ntz"))
        .select("bucket_start", *keys, *names)
    )


def append_to_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all that has arrived and append the finished buckets below ``path``.

    A run with the same checkpoint goes on where the last one stopped, also
    after a failure, and writes no bucket twice.
    """
    return (
        result.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
