"""The stream of buckets over several runs, and the partitioned export."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from tabulare.session import require_utc, run_folder, shared_folder
from tabulare.sources.exports import export_partitioned, read_export
from tabulare.sources.tables import read_table
from tabulare.streaming.buckets import append_to_files, file_stream, stream_buckets

SCHEMA = "id bigint, ts timestamp_ntz, kind string"


@pytest.fixture
def feed(spark, tmp_path):
    """Add a file of rows to the stream's folder, run to the end, and return all that was emitted."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run(*values):
        if values:
            rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=minutes), kind) for i, minutes, kind in values]
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = file_stream(spark, source, spark.createDataFrame([], SCHEMA).schema)
        buckets = stream_buckets(stream, "ts", ["kind"], "1 hour", "30 minutes", {"n": F.count("*"), "ids": F.sum("id")})
        append_to_files(buckets, out, state).awaitTermination()
        found = spark.read.schema(buckets.schema).parquet(out).collect()
        return sorted((row["bucket_start"].hour, row["kind"], row["n"], row["ids"]) for row in found)

    return run


def test_a_bucket_is_emitted_once_when_the_delay_has_passed(feed):
    assert feed((1, 5, "a"), (2, 50, "a"), (3, 50, "b")) == []
    assert feed((4, 55, "a"), (5, 89, "a")) == []  # the latest time is one minute short of the delay
    first = [(0, "a", 3, 7), (0, "b", 1, 3)]
    assert feed((6, 90, "a")) == first
    assert feed() == first


def test_rows_after_the_delay_are_dropped_and_rows_within_it_are_not(feed):
    feed((1, 5, "a"), (2, 100, "a"))
    late = [(0, "a", 1, 1)]
    assert feed((3, 10, "a"), (4, 70, "a"), (5, 95, "a")) == late  # 3 is late, 4 is in an open bucket
    assert feed((6, 170, "a")) == late + [(1, "a", 3, 11)]


def test_the_stream_equals_the_batch_whatever_the_number_of_files(spark, folder, tmp_path):
    events = read_table(spark, folder, "events").select("event_id", "ts", "event_type")
    source = str(tmp_path / "in")
    for week in range(5):
        part = events.where(F.floor((F.dayofmonth("ts") - 1) / 7) == week)
        part.orderBy("ts").coalesce(1).write.mode("append").parquet(source)
    stream = file_stream(spark, source, events.schema, max_files_per_trigger=1)
    buckets = stream_buckets(stream, "ts", ["event_type"], "1 hour", "1 hour", {"n": F.count("*")})
    append_to_files(buckets, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.schema(buckets.schema).parquet(str(tmp_path / "out"))
    last = events.agg(F.max("ts")).first()[0] - timedelta(hours=1)
    batch = (
        events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
        .where(F.col("w.end") <= F.lit(str(last)).cast("timestamp_ntz"))
        .select(F.col("w.start").alias("bucket_start"), "event_type", "n")
    )
    assert found.count() == batch.count() > 0
    assert found.exceptAll(batch).count() == 0


def test_streams_refuse_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_runs_share_a_folder_but_not_a_path(spark):
    first, second = run_folder(spark, "job"), run_folder(spark, "job")
    assert first != second and first.startswith(shared_folder(spark))


def test_export_reads_back_whole_and_prunes(spark, folder, tmp_path):
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    path = str(tmp_path / "export")
    export_partitioned(events, path, "day", F.col("ts").cast("date").cast("string"))
    back = read_export(spark, path, "event_id bigint, ts timestamp_ntz, value double, day string")
    assert back.drop("day").exceptAll(events).count() == 0 and back.count() == events.count()
    one = back.where("day = '2024-01-07'")
    assert "PartitionFilters: [isnotnull(day" in plan_of(one)
    assert len(list((tmp_path / "export").glob("day=*"))) == events.select(F.col("ts").cast("date")).distinct().count()
    assert one.where("CAST(ts AS DATE) <> DATE'2024-01-07'").count() == 0 < one.count()


def test_export_does_not_overwrite(spark, folder, tmp_path):
    events = read_table(spark, folder, "events").select("event_id", "ts")
    export_partitioned(events, str(tmp_path / "once"), "day", F.col("ts").cast("date"))
    with pytest.raises(Exception, match="already exists"):
        export_partitioned(events, str(tmp_path / "once"), "day", F.col("ts").cast("date"))


def test_export_keeps_rows_without_a_partition_value(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, g string")
    export_partitioned(rows, str(tmp_path / "nulls"), "part", F.col("g"))
    back = read_export(spark, str(tmp_path / "nulls"), "id int, g string, part string")
    assert sorted((row["id"], row["part"]) for row in back.collect()) == [(1, "a"), (2, None)]
