"""The registered jobs: each wires published tables to one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulare.functions.money import cents, from_cents, total, wide
from tabulare.functions.text import clean_text, json_field, url_host
from tabulare.functions.times import day_label, month_label, month_start
from tabulare.operators import compare, groups, lookups, ordered, quality, rows, timed
from tabulare.plans import indicators
from tabulare.session import run_folder
from tabulare.sources.exports import export_partitioned, read_export
from tabulare.sources.tables import read_table, table_path, table_schema
from tabulare.streaming.buckets import append_to_files, file_stream
from tabulare.streaming.buckets import stream_buckets as bucket_stream

FILES_PER_BATCH = 256  # a failure repeats one batch, not all that has arrived
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def indicator_table(spark: SparkSession, folder: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "region")
    tables = (read_table(spark, folder, name) for name in names)
    return indicators.indicator_table(*tables, start="1997-01-01", end="1998-01-01")


def filtered_rows(spark: SparkSession, folder: str) -> DataFrame:
    found = rows.filtered_rows(
        read_table(spark, folder, "lineitem"), "l_shipdate", "1997-01-01", "1998-01-01", "l_returnflag", ["A", "R"]
    )
    return found.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
        day_label("l_shipdate").alias("ship_day"),
    )


def dataset_page(spark: SparkSession, folder: str) -> DataFrame:
    page = rows.dataset_page(
        read_table(spark, folder, "orders"), "o_orderdate", "o_orderkey", ("1998-06-01", 700), size=50
    )
    return page.select("o_orderkey", "o_custkey", day_label("o_orderdate").alias("order_day"), "o_totalprice")


def code_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nations = lookups.code_lookup(
        read_table(spark, folder, "nation"), "n_regionkey",
        read_table(spark, folder, "region"), "r_regionkey", {"r_name": "region"},
    )
    labelled = lookups.code_lookup(
        read_table(spark, folder, "customer"), "c_nationkey", nations, "n_nationkey",
        {"n_name": "nation", "region": "region"},
    )
    return labelled.select("c_custkey", "c_name", "nation", "region")


def detail_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return lookups.detail_counts(orders, "o_orderkey", read_table(spark, folder, "lineitem"), "l_orderkey", "lines")


def parents_with_detail(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lookups.parents_with_detail(orders, "o_orderkey", read_table(spark, folder, "lineitem"), "l_orderkey")


def orphan_report(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lookups.orphan_report(orders, "o_orderkey", read_table(spark, folder, "lineitem"), "l_orderkey")


def indicator_rollup(spark: SparkSession, folder: str) -> DataFrame:
    per_nation = read_table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("customers"), F.sum(wide(cents("c_acctbal"))).alias("balance")
    )
    nations = lookups.code_lookup(
        read_table(spark, folder, "nation"), "n_regionkey",
        read_table(spark, folder, "region"), "r_regionkey", {"r_name": "region"},
    )
    labelled = lookups.code_lookup(
        per_nation, "c_nationkey", nations, "n_nationkey", {"n_name": "nation", "region": "region"}
    )
    return groups.rollup_totals(
        labelled, ["region", "nation"],
        {"customers": F.sum("customers"), "balance": from_cents(F.sum("balance"))},
    )


def distinct_entities(spark: SparkSession, folder: str) -> DataFrame:
    return groups.distinct_entities(read_table(spark, folder, "events"), ["event_type"], "user_id")


def distinct_entities_approx(spark: SparkSession, folder: str) -> DataFrame:
    """The exact number of users per type, and whether the sketch's estimate is within its bound of it."""
    return groups.distinct_within_bound(read_table(spark, folder, "events"), ["event_type"], "user_id")


def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return groups.crosstab(read_table(spark, folder, "events"), ["user_id"], "event_type", EVENT_TYPES)


def median_by_group(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").withColumn("value", cents("value"))
    median = groups.median_by_group(events, ["event_type"], "value")
    return median.withColumn("median", from_cents(F.col("median")))


def top_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    largest_first = [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()]
    return ordered.top_per_group(orders, ["o_custkey"], largest_first, n=3)


def period_change(spark: SparkSession, folder: str) -> DataFrame:
    months = ordered.period_change(read_table(spark, folder, "orders"), month_start("o_orderdate"))
    return months.withColumn("period", month_label("period"))


def running_total(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    totals = ordered.running_sums(events, ["user_id"], ["ts", "event_id"], {"running_value": cents("value")})
    return totals.withColumn("running_value", from_cents(F.col("running_value")))


def latest_record(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return ordered.latest_record(events, ["user_id"], ["ts", "event_id"])


def time_buckets(spark: SparkSession, folder: str) -> DataFrame:
    measures = {"events": F.count("*"), "value": total("value")}
    return timed.time_buckets(read_table(spark, folder, "events"), "ts", ["event_type"], "1 hour", measures)


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    found = timed.sessions(read_table(spark, folder, "events"), ["user_id"], "ts", 1_800, cents("value"))
    return found.withColumn("amount", from_cents(F.col("amount")))


def interval_match(spark: SparkSession, folder: str) -> DataFrame:
    """Per event, the number and value of the same user's events in the hour after it."""
    events = read_table(spark, folder, "events")
    matched = timed.interval_match(
        events.select("event_id", "user_id", "ts"), events, ["user_id"], "ts", 3_600, cents("value")
    )
    return matched.withColumn("matched_amount", from_cents(F.col("matched_amount")))


def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("event_id", json_field("props", "$.k", "bigint").alias("k"))


def clean_texts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select("p_partkey", clean_text("p_name").alias("part_name"))


def url_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "pages").select("page_id", url_host("url").alias("host"))


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.column_profile(read_table(spark, folder, "events"), exact=True)


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def duplicate_text(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_text(read_table(spark, folder, "part"), "p_name", "p_partkey")


def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as published in mid-2001 against a later version: old ones archived, open urgent ones closed."""
    orders = read_table(spark, folder, "orders")
    old = orders.where(F.col("o_orderdate") < rows.literal_like(orders, "o_orderdate", "2001-06-01"))
    closed = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    new = orders.where(F.col("o_orderdate") >= rows.literal_like(orders, "o_orderdate", "1995-07-01")).withColumn(
        "o_orderstatus", F.when(closed, "F").otherwise(F.col("o_orderstatus"))
    )
    return compare.snapshot_diff(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice", "o_orderpriority"])


def rows_only_in_first(spark: SparkSession, folder: str) -> DataFrame:
    pairs = read_table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return compare.rows_only_in_first(
        pairs.where(F.col("l_returnflag") == "R").drop("l_returnflag"),
        pairs.where(F.col("l_returnflag") == "N").drop("l_returnflag"),
    )


def rows_in_both(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "lineitem").select("l_partkey", "l_returnflag")
    return compare.rows_in_both(
        parts.where(F.col("l_returnflag") == "R").drop("l_returnflag"),
        parts.where(F.col("l_returnflag") == "N").drop("l_returnflag"),
    )


def stacked_rows(spark: SparkSession, folder: str) -> DataFrame:
    def codes(table: str, prefix: str) -> DataFrame:
        return read_table(spark, folder, table).select(
            F.lit(table).alias("code_list"),
            F.col(f"{prefix}_{table}key").cast("bigint").alias("code"),
            F.col(f"{prefix}_name").alias("label"),
        )

    return rows.stacked_rows(codes("region", "r"), codes("nation", "n"))


def stream_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The finished buckets. Not lazy: the stream runs when this is called.

    Buckets that may still get rows are held back until a later run has seen
    times past their end and the delay: the last ones of the feed are not here.
    """
    base = run_folder(spark, "stream_buckets")
    measures = {"events": F.count("*"), "value": total("value")}
    # Braces make it a pattern: a stream takes a folder or a pattern, not the path of one file.
    stream = file_stream(
        spark, table_path(folder, "{events}"), table_schema("events"), max_files_per_trigger=FILES_PER_BATCH
    )
    buckets = bucket_stream(stream, "ts", ["event_type"], "1 hour", "1 hour", measures)
    append_to_files(buckets, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema(buckets.schema).parquet(f"{base}/out")


def export_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """The export, read back. Not lazy: it is written when this is called."""
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    path = f"{run_folder(spark, 'export_partitioned')}/out"
    export_partitioned(events, path, "day", day_label("ts"))
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double, day string"
    return read_export(spark, path, schema)


JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "indicator_table": indicator_table,
    "filtered_rows": filtered_rows,
    "dataset_page": dataset_page,
    "code_lookup": code_lookup,
    "detail_counts": detail_counts,
    "parents_with_detail": parents_with_detail,
    "orphan_report": orphan_report,
    "indicator_rollup": indicator_rollup,
    "distinct_entities": distinct_entities,
    "distinct_entities_approx": distinct_entities_approx,
    "crosstab": crosstab,
    "median_by_group": median_by_group,
    "top_per_group": top_per_group,
    "period_change": period_change,
    "running_total": running_total,
    "latest_record": latest_record,
    "time_buckets": time_buckets,
    "sessions": sessions,
    "interval_match": interval_match,
    "json_field": json_fields,
    "clean_text": clean_texts,
    "url_host": url_hosts,
    "column_profile": column_profile,
    "duplicate_keys": duplicate_keys,
    "duplicate_text": duplicate_text,
    "snapshot_diff": snapshot_diff,
    "rows_only_in_first": rows_only_in_first,
    "rows_in_both": rows_in_both,
    "stacked_rows": stacked_rows,
    "stream_buckets": stream_buckets,
    "export_partitioned": export_by_day,
}
