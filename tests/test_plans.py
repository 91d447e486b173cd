"""What the plans read, move and avoid."""

import re

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from tabulare.operators import groups, lookups, ordered
from tabulare.plans.jobs import JOBS
from tabulare.sources.tables import read_table

LAZY = sorted(set(JOBS) - {"stream_buckets", "export_partitioned"})


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for sides too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_pairs(spark, folder, no_broadcast, name):
    plan = plan_of(JOBS[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "ArrowEval", "collect_"):
        assert operator not in plan


SINGLE_TASK = {"period_change", "column_profile"}  # over months, and over one line per column


@pytest.mark.parametrize("name", LAZY)
def test_no_table_goes_through_one_task(spark, folder, no_broadcast, name):
    assert ("SinglePartition" in plan_of(JOBS[name](spark, folder))) == (name in SINGLE_TASK)


READ = {
    "indicator_table": {
        "l_orderkey,l_extendedprice,l_discount", "o_orderkey,o_custkey,o_orderdate", "c_custkey,c_nationkey",
        "n_nationkey,n_name,n_regionkey", "r_regionkey,r_name",
    },
    "parents_with_detail": {"o_orderkey,o_custkey", "l_orderkey"},
    "detail_counts": {"o_orderkey,o_orderstatus", "l_orderkey"},
    "distinct_entities": {"user_id,event_type"},
    "sessions": {"ts,user_id,value"},
    "url_host": {"page_id,url"},
    "json_field": {"event_id,props"},
    "column_profile": {"event_id", "ts", "user_id", "event_type", "value", "props"},
    "median_by_group": {"event_type,_v,_n,_cell", "event_type,_n,_cell"},  # the ranges it has written
}


@pytest.mark.parametrize("name", sorted(READ))
def test_scans_read_only_the_columns_in_use(spark, folder, name):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan_of(JOBS[name](spark, folder)))
    assert {",".join(part.split(":")[0] for part in schema.split(",")) for schema in schemas} == READ[name]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("indicator_table", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00), LessThan(o_orderdate,1998-01-01T00:00)"),
        ("filtered_rows", "LessThan(l_shipdate,1998-01-01T00:00), In(l_returnflag, [A,R])"),
        ("dataset_page", "GreaterThanOrEqual(o_orderdate,1998-06-01T00:00)"),
        ("rows_in_both", "EqualTo(l_returnflag,R)"),
    ],
)
def test_filters_reach_the_scan(spark, folder, name, pushed):
    lines = [line for line in plan_of(JOBS[name](spark, folder)).splitlines() if "PushedFilters" in line]
    assert any(pushed in line for line in lines)


def exchanges(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan_of(df), re.MULTILINE))


@pytest.mark.parametrize(
    "name, expected",
    [
        ("filtered_rows", 0), ("dataset_page", 0), ("json_field", 0), ("clean_text", 0), ("stacked_rows", 0),
        ("crosstab", 1), ("time_buckets", 1), ("duplicate_keys", 1), ("latest_record", 1), ("top_per_group", 1),
        ("rows_only_in_first", 1), ("snapshot_diff", 1), ("distinct_entities", 2), ("sessions", 2),
        ("running_total", 1), ("indicator_table", 10), ("detail_counts", 2), ("parents_with_detail", 2), ("orphan_report", 2),
    ],
)
def test_number_of_shuffles(spark, folder, no_broadcast, name, expected):
    assert exchanges(JOBS[name](spark, folder)) == expected


def test_orders_move_once_by_customer(spark, folder, no_broadcast):
    plan = plan_of(JOBS["indicator_table"](spark, folder))
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert sum("o_custkey" in line for line in moved) == 1 and sum("l_orderkey" in line for line in moved) == 1


def test_page_is_cut_in_each_task(spark, folder):
    plan = plan_of(JOBS["dataset_page"](spark, folder))
    assert "TakeOrderedAndProject" in plan and "Sort" not in plan.replace("TakeOrderedAndProject", "")


def test_top_per_group_is_cut_before_the_shuffle(spark, folder):
    plan = plan_of(JOBS["top_per_group"](spark, folder))
    assert plan.count("WindowGroupLimit") >= 2


def test_details_are_reduced_before_the_shuffle(spark, folder, no_broadcast):
    """One hot parent key: its details leave each task as one row."""
    lineitem = read_table(spark, folder, "lineitem").withColumn("l_orderkey", F.lit(7).cast("bigint"))
    orders = read_table(spark, folder, "orders").select("o_orderkey")
    counts = lookups.detail_counts(orders, "o_orderkey", lineitem, "l_orderkey")
    assert counts.where("details > 0").collect() == [(7, lineitem.count())]
    assert re.search(r"partial_count", plan_of(counts).replace("Partial", "partial"))


def test_nothing_is_broadcast_by_hand_or_kept_on_one_machine():
    import pathlib

    import tabulare

    root = pathlib.Path(tabulare.__file__).parent
    sources = {path: path.read_text() for path in root.rglob("*.py") if "llm" not in path.relative_to(root).parts}
    for word in ("broadcast(", "localCheckpoint", ".rdd", "tempfile", "mkdtemp"):
        assert not [path for path, text in sources.items() if word in text], word


def test_counting_by_condition_beats_pivot_by_a_shuffle(spark, folder):
    events = read_table(spark, folder, "events")
    pivoted = events.groupBy("user_id").pivot("event_type", ["click", "view"]).count()
    assert exchanges(groups.crosstab(events, ["user_id"], "event_type", ["click", "view"])) < exchanges(pivoted)


def test_running_sums_without_a_busy_key_shuffle_once(spark, folder, no_broadcast):
    events = read_table(spark, folder, "events")
    sums = {"s": F.col("value")}
    assert exchanges(ordered.running_sums(events, ["user_id"], ["ts", "event_id"], sums)) == 1
    split = plan_of(ordered.running_sums(events, ["user_id"], ["ts", "event_id"], sums, cell_rows=20))
    last = [line for line in split.splitlines() if "hashpartitioning" in line][-1]
    assert "user_id" in last and "_cell" in last


def test_large_tops_are_cut_before_the_groups_meet(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    plan = plan_of(ordered.top_per_group(orders, ["o_custkey"], [F.col("o_orderkey")], 5_000))
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(moved) == 2 and "_share" in moved[0] and "_share" not in moved[1]


def test_lines_of_other_years_do_not_reach_the_shuffle(spark, folder, no_broadcast):
    """For inputs large enough to be worth it, which is made to be so here, the dated orders filter the scan of lines."""
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    }
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plan = plan_of(JOBS["indicator_table"](spark, folder))
    finally:
        for name in settings:
            spark.conf.unset(name)
    filters = [line for line in plan.splitlines() if "might_contain" in line and "l_orderkey" in line]
    assert filters
