"""Every job against its SQL counterpart on the given tables."""

import pytest

import __spark_entry__ as entry_points
from compare import assert_same, duck_rows, spark_rows
from tabulare.plans.jobs import JOBS as QUERIES
from tabulare.plans.oracles import ORACLES

# Spark type -> type the SQL engine names for the same column.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_job_equals_sql(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    expected = duck_rows(duck, ORACLES[name])
    assert sum(expected[1].values()) > 0
    assert_same(spark_rows(df), expected)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_types_equal_sql(spark, folder, duck, name):
    found = {field.name: TYPES[field.dataType.simpleString()] for field in QUERIES[name](spark, folder).schema}
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    expected = {row[0]: row[1] for row in described}
    assert found == expected


def test_every_job_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name, right, wrong",
    [
        ("indicator_table", "count(*) AS lines", "count(*) + 1 AS lines"),
        ("orphan_report", "NOT EXISTS", "EXISTS"),
        ("sessions", "INTERVAL 30 MINUTE", "INTERVAL 29 MINUTE"),
        ("interval_match", "f.ts > e.ts", "f.ts >= e.ts"),
        ("snapshot_diff", "'1-URGENT'", "'2-HIGH'"),
        ("clean_text", "lower", "upper"),
        ("dataset_page", "o_orderkey > 700", "o_orderkey >= 700 OR false"),
    ],
)
def test_broken_sql_is_noticed(spark, folder, duck, name, right, wrong):
    assert right in ORACLES[name]
    broken = ORACLES[name].replace(right, wrong)
    if name == "dataset_page":
        broken = broken.replace("LIMIT 50", "LIMIT 49")
    with pytest.raises(AssertionError):
        assert_same(spark_rows(QUERIES[name](spark, folder)), duck_rows(duck, broken))


@pytest.mark.parametrize(
    "name",
    ["filtered_rows", "indicator_table", "interval_match", "period_change", "running_total", "sessions", "time_buckets"],
)
def test_results_do_not_depend_on_the_session_zone(spark, folder, duck, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert_same(spark_rows(QUERIES[name](spark, folder)), duck_rows(duck, ORACLES[name]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"stream_buckets", "export_partitioned"}))
def test_results_do_not_depend_on_the_partitioning(spark, folder, duck, name):
    """More tasks per scan, more shuffle partitions and no broadcast joins give the same rows."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert_same(spark_rows(QUERIES[name](spark, folder)), duck_rows(duck, ORACLES[name]))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
