"""Reading the published tables, with a check of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def check_schema(df: DataFrame, expected: StructType, name: str) -> DataFrame:
    """Fail before any job starts when a column is missing or has another type."""
    found = {field.name: field.dataType for field in df.schema.fields}
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'no such column'}"
        for field in expected.fields
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError(f"table {name} does not have the published columns: {'; '.join(wrong)}")
    return df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return check_schema(spark.read.parquet(table_path(folder, name)), table_schema(name), name)
