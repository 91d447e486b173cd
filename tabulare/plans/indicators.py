"""The flagship indicator table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulare.functions.money import discounted, from_discounted, wide
from tabulare.functions.times import month_label, month_start
from tabulare.operators.rows import literal_like


def indicator_table(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame, start, end
) -> DataFrame:
    """Revenue, lines and orders by region, nation and month of the orders dated ``start`` to before ``end``.

    Lines are summed to one row per order in the tasks that read them, orders
    to one row per nation and month. Where the lines are many and the period is
    selective, Spark cuts the lines of other orders before that shuffle with a
    filter made from the dated orders. A hot customer's orders are split by
    adaptive execution. ``o_orderkey`` and ``c_custkey`` must be unique; an
    order counts if it has lines.
    """
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(wide(discounted("l_extendedprice", "l_discount"))).alias("revenue"), F.count("*").alias("lines")
    )
    in_period = orders.where(
        (F.col("o_orderdate") >= literal_like(orders, "o_orderdate", start))
        & (F.col("o_orderdate") < literal_like(orders, "o_orderdate", end))
    ).select("o_orderkey", "o_custkey", month_start("o_orderdate").alias("month"))
    per_nation = (
        per_order.join(in_period, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "month")
        .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.count("*").alias("orders"))
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    return (
        per_nation.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("region", "nation", "month")
        .agg(
            from_discounted(F.sum("revenue")).alias("revenue"),
            F.sum("lines").alias("lines"),
            F.sum("orders").alias("orders"),
        )
        .withColumn("month", month_label("month"))
    )
