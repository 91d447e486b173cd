"""Ranks, changes, running totals and latest records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulare.operators.skew import split_busy

CUT_IN_TASKS = 1_000  # rows per group up to which Spark cuts groups in its input tasks
SHARES = 64


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1. ``order`` must end with a unique key.

    Up to ``CUT_IN_TASKS`` rows Spark cuts each group to ``n`` rows in every
    input task, before the shuffle. For more, each group is dealt to ``SHARES``
    shares and cut to ``n`` rows in each, and then to ``n`` of what is left.
    """
    if n < 1:
        raise ValueError("at least one row per group must be asked for")
    if n > CUT_IN_TASKS:
        share = F.pmod(F.xxhash64(*(F.struct(F.col(c)) for c in df.columns)), F.lit(SHARES))
        in_share = Window.partitionBy(*keys, "_share").orderBy(*order)
        df = (
            df.withColumn("_share", share)
            .withColumn("_n", F.row_number().over(in_share))
            .where(F.col("_n") <= n)
            .drop("_share", "_n")
        )
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= n)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def period_change(df: DataFrame, period: Column, keys: list[str] | None = None) -> DataFrame:
    """Rows per period, with the count of the period before that has rows and the change from it.

    The window runs over one row per period, never over the input rows.
    """
    keys = keys or []
    counts = df.groupBy(*keys, period.alias("period")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy(*keys).orderBy("period")
    return counts.withColumn("previous", F.lag("rows").over(before)).withColumn(
        "change", F.col("rows") - F.col("previous")
    )


def carry(
    split: tuple[DataFrame, DataFrame | None],
    keys: list[str],
    order: list[str],
    function: Callable[[str], Column],
    values: dict[str, Column],
    itself: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """A running sum or extreme of each value per key in the given order, over the rows before and the row itself.

    ``split`` is what ``split_busy`` returns, and so is the result. The result
    of each piece of a busy key is carried to those after it, and the rows are
    then taken one (key, piece) at a time, with what is carried as the first
    row. So a key that holds much of the table is spread over as many tasks as
    it needs.
    """
    plain, cut = split
    last = 0 if itself else -1
    inputs = {f"_in_{name}": value for name, value in values.items()}
    in_order = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    found = plain.withColumns(inputs).withColumns({name: function(f"_in_{name}").over(in_order) for name in values})
    if cut is None:
        return found.drop(*inputs), None
    parts = cut.withColumns(inputs)
    cells = parts.groupBy(*keys, "_cell").agg(*(function(name).alias(name) for name in inputs))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.withColumns({name: function(name).over(earlier) for name in inputs})
    both = parts.withColumn("_is_row", F.lit(True)).unionByName(
        carried.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
    )
    in_cell = Window.partitionBy(*keys, "_cell").orderBy("_is_row", *order).rowsBetween(Window.unboundedPreceding, last)
    pieces = both.withColumns({name: function(f"_in_{name}").over(in_cell) for name in values}).where("_is_row")
    return found.drop(*inputs), pieces.drop("_is_row", *inputs)


def joined(split: tuple[DataFrame, DataFrame | None]) -> DataFrame:
    """All rows again, without the pieces they were in."""
    plain, cut = split
    return plain if cut is None else plain.unionByName(cut.drop("_cell"))


def running_sums(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], cell_rows: float = 5_000_000
) -> DataFrame:
    """Running sums per key in the given order, which must end with a unique key. Busy keys are looked for when called."""
    return joined(carry(split_busy(df, keys, order, cell_rows), keys, order, F.sum, sums))


def latest_record(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each group by ``order``, which must end with a unique key."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")
