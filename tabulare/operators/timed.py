"""Time buckets, sessions and matches within a time interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulare.functions.times import seconds_interval, time_cell
from tabulare.operators.ordered import carry, joined, running_sums
from tabulare.operators.skew import split_busy


def time_buckets(
    df: DataFrame, time: str, keys: list[str], size: str, measures: dict[str, Column], slide: str | None = None
) -> DataFrame:
    """Measures per time bucket and group. Rows without a time are in no bucket."""
    return (
        df.groupBy(F.window(time, size, slide), *keys)
        .agg(*(measure.alias(name) for name, measure in measures.items()))
        .withColumn("bucket_start", F.col("window.start"))
        .select("bucket_start", *keys, *measures)
    )


def sessions(
    df: DataFrame, keys: list[str], time: str, gap_seconds: int, amount: Column, cell_rows: float = 5_000_000
) -> DataFrame:
    """Runs of rows per key in which no step is longer than the gap.

    Rows of one key in one cell as wide as the gap are always in one session,
    so they are first summed per cell. What a key then brings is bounded by the
    number of cells in the calendar, not by its number of rows. A key that
    still brings more than ``cell_rows`` of them, as it can with a short gap, is
    cut into pieces; busy keys are looked for when this is called.
    """
    pieces = (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, time_cell(df, time, gap_seconds).alias("_at"))
        .agg(
            F.min(time).alias("_first"),
            F.max(time).alias("_last"),
            F.count("*").alias("_rows"),
            F.sum(amount).alias("_amount"),
        )
    )
    split = split_busy(pieces, keys, ["_at"], cell_rows)
    split = carry(split, keys, ["_at"], F.max, {"_before": F.col("_last")}, itself=False)
    opens = F.when(F.col("_first") <= F.col("_before") + seconds_interval(gap_seconds), 0).otherwise(1)
    return (
        joined(carry(split, keys, ["_at"], F.sum, {"_session": opens}))
        .groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("session_end"),
            F.sum("_rows").alias("rows"),
            F.sum("_amount").alias("amount"),
        )
        .drop("_session")
    )


def interval_match(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    time: str,
    within_seconds: int,
    amount: Column,
    cell_rows: float = 5_000_000,
) -> DataFrame:
    """Each left row with the number and total amount of the right rows of its key that come after it,
    up to ``within_seconds`` later. Left rows without a time match none.

    No pair of rows is formed. A right row is within reach of a left row from
    the start of its interval on, and no longer from its own time on: it is
    added to a running sum at the one and taken off at the other. The sum at
    the time of a left row is its answer, so the work grows with the rows, even
    for a key that holds much of the table.
    """
    reach = F.array(
        F.struct((F.col(time) - seconds_interval(within_seconds)).alias("at"), F.lit(1).cast("bigint").alias("sign")),
        F.struct(F.col(time).alias("at"), F.lit(-1).cast("bigint").alias("sign")),
    )
    steps = (
        right.where(F.col(time).isNotNull())
        .select(*keys, F.coalesce(amount, F.lit(0)).alias("_amount"), F.explode(reach).alias("_step"))
        .select(
            *keys,
            F.col("_step.at").alias(time),
            F.lit(False).alias("_is_left"),
            F.col("_step.sign").alias("_rows"),
            (F.col("_amount") * F.col("_step.sign")).alias("_amount"),
        )
    )
    both = left.withColumn("_is_left", F.lit(True)).unionByName(steps, allowMissingColumns=True)
    # Which of the rows of one time comes first is of no matter, but a busy time can be cut between them.
    tie = F.xxhash64(*(F.struct(F.col(c)) for c in both.columns), F.monotonically_increasing_id())
    summed = running_sums(
        both.withColumn("_tie", tie),
        keys,
        [time, "_is_left", "_tie"],
        {"matches": F.coalesce("_rows", F.lit(0)), "matched_amount": F.coalesce("_amount", F.lit(0))},
        cell_rows,
    )
    return summed.where("_is_left").drop("_is_left", "_tie", "_rows", "_amount")
