"""Operators against plain Python on random small groups, and against Spark's own operators on a hot key."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulare.functions.money import cents
from tabulare.operators import compare, groups, ordered, timed
from tabulare.operators.skew import split_busy

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def steps():
    """300 groups of up to 12 rows with many equal times, exact gaps and equal values."""
    chance = random.Random(7)
    rows, number = [], 0
    for key in range(300):
        time = START
        for _ in range(chance.randint(1, 12)):
            time += timedelta(seconds=chance.choice([0, 0, 1, 59, 60, 61, 599, 600, 601, 4_000]))
            number += 1
            rows.append((number, key, time, chance.randint(-3, 3)))
    return rows


@pytest.fixture(scope="module")
def stepped(spark, steps):
    return spark.createDataFrame(steps, "id bigint, u bigint, t timestamp_ntz, v bigint").repartition(8, "v").cache()


def by_key(rows):
    grouped = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        grouped[row[1]].append(row)
    return grouped


# The number of rows from which a key is split: all by the second, some by a wider step, none.
CELL_ROWS = [0, 1, 5, 100]


@pytest.mark.parametrize("cell_rows", CELL_ROWS)
def test_running_sums(stepped, steps, cell_rows):
    expected = {}
    for group in by_key(steps).values():
        so_far = 0
        for row in group:
            so_far += row[3]
            expected[row[0]] = so_far
    found = ordered.running_sums(stepped, ["u"], ["t", "id"], {"s": F.col("v")}, cell_rows).collect()
    assert {row["id"]: row["s"] for row in found} == expected and len(found) == len(steps)


def test_sessions(stepped, steps):
    expected = []
    for key, group in by_key(steps).items():
        run = [group[0]]
        for row in group[1:]:
            if row[2] - run[-1][2] > timedelta(seconds=600):
                expected.append((key, run[0][2], run[-1][2], len(run), sum(r[3] for r in run)))
                run = []
            run.append(row)
        expected.append((key, run[0][2], run[-1][2], len(run), sum(r[3] for r in run)))
    found = timed.sessions(stepped, ["u"], "t", 600, F.col("v"))
    columns = ["u", "session_start", "session_end", "rows", "amount"]
    assert sorted(tuple(row[c] for c in columns) for row in found.collect()) == sorted(expected)


@pytest.mark.parametrize("cell_rows", CELL_ROWS)
def test_interval_match(stepped, steps, cell_rows):
    left = [row for row in steps if row[3] <= 0]
    right = by_key([row for row in steps if row[3] >= 0])
    hour = timedelta(seconds=600)
    expected = {}
    for row in left:
        later = [r for r in right.get(row[1], []) if row[2] < r[2] <= row[2] + hour]
        expected[row[0]] = (len(later), sum(r[3] for r in later))
    found = timed.interval_match(
        stepped.where("v <= 0"), stepped.where("v >= 0"), ["u"], "t", 600, F.col("v"), cell_rows
    )
    assert {row["id"]: (row["matches"], row["matched_amount"]) for row in found.collect()} == expected


@pytest.mark.parametrize("ranges", [1, 2, 3, 50])
def test_median(stepped, steps, ranges):
    from statistics import median

    values = defaultdict(list)
    for row in steps:
        values[row[1]].append(row[3])
    found = groups.median_by_group(stepped, ["u"], "v", ranges).collect()
    assert {row["u"]: row["median"] for row in found} == {key: median(vs) for key, vs in values.items()}


@pytest.mark.parametrize("ranges", [1, 7, 50])
def test_median_of_values_of_very_different_size(spark, ranges):
    from statistics import median

    chance = random.Random(11)
    rows = []
    for key in range(200):
        centre, spread = chance.choice([(0.0, 1.0), (1e9, 1e-3), (-5.0, 1e6), (1e-9, 1e-9), (1.7e9, 1e6)])
        for _ in range(chance.randint(1, 30)):
            rows.append((key, chance.choice([centre, centre + chance.uniform(-1, 1) * spread, chance.gauss(0, 1e12)])))
    values = defaultdict(list)
    for key, value in rows:
        values[key].append(value)
    df = spark.createDataFrame(rows, "u int, v double").repartition(8, "v")
    found = {row["u"]: row["median"] for row in groups.median_by_group(df, ["u"], "v", ranges).collect()}
    assert found == {key: median(vs) for key, vs in values.items()}


def test_an_outlier_does_not_crowd_the_median(spark, monkeypatch):
    """Many different values close together and one far away: only one range of them is ordered."""
    values = spark.range(20_001).select(
        F.lit(1).alias("g"), F.when(F.col("id") < 20_000, F.col("id") / 200 + 1e9).otherwise(1.0015e9).alias("v")
    )
    written = []
    work_table = groups.work_table
    monkeypatch.setattr(groups, "work_table", lambda *a: [table := work_table(*a), written.append(table)][0])
    assert groups.median_by_group(values, ["g"], "v", 16).first()["median"] == 10_000 / 200 + 1e9
    largest = written[0].groupBy("_cell").count().agg(F.max("count")).first()[0]
    assert largest < 2 * 20_001 / 16


@pytest.fixture(scope="module")
def hot(spark, folder):
    """The given events with a third of all rows moved to one user and one value."""
    from tabulare.sources.tables import read_table

    events = read_table(spark, folder, "events")
    is_hot = F.col("event_type").isin("click", "view")
    return (
        events.withColumn("user_id", F.when(is_hot, 0).otherwise(F.col("user_id")))
        .withColumn("cents", F.when(is_hot & (F.col("value") < 50), 700).otherwise(cents("value")))
        .select("event_id", "user_id", "event_type", "ts", "cents")
        .cache()
    )


def same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_hot_key_holds_a_third(hot):
    share = hot.where("user_id = 0").count() / hot.count()
    assert share > 1 / 3


@pytest.mark.parametrize("cell_rows", [10, 5_000_000])
def test_hot_running_sums_equal_a_plain_window(hot, cell_rows):
    plain = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    same_rows(
        ordered.running_sums(hot, ["user_id"], ["ts", "event_id"], {"s": F.col("cents")}, cell_rows),
        hot.withColumn("s", F.sum("cents").over(plain)),
    )


def test_hot_sessions_equal_session_windows(hot):
    found = timed.sessions(hot, ["user_id"], "ts", 1_800, F.col("cents"))
    builtin = (
        hot.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w"))
        .agg(F.count("*").alias("rows"), F.sum("cents").alias("amount"))
        .select(
            "user_id", F.col("w.start").alias("session_start"),
            (F.col("w.end") - F.expr("INTERVAL 30 MINUTES")).alias("session_end"), "rows", "amount",
        )
    )
    same_rows(found, builtin)


def test_hot_median_equals_percentile(hot):
    same_rows(
        groups.median_by_group(hot, ["user_id"], "cents"),
        hot.groupBy("user_id").agg(F.percentile("cents", 0.5).alias("median")),
    )


def test_hot_latest_record_equals_a_rank(hot):
    last = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    same_rows(
        ordered.latest_record(hot, ["user_id"], ["ts", "event_id"]),
        hot.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n"),
    )


def test_set_comparisons_equal_set_operators(hot):
    first = hot.where("event_type <> 'error'").select("user_id", "cents")
    second = hot.where("event_type <> 'view'").select("user_id", "cents")
    same_rows(compare.rows_only_in_first(first, second), first.subtract(second))
    same_rows(compare.rows_in_both(first, second), first.intersect(second))


def odd_times(spark, name):
    """20,000 rows of one key and 500 of others, with times that do not help to split it evenly."""
    second = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    spread = second + F.make_dt_interval(secs=F.col("id"))
    time = {
        "one early row": F.when(F.col("id") == 0, F.expr("timestamp_ntz'1970-01-01 00:00:00'")).otherwise(spread),
        "half in one second": F.when(F.col("id") % 2 == 0, second).otherwise(spread),
        "half without a time": F.when(F.col("id") % 2 == 0, None).otherwise(spread),
    }[name]
    user = F.when(F.col("id") < 20_000, 0).otherwise(F.col("id") % 50 + 1)
    return spark.range(20_500).select("id", user.alias("u"), time.alias("t"), (F.col("id") % 11).alias("v"))


@pytest.mark.parametrize("name", ["one early row", "half in one second", "half without a time"])
def test_a_busy_key_is_cut_by_its_rows(spark, name):
    df = odd_times(spark, name)
    plain, cut = split_busy(df, ["u"], ["t", "id"], 2_000)
    assert plain.count() == 500 and cut.where("u <> 0").count() == 0 and cut.count() == 20_000
    assert cut.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 2 * 2_000
    overlap = cut.groupBy("_cell").agg(F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b"))
    cells = [(r["_cell"], r["a"], r["b"]) for r in overlap.orderBy("_cell").collect()]
    assert len(cells) >= 10
    window = Window.partitionBy("u").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    same_rows(
        ordered.running_sums(df, ["u"], ["t", "id"], {"s": F.col("v")}, 2_000), df.withColumn("s", F.sum("v").over(window))
    )
    within = timed.interval_match(df, df, ["u"], "t", 5, F.col("v"), 2_000)
    same_rows(within, timed.interval_match(df, df, ["u"], "t", 5, F.col("v"), 1e9))


def test_a_key_of_few_rows_is_not_cut(hot):
    plain, cut = split_busy(hot, ["user_id"], ["ts", "event_id"], 1e9)
    assert plain is hot and cut is None


def test_a_short_gap_does_not_put_a_key_in_one_task(spark):
    """One session per row: the pieces of the busy key are cut, and sessions go on over the cuts."""
    df = odd_times(spark, "half in one second").where("u = 0")
    same_rows(
        timed.sessions(df, ["u"], "t", 1, F.col("v"), cell_rows=500), timed.sessions(df, ["u"], "t", 1, F.col("v"))
    )
    spaced = spark.range(9_000).select(
        F.lit(1).alias("u"), (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(secs=F.col("id") * 3 - F.col("id") % 3)).alias("t"),
        F.lit(1).alias("v"),
    )
    found = timed.sessions(spaced, ["u"], "t", 2, F.col("v"), cell_rows=500)
    assert (found.count(), found.agg(F.sum("rows")).first()[0]) == (3_000, 9_000)
