"""Small tables with written-out answers, for what the given tables do not hold."""

from datetime import datetime

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from tabulare.functions.money import cents, total
from tabulare.functions.text import clean_text, json_field, url_host
from tabulare.functions.times import epoch_seconds, time_cell
from tabulare.operators import compare, groups, lookups, ordered, quality, rows, timed
from tabulare.plans.indicators import indicator_table
from tabulare.sources.tables import check_schema, table_schema


def table(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def result(df, *columns):
    return sorted((tuple(row[c] for c in columns or df.columns) for row in df.collect()), key=repr)


def at(text):
    return datetime.fromisoformat(f"2024-01-01 {text}")


# rows


def test_filtered_rows_takes_the_start_and_leaves_the_end(spark):
    df = table(
        spark, "id int, d timestamp_ntz, code string",
        (1, at("00:00"), "a"), (2, at("01:00"), "a"), (3, at("00:30"), "b"), (4, None, "a"), (5, at("00:30"), None),
    )
    found = rows.filtered_rows(df, "d", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "code", ["a"])
    assert result(found, "id") == [(1,)]
    assert result(rows.filtered_rows(df, "d", "2024-01-01", "2024-01-02", "code", []), "id") == []


@pytest.fixture(scope="module")
def paged(spark):
    return table(
        spark, "k bigint, v double",
        (1, 5.0), (2, 5.0), (3, 7.0), (4, None), (5, 5.0), (6, None), (7, 1.0), (8, None), (9, 9.0),
    )


@pytest.mark.parametrize("size", [1, 2, 4, 20])
def test_pages_cover_every_row_once_with_missing_values_last(spark, paged, size):
    seen, after = [], None
    while True:
        page = rows.dataset_page(paged, "v", "k", after, size).collect()
        seen += [row["k"] for row in page]
        if len(page) < size:
            break
        after = (page[-1]["v"], page[-1]["k"])
    assert seen == [7, 1, 2, 5, 3, 9, 4, 6, 8]


@pytest.mark.parametrize("data_type", ["double", "decimal(12,2)", "bigint", "float"])
def test_median_of_wide_and_special_values(spark, data_type):
    values = [-(10**9), 10**9, 0, 1, 2, 3, 5]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").select(
        F.lit(1).alias("g"), F.col("v").cast(data_type).alias("v")
    )
    for ranges in (1, 3, 8):
        assert float(groups.median_by_group(df, ["g"], "v", ranges).first()["median"]) == 2
    if data_type == "double":
        special = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,)], "v double")
        odd = special.union(special.where("v = 1")).withColumn("g", F.lit(1))
        assert groups.median_by_group(odd, ["g"], "v").first()["median"] == 1.0


def test_median_of_large_whole_numbers_is_exact(spark):
    from decimal import Decimal

    rows = [("far", 2**62), ("far", 2**62 + 4), ("same", 2**53 + 1), ("same", 2**53 + 1), ("odd", 2**53), ("odd", 2**53 + 1)]
    df = table(spark, "g string, v bigint", *rows)
    assert result(groups.median_by_group(df, ["g"], "v")) == [
        ("far", Decimal(2**62 + 2)), ("odd", Decimal(2**53) + Decimal("0.5")), ("same", Decimal(2**53 + 1)),
    ]
    huge = table(spark, "g int, v double", (1, 1.7e308), (1, 1.6e308))
    assert groups.median_by_group(huge, ["g"], "v").first()["median"] == pytest.approx(1.65e308)


def test_large_tops_and_pages(spark):
    """More rows than Spark cuts in its input tasks, and more than once was the limit."""
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"), (F.col("id") % 97).alias("v"))
    top = ordered.top_per_group(df, ["g"], [F.col("v").desc(), F.col("k")], 5_000).collect()
    rows_by_group = {g: sorted(((-(k % 97), k) for k in range(20_000) if k % 2 == g))[:5_000] for g in (0, 1)}
    assert sorted((r["g"], r["rank"], r["k"]) for r in top) == [
        (g, i, k) for g in (0, 1) for i, (_, k) in enumerate(rows_by_group[g], 1)
    ]
    page = rows.dataset_page(df, "v", "k", (3, 300), 5_000).collect()
    assert [r["k"] for r in page] == [k for _, k in sorted((k % 97, k) for k in range(20_000)) if (k % 97, k) > (3, 300)][:5_000]


def test_sizes_must_be_positive(paged):
    with pytest.raises(ValueError):
        ordered.top_per_group(paged, ["k"], [F.col("v")], 0)
    with pytest.raises(ValueError):
        rows.dataset_page(paged, "v", "k", None, 0)


def test_stacked_rows_match_columns_by_name_and_keep_repeats(spark):
    first = table(spark, "a int, b string", (1, "x"))
    second = table(spark, "b string, a int", ("x", 1), (None, None))
    assert result(rows.stacked_rows(first, second)) == [(1, "x"), (1, "x"), (None, None)]


# lookups


def test_code_lookup_keeps_rows_without_a_label(spark):
    facts = table(spark, "id int, code int", (1, 10), (2, 99), (3, None))
    codes = table(spark, "code int, name string", (10, "ten"), (None, "nothing"))
    found = lookups.code_lookup(facts, "code", codes, "code", {"name": "label"})
    assert found.columns == ["id", "code", "label"]
    assert result(found) == [(1, 10, "ten"), (2, 99, None), (3, None, None)]


@pytest.fixture(scope="module")
def family(spark):
    parents = table(spark, "p int", (1,), (2,), (None,))
    details = table(spark, "d int, x int", (1, 1), (1, None), (None, 1), (3, 1))
    return parents, details


def test_detail_counts_include_zero(family):
    assert result(lookups.detail_counts(family[0], "p", family[1], "d")) == [(1, 2), (2, 0), (None, 0)]


def test_parents_are_split_by_having_details(family):
    assert result(lookups.parents_with_detail(family[0], "p", family[1], "d")) == [(1,)]
    assert result(lookups.orphan_report(family[0], "p", family[1], "d")) == [(2,), (None,)]


def test_without_details_every_parent_is_an_orphan(family):
    none = family[1].where("false")
    assert result(lookups.parents_with_detail(family[0], "p", none, "d")) == []
    assert len(result(lookups.orphan_report(family[0], "p", none, "d"))) == 3


# groups


def test_rollup_tells_a_missing_label_from_a_total(spark):
    df = table(spark, "r string, n string, x int", ("A", "a", 1), ("A", None, 2), ("B", "b", 4))
    found = groups.rollup_totals(df, ["r", "n"], {"x": F.sum("x")})
    assert result(found, "r", "n", "r_is_total", "n_is_total", "x") == sorted(
        [
            ("A", "a", 0, 0, 1), ("A", None, 0, 0, 2), ("B", "b", 0, 0, 4),
            ("A", None, 0, 1, 3), ("B", None, 0, 1, 4), (None, None, 1, 1, 7),
        ],
        key=repr,
    )


def test_distinct_entities_ignore_missing_ones(spark):
    df = table(spark, "g string, u int", ("a", 1), ("a", 1), ("a", None), ("b", None), (None, 2))
    assert result(groups.distinct_entities(df, ["g"], "u")) == [("a", 1), ("b", 0), (None, 1)]


def test_sketches_are_of_groups_not_of_pairs(spark):
    df = table(
        spark, "g string, u int, x int", ("a", 1, 1), ("a", 1, 2), ("a", None, 3), ("b", None, 4), (None, 3, 5), (None, 4, 5)
    )
    found = groups.distinct_within_bound(df, ["g"], "u")
    assert result(found) == [("a", 1, True), ("b", 0, True), (None, 2, True)]
    steps = [step for step in plan_of(found).split("\n\n") if "approx_count_distinct" in step and "Keys [" in step]
    assert steps and not any("u#" in line for step in steps for line in step.splitlines() if line.startswith("Keys ["))
    assert result(groups.distinct_within_bound(df, [], "u")) == [(3, True)]



def test_approximate_count_is_within_its_error(spark, folder):
    from tabulare.sources.tables import read_table

    events = read_table(spark, folder, "events").withColumn("all", F.lit(1))
    exact = groups.distinct_entities(events, ["all"], "event_id").first()["entities"]
    near = groups.distinct_entities_approx(events, ["all"], "event_id", 0.02).first()["entities"]
    assert abs(near - exact) <= 3 * 0.02 * exact


def test_crosstab_columns_add_up_to_the_rows(spark):
    df = table(spark, "g int, c string", (1, "x"), (1, "x"), (1, "z"), (2, None), (3, "y"))
    assert result(groups.crosstab(df, ["g"], "c", ["x", "y"])) == [(1, 2, 0, 1), (2, 0, 0, 1), (3, 0, 1, 0)]
    with pytest.raises(ValueError):
        groups.crosstab(df, ["g"], "c", ["x", "other"])


def test_median_of_odd_even_missing_and_repeated_values(spark):
    df = table(
        spark, "g string, v double",
        ("odd", 3.0), ("odd", 1.0), ("odd", 2.0), ("even", 1.0), ("even", 4.0), ("one", 9.0),
        ("null", None), ("same", 5.0), ("same", 5.0), ("same", 5.0), ("same", 1.0), (None, 7.0), (None, 8.0),
    )
    assert result(groups.median_by_group(df, ["g"], "v")) == sorted(
        [("odd", 2.0), ("even", 2.5), ("one", 9.0), ("same", 5.0), (None, 7.5)], key=repr
    )


# ordered


def test_top_per_group_breaks_ties_by_key_and_keeps_small_groups(spark):
    df = table(spark, "g int, k int, v double", (1, 1, 5.0), (1, 2, 5.0), (1, 3, 9.0), (1, 4, None), (2, 5, None))
    found = ordered.top_per_group(df, ["g"], [F.col("v").desc_nulls_last(), F.col("k")], 2)
    assert result(found, "g", "k", "rank") == [(1, 1, 2), (1, 3, 1), (2, 5, 1)]


def test_period_change_compares_with_the_last_period_that_has_rows(spark):
    df = table(spark, "g string, m int", ("a", 1), ("a", 1), ("a", 3), ("b", 2))
    assert result(ordered.period_change(df, F.col("m"))) == [(1, 2, None, None), (2, 1, 2, -1), (3, 1, 1, 0)]
    assert result(ordered.period_change(df, F.col("m"), ["g"])) == [
        ("a", 1, 2, None, None), ("a", 3, 1, 2, -1), ("b", 2, 1, None, None),
    ]


def test_running_sums_with_ties_missing_values_and_missing_times(spark):
    df = table(
        spark, "id int, u int, t timestamp_ntz, v int",
        (1, 1, at("00:00"), 1), (2, 1, at("00:00"), 2), (3, 1, at("05:00"), None), (4, 1, at("23:00"), 4),
        (5, 1, None, 8), (6, None, at("00:00"), 16), (7, None, at("09:00"), 32), (8, 2, at("00:00"), None),
    )
    expected = [(1, 9), (2, 11), (3, 11), (4, 15), (5, 8), (6, 16), (7, 48), (8, None)]
    for cell_rows in (0, 0.1, 1, 100):
        sums = ordered.running_sums(df, ["u"], ["t", "id"], {"s": F.col("v")}, cell_rows)
        assert sums.columns == ["id", "u", "t", "v", "s"]
        assert result(sums, "id", "s") == expected


def test_latest_record_takes_the_greater_key_at_equal_times(spark):
    df = table(
        spark, "u int, t timestamp_ntz, id int, x string",
        (1, at("01:00"), 1, "a"), (1, at("01:00"), 2, None), (1, at("00:00"), 3, "c"), (2, None, 4, "d"),
    )
    assert result(ordered.latest_record(df, ["u"], ["t", "id"]), "u", "id", "x") == [(1, 2, None), (2, 4, "d")]


# time


def test_time_cells_before_1970_and_at_their_edges(spark):
    df = table(
        spark, "t timestamp_ntz",
        (datetime(1969, 12, 31, 23, 59, 59),), (datetime(1970, 1, 1),), (datetime(1970, 1, 1, 0, 0, 59, 999999),),
        (datetime(1970, 1, 1, 0, 1),), (None,),
    )
    cells = df.select(epoch_seconds(df, "t").alias("s"), time_cell(df, "t", 60).alias("c"))
    assert result(cells) == [(-1, -60), (0, 0), (59, 0), (60, 60), (None, None)]


def test_time_cells_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = []
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t")
            found.append(df.select(epoch_seconds(df, "t")).first()[0])
        assert found[0] == found[1] == 1_710_037_800
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_time_buckets_leave_out_rows_without_a_time(spark):
    df = table(spark, "t timestamp_ntz, g int", (at("00:00"), 1), (at("00:59"), 1), (at("01:00"), 1), (None, 1))
    found = timed.time_buckets(df, "t", ["g"], "1 hour", {"n": F.count("*")})
    assert result(found) == [(at("00:00"), 1, 2), (at("01:00"), 1, 1)]


def test_overlapping_buckets_count_a_row_in_each(spark):
    df = table(spark, "t timestamp_ntz", (at("01:15"),))
    found = timed.time_buckets(df, "t", [], "1 hour", {"n": F.count("*")}, slide="30 minutes")
    assert result(found) == [(at("00:30"), 1), (at("01:00"), 1)]


def test_sessions_join_at_exactly_the_gap(spark):
    df = table(
        spark, "u int, t timestamp_ntz, v int",
        (1, at("00:00"), 1), (1, at("00:30"), 2), (1, at("01:00:00.000001"), 4), (1, at("01:00:00.000001"), 8),
        (1, None, 16), (None, at("00:00"), 32), (2, at("23:50"), None), (2, datetime(2024, 1, 2, 0, 10), 1),
    )
    assert result(timed.sessions(df, ["u"], "t", 1_800, F.col("v"))) == sorted(
        [
            (1, at("00:00"), at("00:30"), 2, 3),
            (1, at("01:00:00.000001"), at("01:00:00.000001"), 2, 12),
            (2, at("23:50"), datetime(2024, 1, 2, 0, 10), 2, 1),
            (None, at("00:00"), at("00:00"), 1, 32),
        ],
        key=repr,
    )


def test_interval_match_leaves_the_start_and_takes_the_end(spark):
    left = table(
        spark, "id int, u int, t timestamp_ntz",
        (1, 1, at("00:00")), (2, 1, at("00:30")), (3, 2, at("00:00")), (4, None, at("00:00")), (5, 1, None),
    )
    right = table(
        spark, "u int, t timestamp_ntz, v int",
        (1, at("00:00"), 1), (1, at("00:30"), 2), (1, at("01:00"), 4), (1, at("01:00:00.000001"), 8),
        (1, at("01:30"), None), (3, at("00:10"), 1), (1, None, 16),
    )
    found = timed.interval_match(left, right, ["u"], "t", 3_600, F.col("v"))
    assert result(found, "id", "matches", "matched_amount") == [
        (1, 2, 6), (2, 3, 12), (3, 0, 0), (4, 0, 0), (5, 0, 0),
    ]


# text


def test_json_field_of_bad_texts_is_missing(spark):
    df = table(
        spark, "id int, j string",
        (1, '{"k": 5}'), (2, '{"k": "7"}'), (3, '{"k": "x"}'), (4, '{"other": 1}'), (5, "not json"), (6, None),
        (7, '{"k": null}'), (8, '{"k": 1.5}'),
    )
    found = df.select("id", json_field("j", "$.k", "bigint").alias("k"))
    assert result(found) == [(1, 5), (2, 7), (3, None), (4, None), (5, None), (6, None), (7, None), (8, None)]


def test_clean_text(spark):
    df = table(spark, "t string", ("  Two\t\nWords ",), ("",), (" \n",), (None,), ("ÉCOLE",))
    assert [row[0] for row in df.select(clean_text("t")).collect()] == ["two words", "", "", None, "école"]


def test_url_host(spark):
    df = table(
        spark, "u string",
        ("https://A.example.org:8080/p?q=1#f",), ("http://user@b.example.org",), ("no url",), ("http://[bad",), (None,),
    )
    assert [row[0] for row in df.select(url_host("u")).collect()] == [
        "a.example.org", "b.example.org", None, None, None,
    ]


# quality


def test_profile_of_missing_values_and_of_no_rows(spark):
    df = table(spark, "a int, b string", (1, "x"), (1, None), (2, None))
    expected = [("a", 3, 0, 2, "1", "2"), ("b", 3, 2, 1, "x", "x")]
    assert result(quality.column_profile(df, exact=True)) == expected
    assert result(quality.column_profile(df)) == expected
    empty = [("a", 0, 0, 0, None, None), ("b", 0, 0, 0, None, None)]
    assert result(quality.column_profile(df.where("false"), exact=True)) == empty
    assert result(quality.column_profile(df.where("false"))) == empty


def test_duplicate_keys_treat_missing_parts_as_equal(spark):
    df = table(spark, "a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert result(quality.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_duplicate_text_tells_case_apart_and_skips_missing_texts(spark):
    df = table(spark, "k int, t string", (3, "x"), (1, "x"), (2, "X"), (4, None), (5, None), (6, ""), (7, ""))
    assert result(quality.duplicate_text(df, "t", "k")) == [("", 2, 6), ("x", 2, 1)]


def test_amounts_with_more_decimals_are_reported(spark):
    values = [0.125, 1.005, 0.07, 4.35, None, -8.2, 99_999_999_999.99, 1e12 + 0.001, 3.0]
    df = table(spark, "a double, b double", *((v, 1.25) for v in values))
    assert result(quality.inexact_amounts(df, ["a", "b"])) == [("a", 3), ("b", 0)]


# comparisons


def test_snapshot_diff_names_changes_and_repeated_keys(spark):
    schema = "k int, a string, b double"
    old = table(
        spark, schema,
        (1, "x", 1.0), (2, "x", 1.0), (3, None, 1.0), (4, "x", None), (5, "x", 1.0), (5, "y", 1.0), (7, None, None),
        (None, "n", 1.0),
    )
    new = table(
        spark, schema,
        (1, "x", 1.0), (3, "y", 2.0), (4, "x", None), (5, "x", 1.0), (6, "x", 1.0), (7, None, 0.0), (None, "m", 1.0),
    )
    assert result(compare.snapshot_diff(old, new, ["k"], ["a", "b"])) == sorted(
        [
            (2, "removed", ""), (3, "changed", "a,b"), (5, "repeated", ""), (6, "added", ""), (7, "changed", "b"),
            (None, "changed", "a"),
        ],
        key=repr,
    )


def test_set_comparisons_treat_missing_values_as_equal_and_drop_repeats(spark):
    first = table(spark, "a int, b string", (1, "x"), (1, "x"), (2, None), (None, None), (3, "z"), (3, "z"))
    second = table(spark, "b string, a int", (None, 2), ("x", 9), ("z", 3))
    assert result(compare.rows_only_in_first(first, second)) == [(1, "x"), (None, None)]
    assert result(compare.rows_in_both(first, second)) == [(2, None), (3, "z")]


# amounts and the flagship


def test_cents_are_exact_for_two_decimals(spark):
    amounts = [0.01, 0.07, 0.29, 1.15, 4.35, 1.005, -8.2, -0.57, 99_999_999_999.99, 123_456_789.01]
    df = table(spark, "v double", *((v,) for v in amounts))
    assert [int(row[0]) for row in df.select(cents("v")).collect()] == [
        1, 7, 29, 115, 435, 100, -820, -57, 9_999_999_999_999, 12_345_678_901,
    ]
    assert df.where("v < 2 and v > 0").select(total("v")).first()[0] == 2.52


def test_indicator_counts_orders_with_lines_once(spark):
    day, later = datetime(1997, 3, 5), datetime(1998, 1, 1)
    tables = {
        "lineitem": [(1, 1, 1, 1, 1.0, 100.0, 0.1, 0.0, "N", "O", day), (1, 1, 1, 1, 1.0, 0.05, 0.5, 0.0, "N", "O", day),
                     (2, 1, 1, 1, 1.0, 7.0, 0.0, 0.0, "N", "O", day), (9, 1, 1, 1, 1.0, 7.0, 0.0, 0.0, "N", "O", day)],
        "orders": [(1, 1, "O", 0.0, day, "x"), (2, 1, "O", 0.0, later, "x"), (3, 1, "O", 0.0, day, "x")],
        "customer": [(1, "c", 5, 0.0, "s")],
        "nation": [(5, "N", 2)],
        "region": [(2, "R")],
    }
    frames = [spark.createDataFrame(values, table_schema(name)) for name, values in tables.items()]
    found = indicator_table(*frames, start="1997-01-01", end="1998-01-01")
    assert result(found, "region", "nation", "month", "revenue", "lines", "orders") == [
        ("R", "N", "1997-03", 90.025, 2, 1)
    ]


def test_a_table_with_other_columns_is_refused(spark):
    wrong = spark.createDataFrame([], "r_regionkey bigint")
    with pytest.raises(ValueError, match="r_regionkey: expected int, found bigint; r_name.*no such column"):
        check_schema(wrong, table_schema("region"), "region")


@pytest.mark.parametrize(
    "empty",
    [
        lambda e: groups.median_by_group(e, ["u"], "v"),
        lambda e: groups.crosstab(e, ["u"], "c", ["x"]),
        lambda e: ordered.running_sums(e, ["u"], ["t", "id"], {"s": F.col("v")}),
        lambda e: ordered.latest_record(e, ["u"], ["t", "id"]),
        lambda e: timed.sessions(e, ["u"], "t", 60, F.col("v")),
        lambda e: timed.interval_match(e, e, ["u"], "t", 60, F.col("v")),
        lambda e: compare.snapshot_diff(e, e, ["id"], ["v"]),
        lambda e: rows.dataset_page(e, "t", "id", None, 5),
    ],
)
def test_no_rows_in_no_rows_out(spark, empty):
    none = spark.createDataFrame([], "id int, u int, t timestamp_ntz, v int, c string")
    assert empty(none).collect() == []
