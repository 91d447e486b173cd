"""Comparing two results as multisets of rows, values exactly."""

from collections import Counter


def spark_rows(df):
    return sorted(df.columns), Counter(tuple(row[c] for c in sorted(df.columns)) for row in df.collect())


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())


def assert_same(left, right):
    assert left[0] == right[0]
    missing, extra = right[1] - left[1], left[1] - right[1]
    assert not missing and not extra, (
        f"{sum(extra.values())} rows too many, {sum(missing.values())} missing; "
        f"extra {list(extra)[:3]}, missing {list(missing)[:3]}"
    )
