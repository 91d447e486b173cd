"""Amounts as whole numbers: sums are exact, whatever the order of the rows.

Published amounts are doubles with two decimals. Scaling them as doubles and
rounding to the nearest whole number is much cheaper than casting each double
to a decimal, which goes through text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(column: str) -> Column:
    """An amount in cents, as bigint. A sum that overruns a bigint raises."""
    return F.rint(F.col(column) * 100).cast("bigint")


def wide(whole: Column) -> Column:
    """A whole number whose sum has room for any number of rows, at some cost."""
    return whole.cast("decimal(18,0)")


def from_cents(total: Column) -> Column:
    return total.cast("double") / 100


def total(column: str) -> Column:
    """Exact sum of an amount, published as double."""
    return from_cents(F.sum(wide(cents(column))))


def discounted(price: str, discount: str) -> Column:
    """Price after discount, in hundredths of a cent."""
    return cents(price) * (100 - cents(discount))


def from_discounted(total: Column) -> Column:
    return total.cast("double") / 10_000
