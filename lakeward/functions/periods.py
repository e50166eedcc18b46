"""Year and month keys. A month key is ``AAAAMM`` text, so text order is time order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.functions.text import as_column


def pivot_year(two_digits: Column | str, pivot: int | Column | None) -> Column:
    """Four-digit year of a two-digit one: from `pivot` on it is 19xx, else 20xx.

    Without a pivot (null) the year is always 19xx.
    """
    year = as_column(two_digits).try_cast("int")
    limit = pivot if isinstance(pivot, Column) else F.lit(pivot).cast("int")
    return F.when(limit.isNull() | (year >= limit), year + 1900).otherwise(year + 2000)


def full_year(digits: Column | str, pivot: int | Column | None) -> Column:
    """Year of two pivoted digits, or of the digits as written."""
    digits = as_column(digits)
    return F.when(F.length(digits) == 2, pivot_year(digits, pivot)).otherwise(
        digits.try_cast("int")
    )


def month_key(year: Column | str, month: Column | str) -> Column:
    number = as_column(year).cast("int") * 100 + as_column(month).cast("int")
    return F.lpad(number.cast("string"), 6, "0")


def month_key_of(ts: Column | str) -> Column:
    """Month key of a date or timestamp."""
    ts = as_column(ts)
    return month_key(F.year(ts), F.month(ts))


def year_of_key(period: Column | str) -> Column:
    return F.substring(as_column(period), 1, 4).try_cast("int")


def month_label(period: Column | str) -> Column:
    """``AAAAMM`` -> ``MM/AAAA``."""
    period = as_column(period)
    return F.concat_ws("/", F.substring(period, 5, 2), F.substring(period, 1, 4))


def year_span(first: Column | str, last: Column | str) -> Column:
    """``AAAA-AAAA`` of the first and last month key."""
    return F.concat_ws(
        "-", F.substring(as_column(first), 1, 4), F.substring(as_column(last), 1, 4)
    )
