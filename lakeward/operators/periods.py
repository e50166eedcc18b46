"""Select rows by month key: windows, recent periods, the latest period."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions.periods import year_of_key
from lakeward.operators.sizing import BROADCAST_BYTES, join_small, measured_bytes


def check_window(
    year: str | None = None,
    month: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> None:
    """Raise ``ValueError`` unless the arguments name one year, month or closed range."""
    chosen = [year is not None, month is not None, start is not None or end is not None]
    if sum(chosen) > 1:
        raise ValueError("give a year, a month or a range, not several of them")
    if year is not None and not re.fullmatch("[0-9]{4}", year):
        raise ValueError(f"year must be AAAA: {year!r}")
    if (start is None) != (end is None):
        raise ValueError("a range needs both its first and its last month")
    for key in (month, start, end):
        if key is not None and not re.fullmatch("[0-9]{4}(0[1-9]|1[0-2])", key):
            raise ValueError(f"month must be AAAAMM: {key!r}")
    if start is not None and start > end:
        raise ValueError(f"range is inverted: {start} is after {end}")


def in_window(
    key: str,
    year: str | None = None,
    month: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> bool:
    """Whether one month key lies in the window."""
    if year is not None:
        return key[:4] == year
    if month is not None:
        return key == month
    return start is None or start <= key <= end


def period_window(
    df: DataFrame,
    column: str = "competencia",
    year: str | None = None,
    month: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows of a year, a month or a closed range; all rows without a window.

    Written as comparisons of the bare column, so that partition folders and
    Parquet row groups are skipped.
    """
    check_window(year, month, start, end)
    key = F.col(column)
    if year is not None:
        return df.where(key.between(year + "01", year + "12"))
    if month is not None:
        return df.where(key == month)
    if start is not None:
        return df.where(key.between(start, end))
    return df


def time_window(
    df: DataFrame,
    column: str,
    year: str | None = None,
    month: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The same windows on a timestamp column, as a range that Parquet readers use
    to skip row groups."""
    check_window(year, month, start, end)
    if year is not None:
        start, end = year + "01", year + "12"
    elif month is not None:
        start = end = month
    if start is None:
        return df
    first = date(int(start[:4]), int(start[4:]), 1)
    after = date(int(end[:4]) + int(end[4:]) // 12, int(end[4:]) % 12 + 1, 1)
    kind = df.schema[column].dataType
    return df.where(
        (F.col(column) >= F.lit(str(first)).cast(kind)) & (F.col(column) < F.lit(str(after)).cast(kind))
    )


def distinct_periods(df: DataFrame, column: str) -> DataFrame:
    """Distinct periods; merged inside each task before the shuffle."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def top_n_periods(df: DataFrame, column: str, n: int) -> DataFrame:
    """The `n` latest distinct periods; none for ``n=0``."""
    return distinct_periods(df, column).orderBy(F.col(column).desc()).limit(n)


def recent_or_unknown(
    inventory: DataFrame, ledger: DataFrame, key: str, period: str, n: int = 2
) -> DataFrame:
    """Files of the `n` latest periods, and files whose key the ledger lacks.

    Periods must be four-digit-year keys, or the nineties would sort last.
    """
    recent = F.broadcast(top_n_periods(inventory, period, n).select(F.col(period).alias("_recent")))
    known = ledger.where(F.col(key).isNotNull()).select(F.upper(key).alias("_known")).distinct()
    marked = inventory.join(recent, F.col(period) == F.col("_recent"), "left")
    marked = join_small(marked, known, F.upper(key), "_known", "left")
    wanted = F.col("_recent").isNotNull() | F.col("_known").isNull()
    return marked.where(wanted).drop("_recent", "_known")


def latest_period(df: DataFrame, period: str, *group: str) -> DataFrame:
    """Rows of the latest period, of the whole table or of each group.

    The maximum per group is small and merged before its shuffle; the rows
    themselves are only filtered, never shuffled by group.
    """
    if not group:
        latest = df.agg(F.max(period).alias("_latest"))
        return df.join(F.broadcast(latest), F.col(period) == F.col("_latest")).drop("_latest")
    # Distinct first: that is a hash aggregate, while a maximum of texts would
    # sort every row of the table.
    pairs = df.select(*group, period).distinct()
    latest = pairs.groupBy(*group).agg(F.max(period).alias(period))
    if measured_bytes(latest) <= BROADCAST_BYTES:
        names = {c: f"_{c}" for c in (*group, period)}
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(r)) for c, r in names.items()])
        return df.join(F.broadcast(latest.withColumnsRenamed(names)), same, "left_semi")
    unit = F.to_json(F.struct(*group, period))
    return join_small(df, latest.select(unit.alias("_unit")), unit, "_unit", "left_semi")


def calendar(periods: DataFrame, column: str) -> DataFrame:
    """Every month key of every year from the first to the last year that occurs."""
    years = periods.agg(
        F.min(year_of_key(column)).alias("first"), F.max(year_of_key(column)).alias("last")
    ).where("first is not null")
    return years.select(F.explode(F.sequence("first", "last")).alias("ano")).select(
        "ano", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes")
    )
