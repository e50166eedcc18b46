"""Published tables: plain, with drifting columns, and by month."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.partitions import month_folders, month_list, read_months
from lakeward.operators.periods import check_window, in_window
from lakeward.operators.sizing import join_small
from lakeward.session import settled
from lakeward.sources.files import path_list


def scan_parquet(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return spark.read.parquet(*path_list(paths))


def scan_parquet_union_by_name(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Parts whose columns differ, united by name; missing columns are null.

    The parts must hold text where they share a name (see ``conform``), because
    Spark does not widen a name that has two types.
    """
    return spark.read.option("mergeSchema", True).parquet(*path_list(paths))


def scan_month_range(
    spark: SparkSession, path: str, column: str = "competencia", **window: str | None
) -> DataFrame:
    """Months of a month-partitioned table; only the folders of the window are opened.

    Eras with different columns are aligned by name.
    """
    check_window(**window)
    months = [m for m in month_folders(spark, path, column) if in_window(m, **window)]
    rows = read_months(spark, path, column, months)
    if rows is None:
        raise ValueError(f"no month of {path} lies in the window {window}")
    return rows


def scan_months(spark: SparkSession, path: str, column: str = "competencia") -> DataFrame:
    """All months of a month-partitioned table, with the month as a partition column.

    A filter on it opens only the months that pass, and so does a join with a filtered table of months that is broadcast:
    Spark prunes the folders when the query is planned, or from the months that the other side turns out to have.
    """
    rows = read_months(spark, path, column)
    if rows is None:
        raise ValueError(f"{path} has no months")
    return rows


def scan_calendar(spark: SparkSession, path: str, calendar: DataFrame, column: str = "competencia") -> DataFrame:
    """The rows of the months that a table of months has, with its other columns.

    The months are found first, whatever plan `calendar` has and however it is joined later, and
    only their folders are listed and opened. A month that the calendar repeats repeats its rows; months without a folder have none.
    """
    known = settled(calendar, "calendar")
    rows = read_months(spark, path, column, month_list(known, column))
    if rows is None:
        # The same columns, without a row.
        rows = scan_months(spark, path, column).where("false")
    return join_small(rows, known.withColumnRenamed(column, "_month"), F.col(column), "_month", "inner").drop("_month")
