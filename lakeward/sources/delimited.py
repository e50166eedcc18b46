"""Delimited text: ragged files, byte-order marks and headers that differ per file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.files import scan_file_inventory
from lakeward.sources.headed import MALFORMED, scan_headed


def scan_delimited_files(
    spark: SparkSession, files: DataFrame, sep: str = ";", encoding: str = "ISO-8859-1"
) -> tuple[DataFrame | None, DataFrame]:
    """All-text rows of an inventory, united by the names in each file's header, and what was set
    aside: (path, name, bytes, error), one row per malformed line or file that cannot be read.

    The rows are None if no file has a header. A UTF-8 byte-order mark is not part of the first name.
    """
    found = scan_headed(spark, files, sep, encoding)
    return found.rows, found.aside


def scan_delimited(
    spark: SparkSession,
    paths: str | Iterable[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """All-text table of files, by the names in their headers; lines with too few or too many
    fields are left out (`scan_delimited_with_rejects` gives them too)."""
    return scan_delimited_with_rejects(spark, paths, sep, encoding)[0]


def scan_delimited_with_rejects(
    spark: SparkSession,
    paths: str | Iterable[str],
    sep: str = ";",
    encoding: str = "ISO-8859-1",
) -> tuple[DataFrame, DataFrame]:
    """The same table, and beside it the lines set aside: (file, line). A file that cannot be read fails."""
    rows, aside = scan_delimited_files(spark, scan_file_inventory(spark, paths), sep, encoding)
    lost = aside.where(~F.startswith("error", F.lit(MALFORMED))).first()
    if lost:
        raise OSError(f"{lost['path']}: {lost['error']}")
    if rows is None:
        raise ValueError(f"no header in {paths}")
    return rows, aside.select(F.col("name").alias("file"), F.substring(F.col("error"), len(MALFORMED) + 1, 1 << 30).alias("line"))


# Types in the order in which they are tried, each with the texts that it takes.
_TYPES = [
    ("int", r"^[+-]?[0-9]+$"),
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"),
    ("boolean", r"^(?i)(true|false)$"),
]


def with_inferred_types(rows: DataFrame) -> DataFrame:
    """Text columns as the first type that takes all their values, found in one pass over all rows; text if none does."""
    fits = [
        F.bool_and(F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").rlike(pattern) & F.col(f"`{c}`").try_cast(kind).isNotNull()))
        for c in rows.columns
        for kind, pattern in _TYPES
    ]
    found = iter(rows.agg(*[f.alias(f"t{i}") for i, f in enumerate(fits)]).first())
    kinds = {c: next((k for k, ok in [(k, next(found)) for k, _ in _TYPES] if ok), "string") for c in rows.columns}
    return rows.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def scan_csv_union_with_rejects(
    spark: SparkSession, paths: str | Iterable[str], sep: str = ",", encoding: str = "UTF-8", infer: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV files whose headers differ, united by column name, and what was set aside (path, name, bytes, error):
    lines with more or fewer fields than their file's header, files whose header repeats a name, files that cannot be read.

    Names are compared ignoring case and shown as they first appear. Types are inferred once, over the union.
    """
    found = scan_headed(spark, scan_file_inventory(spark, paths, glob="*.csv"), sep, encoding)
    if found.rows is None:
        raise ValueError(f"no readable CSV file in {paths}")
    return (with_inferred_types(found.rows) if infer else found.rows), found.aside


def scan_csv_union_by_header(
    spark: SparkSession,
    paths: str | Iterable[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    infer: bool = True,
) -> DataFrame:
    """The same table without the lines set aside; a file that cannot be read fails."""
    rows, aside = scan_csv_union_with_rejects(spark, paths, sep, encoding, infer)
    lost = aside.where(~F.startswith("error", F.lit(MALFORMED))).first()
    if lost:
        raise OSError(f"{lost['path']}: {lost['error']}")
    return rows
