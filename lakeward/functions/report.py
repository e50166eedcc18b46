"""Expressions for reports: local times, byte sizes and content digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.text import as_column

# Report times are shown in this fixed offset, without daylight saving.
REPORT_OFFSET = "-03:00"

# Binary size units, smallest first.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB"]


def local_time(ts: Column | str, source_zone: str | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` at the report offset.

    `source_zone` names the zone of a timestamp without zone; instants need none.
    """
    zone = F.lit(source_zone) if source_zone else F.current_timezone()
    shifted = F.convert_timezone(zone, F.lit(REPORT_OFFSET), as_column(ts).cast("timestamp_ntz"))
    return F.substring(shifted.cast("string"), 1, 19)


def byte_size(n_bytes: Column | str) -> Column:
    """Largest unit under 1024 with one decimal and thousands separators."""
    n = as_column(n_bytes).cast("double")
    text = F.concat(F.format_number(n / 1024 ** (len(SIZE_UNITS) - 1), 1), F.lit(f" {SIZE_UNITS[-1]}"))
    for power in range(len(SIZE_UNITS) - 2, -1, -1):
        shown = F.concat(F.format_number(n / 1024**power, 1), F.lit(f" {SIZE_UNITS[power]}"))
        text = F.when(n < 1024 ** (power + 1), shown).otherwise(text)
    return text


def gibibytes(n_bytes: Column | str) -> Column:
    return F.format_string("%.2f GiB", as_column(n_bytes).cast("double") / 1024**3)


def thousands(n: Column | str) -> Column:
    return F.format_number(as_column(n).cast("bigint"), 0)


def row_digest(df: DataFrame) -> Column:
    """The two halves of the MD5 of a row's values, as whole numbers (high, low)."""
    # Nulls and texts are told apart, and the unit separator keeps values apart.
    cells = [
        F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))
        for c in sorted(df.columns)
    ]
    digest = F.md5(F.concat_ws("\x1f", *cells).cast("binary"))
    half = lambda first: F.conv(F.substring(digest, first, 16), 16, 10).cast("decimal(20,0)")
    return F.struct(half(1).alias("high"), half(17).alias("low"))


def fingerprint(df: DataFrame, *group: str) -> DataFrame:
    """Row count and order-free content digest of a table or of each group.

    A sum, so copies count and the order of rows does not; partial sums merge
    before the shuffle.
    """
    return (
        df.withColumn("_digest", row_digest(df))
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.concat_ws(
                "-", *(F.sum(f"_digest.{half}").cast("decimal(38,0)").cast("string") for half in ("high", "low"))
            ).alias("digest"),
        )
    )
