"""Fixed-position microdata: published line by line, decoded only on request."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.files import path_list


def scan_raw_text(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """One row per line, column ``value``, blanks kept."""
    return spark.read.text(path_list(paths))


def apply_layout(lines: DataFrame, layout: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Columns cut from fixed positions: (name, first position from 1, length)."""
    return lines.select(
        *[F.substring("value", first, length).alias(name) for name, first, length in layout]
    )
