"""Ingest files as they arrive, replacing the months they touch.

A file stream takes each path once: a file that is written again under the same
name is not seen, so revisions in place still need the ledger diff in batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.operators.partitions import merge_partitions
from lakeward.session import settled
from lakeward.sources.dbf import LINEAGE
from lakeward.sources.files import plain_path


def _below(landing: str) -> Column:
    """The path of a row's file below the landing folder."""
    path = plain_path(F.col("_metadata.file_path"))
    folder = "/" + landing.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    return F.substring_index(path, folder, -1)


def stream_append_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    period: Callable[[DataFrame], DataFrame],
    max_files: int = 1000,
) -> None:
    """Take all files that arrived since the last call, then stop.

    `period` adds the month column ``competencia``; rows without a period are set aside in the
    table's reject folder. A file is known by its path below the landing folder. Each micro-batch is written
    once before it is used, and merges by source file, so a batch that is run again
    after a failure replaces what its first attempt wrote.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(landing)
        .withColumn(LINEAGE, _below(landing))
    )

    def take(batch: DataFrame, _: int) -> None:
        merge_partitions(settled(period(batch), "arrivals"), target)

    (
        arrivals.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
