"""Publish whole tables, files and ledgers.

A published table is a folder of numbered versions. A write creates a new
version, and readers take the highest one whose job was committed, so a table
can be read and replaced in one job and a lost job never hides the old version.
Nothing is renamed, which suits object stores.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeward.session import small_table

MAX_RECORDS_PER_FILE = 5_000_000
# Rows of a Parquet row group, the least that a reader can pass over by its statistics.
ROW_GROUP_ROWS = 250_000
LEDGER_SCHEMA = "key string, fingerprint bigint"
LEDGER_TYPE = pa.schema([("key", pa.string()), ("fingerprint", pa.int64())])


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop client that Spark itself writes with."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    system, where = hadoop_path(spark, path)
    return system.exists(where)


def versions(spark: SparkSession, path: str, committed: bool = True) -> list[int]:
    system, where = hadoop_path(spark, path)
    if not system.exists(where):
        return []
    found = []
    for status in system.listStatus(where):
        match = re.fullmatch("v([0-9]{8})", status.getPath().getName())
        if match and (not committed or path_exists(spark, f"{path}/{match[0]}/_SUCCESS")):
            found.append(int(match[1]))
    return sorted(found)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version:08d}"


def next_version(spark: SparkSession, path: str) -> str:
    """The folder of a version that nobody has begun. Of two runs that choose the same one, the second fails."""
    taken = versions(spark, path, committed=False)
    return version_path(path, (taken[-1] if taken else 0) + 1)


def latest_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the latest committed version, or None before the first publication."""
    done = versions(spark, path)
    return version_path(path, done[-1]) if done else None


def group_options(row_group_rows: int = ROW_GROUP_ROWS, blooms: tuple[str, ...] = ()) -> dict[str, str]:
    """Write options for row groups of at most so many rows, with Bloom filters of the columns `blooms`, by which
    a search for single values passes over groups whose range would hold them."""
    options = {"parquet.block.row.count.limit": str(row_group_rows)}
    for column in blooms:
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{column}"] = str(row_group_rows)
    return options


def publish_table(df: DataFrame, path: str, max_records_per_file: int = MAX_RECORDS_PER_FILE, row_group_rows: int = ROW_GROUP_ROWS) -> str:
    """Write a new version of the table at `path`; returns the folder written."""
    target = next_version(df.sparkSession, path)
    df.write.options(**group_options(row_group_rows)).option("maxRecordsPerFile", max_records_per_file).parquet(target)
    return target


# Seconds after which a version that was begun and is not there yet counts as given up, and between two looks.
GIVEN_UP, LOOK = 600, 0.5


def latest_number(spark: SparkSession, path: str) -> int:
    """The number of the latest committed version, 0 before the first."""
    return max(versions(spark, path), default=0)


def claim(spark: SparkSession, name: str) -> bool:
    """Create an empty file that nobody else has created; as exclusive as the store's own create."""
    system, where = hadoop_path(spark, name)
    try:
        system.create(where, False).close()
    except Exception:
        if not system.exists(where):
            raise
        return False
    return True


def _claim_of(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_begun-{number:08d}"


def publish_after(df: DataFrame, path: str, number: int) -> bool:
    """Publish the version that follows `number`; false if another run has begun or published that one.

    A claim that is old and led to no version, as of a run that died, is taken over.
    """
    spark, mine = df.sparkSession, number + 1
    own, folder = _claim_of(path, mine), version_path(path, mine)
    if not claim(spark, own):
        system, where = hadoop_path(spark, own)
        if path_exists(spark, f"{folder}/_SUCCESS"):
            return False
        age = time.time() - system.getFileStatus(where).getModificationTime() / 1000
        if age < GIVEN_UP:
            return False
        system.delete(where, False)
        if not claim(spark, own):
            return False
    system, where = hadoop_path(spark, folder)
    if path_exists(spark, f"{folder}/_SUCCESS"):
        return False
    system.delete(where, True)
    df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(folder)
    return True


def update_published(
    spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame | None], schema: str | None = None
) -> None:
    """Publish what `change` makes of the latest version (None before the first), at the version right after it.

    With the `schema` of the table no footer is read to know it.

    If another run publishes that one first, its version is read and `change` runs again, so that of two
    runs at once none is lost. None from `change` leaves the table as it is.
    """
    while True:
        number = latest_number(spark, path)
        reader = spark.read.schema(schema) if schema else spark.read
        after = change(reader.parquet(version_path(path, number)) if number else None)
        if after is None or publish_after(after, path, number):
            return
        time.sleep(LOOK)


def publish_counted(df: DataFrame, path: str) -> int:
    """Publish a version and return its rows, counted while they are written."""
    seen = Observation()
    publish_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """Latest committed version, or None before the first publication."""
    folder = latest_version(spark, path)
    return spark.read.parquet(folder) if folder else None


def drop_old_claims(spark: SparkSession, path: str) -> None:
    """Delete the claims of versions that are there or were passed by."""
    system, where = hadoop_path(spark, path)
    latest = latest_number(spark, path)
    for status in system.listStatus(where) if system.exists(where) else []:
        match = re.fullmatch("_begun-([0-9]{8})", status.getPath().getName())
        if match and int(match[1]) < latest:
            system.delete(status.getPath(), False)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete committed versions but the `keep` latest; returns how many."""
    old = versions(spark, path)[: -max(keep, 1)]
    drop_old_claims(spark, path)
    for version in old:
        system, where = hadoop_path(spark, version_path(path, version))
        system.delete(where, True)
    return len(old)


def write_csv(df: DataFrame, path: str) -> str:
    """Comma-separated files with a header in each, as a new version; returns its folder."""
    target = next_version(df.sparkSession, path)
    df.write.option("header", True).option("escape", '"').csv(target)
    return target


def publish_text(lines: DataFrame, path: str) -> str:
    """Raw lines as they are, as a new version; returns its folder."""
    target = next_version(lines.sparkSession, path)
    lines.select("value").write.text(target)
    return target


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger (key, fingerprint), empty before the first write."""
    folder = latest_version(spark, path)
    if folder is None:
        return small_table(spark, [], LEDGER_TYPE)
    return spark.read.schema(LEDGER_SCHEMA).parquet(folder)


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Publish the ledger. Call it after the data of its keys was written."""
    publish_table(ledger.select("key", "fingerprint"), path)


def update_ledger(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Publish what `change` makes of the ledger as it is now. Call it after the data of its keys was written."""

    def again(known: DataFrame | None) -> DataFrame:
        return change(small_table(spark, [], LEDGER_TYPE) if known is None else known).select("key", "fingerprint")

    update_published(spark, path, again, LEDGER_SCHEMA)
