"""Month-partitioned tables: rewrite only the months that changed, once, and switch them at once.

A table is a folder of written versions, ``data/table_version=N/<month>``, and a small
published table that says in which version each month is. A write puts the new
rows of its months into a new version and then publishes the next list of
months. Readers follow the list, so they see all of a write or nothing of it; a
run that dies before the list is published changes nothing. No file is moved
or written twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.operators.ledger import ledger_record
from lakeward.operators.merge import merge_by_key
from lakeward.session import small_table
from lakeward.sinks.tables import MAX_RECORDS_PER_FILE, ROW_GROUP_ROWS, claim, group_options, hadoop_path, latest_version, update_ledger, update_published

# Bytes of source files that are rebuilt in one job, before the ledger is written.
BATCH_BYTES = 1 << 40
MONTHS, DATA, VERSION = "_months", "data", "table_version"
# The folder of rows whose key is no period, in place of a month, and the column with that key.
REJECTED, REJECTED_KEY = "rejected", "_rejected_key"
MONTHS_SCHEMA = "month string, version bigint, schema string"
MONTHS_TYPE = pa.schema([("month", pa.string()), ("version", pa.int64()), ("schema", pa.string())])
# Year, month or day.
KEY_PATTERN = "^([0-9]{4}|[0-9]{6}|[0-9]{8})$"


@dataclass(frozen=True)
class Written:
    """Rows of the months written, and rows set aside because their key is no period."""

    rows: int
    rejected: int


@dataclass(frozen=True)
class Layout:
    """How rows lie inside a month: in the order of `within`, in row groups of `row_group_rows`, with Bloom filters of `blooms`.

    With `within` the rows are cut into ranges of month and these columns, so a query for one place
    opens few row groups of a month. Equal places are told apart by a hash of the row, so a place that holds
    most rows of a month is several ranges. Finding the ranges reads a sample of the rows first.
    """

    within: tuple[str, ...] = ()
    row_group_rows: int = ROW_GROUP_ROWS
    blooms: tuple[str, ...] = ()

    def spread(self, rows: DataFrame, column: str, clustered: bool) -> DataFrame:
        if self.within:
            order = [F.col(column), *map(F.col, self.within)]
            apart = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
            return rows.repartitionByRange(*order, apart).sortWithinPartitions(*order)
        # Rebalancing gives a small month one file and splits a month that is far
        # larger than the rest; rows that come month by month stay where they are.
        return rows if clustered else rows.hint("rebalance", F.col(column))


PLAIN = Layout()


def is_period(column: str):
    return F.coalesce(F.col(column).rlike(KEY_PATTERN), F.lit(False))


def write_by_year(rows: DataFrame, path: str, column: str = "competencia") -> None:
    """A plain layout, without versions: the months of a year in a folder of that year."""
    (
        rows.withColumn("ano", F.substring(column, 1, 4))
        .hint("rebalance", F.col("ano"), F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("ano", column)
        .parquet(path)
    )


# ---- the list of months --------------------------------------------------------


def _listed(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    """Month -> (version, schema), which a calendar bounds."""
    folder = latest_version(spark, f"{path}/{MONTHS}")
    return _rows_of_list(spark.read.schema(MONTHS_SCHEMA).parquet(folder) if folder else None)


def _rows_of_list(months: DataFrame | None) -> dict[str, tuple[int, str]]:
    return {} if months is None else {r["month"]: (r["version"], r["schema"]) for r in months.collect()}


def _months(listed: dict[str, tuple[int, str]]) -> dict[str, tuple[int, str]]:
    return {m: at for m, at in listed.items() if not m.startswith(REJECTED)}


class ConcurrentWrite(RuntimeError):
    """A month that a run has read was written by another one before the run could publish it."""


def _publish_list(
    spark: SparkSession, path: str, gone: set[str], added: dict[str, tuple[int, str]], base: dict[str, tuple[int, str]] | None
) -> None:
    """Publish the list as it is now, without the months `gone` and with those `added`.

    What other runs published meanwhile stays. Only if one of them wrote a month that this run read (in `base`) and replaces, its
    rows would be lost, so this fails. So does a column that would have two types, which no reader could read.
    """

    def change(months: DataFrame | None) -> DataFrame | None:
        listed = _rows_of_list(months)
        if base is not None:
            moved = sorted(m for m in gone | set(added) if m in gone and listed.get(m) != base.get(m))
            if moved:
                raise ConcurrentWrite(f"written by another run meanwhile: {', '.join(moved)} of {path}")
        after = {m: at for m, at in listed.items() if m not in gone} | added
        if after == listed:
            return None
        _united(schema for m, (_, schema) in _months(after).items())
        rows = [{"month": m, "version": v, "schema": s} for m, (v, s) in sorted(after.items())]
        return small_table(spark, rows, MONTHS_TYPE).coalesce(1)

    update_published(spark, f"{path}/{MONTHS}", change, MONTHS_SCHEMA)


def month_folders(spark: SparkSession, path: str, column: str = "competencia") -> list[str]:
    """Months of the table, from its list."""
    return sorted(_months(_listed(spark, path)))


def current_months(spark: SparkSession, path: str, column: str = "competencia") -> dict[str, str]:
    """The folder of each month in its current version; empty if `path` is no such table."""
    listed = _months(_listed(spark, path))
    return {m: f"{path}/{DATA}/{VERSION}={v}/{column}={m}" for m, (v, _) in sorted(listed.items())}


def _folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of `column` that have a folder in `path`."""
    system, where = hadoop_path(spark, path)
    if not system.exists(where):
        return []
    names = [status.getPath().getName() for status in system.listStatus(where)]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def _version_folders(spark: SparkSession, path: str) -> list[int]:
    return sorted(map(int, _folders(spark, f"{path}/{DATA}", VERSION)))


def _united(schemas: Iterable[str]) -> T.StructType:
    """The columns of all eras by name, in the order in which they first appear."""
    fields: dict[str, T.StructField] = {}
    for text in dict.fromkeys(schemas):
        for field in T.StructType.fromJson(json.loads(text)):
            known = fields.setdefault(field.name, T.StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise TypeError(f"column {field.name} is {known.dataType.simpleString()} and {field.dataType.simpleString()}")
    return T.StructType(list(fields.values()))


def read_months(
    spark: SparkSession, path: str, column: str = "competencia", months: list[str] | None = None
) -> DataFrame | None:
    """The table, or some months of it, with its key as text.

    The schemas of all eras stand in the list of months, so no footer is read to
    plan a query, and naming months limits the folders that are opened. None
    where nothing was written.
    """
    return _read_listed(spark, path, column, _listed(spark, path), months)


def _read_listed(
    spark: SparkSession, path: str, column: str, listed: dict[str, tuple[int, str]], months: list[str] | None
) -> DataFrame | None:
    listed = _months(listed)
    wanted = sorted(set(listed) if months is None else set(listed) & set(months))
    if not wanted:
        return None
    schema = _united(listed[m][1] for m in wanted)
    schema = schema.add(VERSION, T.LongType()).add(column, T.StringType())
    folders = [f"{path}/{DATA}/{VERSION}={listed[m][0]}/{column}={m}" for m in wanted]
    return spark.read.schema(schema).option("basePath", f"{path}/{DATA}").parquet(*folders).drop(VERSION)


def month_list(periods: DataFrame, column: str) -> list[str]:
    """Period keys (years, months or days) on the driver: a calendar bounds them.

    Other keys are no periods; `rebuild_partitions` sets their rows aside.
    """
    keys = periods.where(is_period(column)).select(column).distinct()
    return sorted(row[0] for row in keys.collect())


def drop_unlisted(spark: SparkSession, path: str, column: str = "competencia") -> int:
    """Delete the month folders that the current list no longer names; returns how many.

    For times without readers: a reader that planned with an older list still needs them.
    """
    listed, dropped = _listed(spark, path), 0
    for version in _version_folders(spark, path):
        folder = f"{path}/{DATA}/{VERSION}={version}"
        months = _folders(spark, folder, column)
        kept = {m for m, (v, _) in listed.items() if v == version}
        kept |= {REJECTED} if f"{REJECTED}{version}" in listed else set()
        system, where = hadoop_path(spark, folder)
        for month in set(months) - kept:
            system.delete(hadoop_path(spark, f"{folder}/{column}={month}")[1], True)
            dropped += 1
        if not kept:
            system.delete(where, True)
    return dropped


# ---- writes --------------------------------------------------------------------


def _new_version(spark: SparkSession, path: str) -> int:
    """A number for a version that no other run writes."""
    version = max([0, *_version_folders(spark, path)]) + 1
    while not claim(spark, f"{path}/{DATA}/_begun-{version}"):
        version += 1
    return version


def _commit(
    rows: DataFrame, path: str, column: str, months: list[str] | None, clustered: bool, base: dict[str, tuple[int, str]] | None = None,
    layout: Layout = PLAIN,
) -> Written:
    """Write rows as a new version and publish the list in which their months point to it.

    `months` are replaced, also if they have no rows now; without it, those that `rows` has. `base` is the list from which the rows that stay were read. Rows whose key is no
    period go into a folder of their own beside the months of the version. How many rows there are is read from the footers.
    """
    spark = rows.sparkSession
    schema = T.StructType([f for f in rows.schema if f.name != column]).json()
    if base is not None and months is not None:
        # What can be known before the rows are written; the list is checked again when it is published.
        _united([*(s for m, (_, s) in _months(base).items() if m not in months), schema])
    version = _new_version(spark, path)
    folder = f"{path}/{DATA}/{VERSION}={version}"
    valid = is_period(column)
    if months is not None:
        rows = rows.where(F.col(column).isin(months) | ~valid)
    marked = rows.withColumn(REJECTED_KEY, F.when(~valid, F.col(column))).withColumn(
        column, F.when(valid, F.col(column)).otherwise(REJECTED)
    )
    writer = layout.spread(marked, column, clustered).write.options(**group_options(layout.row_group_rows, layout.blooms))
    writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(column).parquet(folder)
    counts: dict[str, int] = {}
    if _folders(spark, folder, column):
        written = spark.read.schema(T.StructType().add(column, T.StringType())).parquet(folder)
        counts = {r[0]: r[1] for r in written.groupBy(column).count().collect()}
    rejected = counts.pop(REJECTED, 0)
    added = {m: (version, schema) for m in counts}
    if rejected:
        added[f"{REJECTED}{version}"] = (version, schema)
    _publish_list(spark, path, set(counts if months is None else months), added, base)
    return Written(sum(counts.values()), rejected)


def write_months(rows: DataFrame, path: str, column: str = "competencia", clustered: bool = False, layout: Layout = PLAIN) -> Written:
    """Replace the months that `rows` has; others stay as they are."""
    return _commit(rows, path, column, None, clustered, layout=layout)


def rebuild_partitions(
    rows: DataFrame, months: list[str], path: str, column: str = "competencia", clustered: bool = False, layout: Layout = PLAIN
) -> Written:
    """Write the listed months anew from `rows`, which holds all their source rows.

    A listed month without rows is removed. Rows without a period as their key are set aside and counted.
    """
    return _commit(rows, path, column, months, clustered, layout=layout) if months else Written(0, 0)


def read_rejects(spark: SparkSession, path: str, column: str = "competencia") -> DataFrame | None:
    """Rows that were set aside because their key is no period; None if there are none."""
    aside = {v: s for m, (v, s) in _listed(spark, path).items() if m.startswith(REJECTED)}
    if not aside:
        return None
    schema = _united(aside.values()).add(REJECTED_KEY, T.StringType())
    rows = spark.read.schema(schema).parquet(*[f"{path}/{DATA}/{VERSION}={v}/{column}={REJECTED}" for v in aside])
    return rows.withColumnRenamed(REJECTED_KEY, column)


def merge_partitions(
    delivered: DataFrame,
    path: str,
    key: str = "_ARQUIVO_ORIGEM",
    column: str = "competencia",
    delivered_files: DataFrame | None = None,
    clustered: bool = False,
    layout: Layout = PLAIN,
) -> Written:
    """Merge a delivery by source, rewriting only the months it touches.

    A source file belongs to one month, so all other months are neither read nor
    written. `delivered_files` (key and month columns) adds files without rows. Delivered rows without
    a period as their key are set aside and counted.
    """
    spark = delivered.sparkSession
    units = (delivered if delivered_files is None else delivered_files).select(key, column).distinct()
    months = month_list(units, column)
    base = _listed(spark, path)
    existing = _read_listed(spark, path, column, base, months)
    if existing is None:
        return _commit(delivered, path, column, months, clustered, base, layout)
    merged = merge_by_key(existing, delivered, key, delivered_keys=units, as_text=False)
    return _commit(merged, path, column, months, False, base, layout)


def month_batches(files: DataFrame, months: list[str], column: str, limit: int = BATCH_BYTES) -> list[list[str]]:
    """The months in order, in batches whose files (column bytes) have about `limit` bytes."""
    sizes = {r[0]: r[1] for r in files.where(F.col(column).isin(months)).groupBy(column).agg(F.sum("bytes")).collect()}
    batches: list[list[str]] = []
    size = limit
    for month in months:
        more = sizes.get(month) or 0
        if not batches or size + more > limit:
            batches.append([])
            size = 0
        batches[-1].append(month)
        size += more
    return batches


def rebuild_with_ledger(
    rows_of: Callable[[list[str]], tuple[DataFrame, DataFrame | None]],
    files: DataFrame,
    months: list[str],
    path: str,
    ledger_path: str,
    column: str = "competencia",
    batch_bytes: int = BATCH_BYTES,
    clustered: bool = False,
    total_bytes: int | None = None,
) -> Written:
    """Rebuild months from their source files; after each batch, record its files.

    `files` has key, fingerprint, bytes and the month column. `rows_of` gives, for some months, all their rows and the
    files (key, fingerprint, month) that were read well, or None if all were; a month of which no file was read well
    stays as it is, and only files that were read well enter the ledger. `total_bytes` of all files, where it is
    known, may show that one batch is enough. Data is written before the ledger, so a run that
    stops in between only repeats its last batch.
    """
    spark, rows, rejected = files.sparkSession, 0, 0
    all_fit = total_bytes is not None and total_bytes <= batch_bytes
    for part in [months] if all_fit else month_batches(files, months, column, batch_bytes):
        read, done = rows_of(part)
        asked = files.where(F.col(column).isin(part))
        written = rebuild_partitions(read, part if done is None else month_list(done, column), path, column, clustered)
        rows, rejected = rows + written.rows, rejected + written.rejected
        done = asked if done is None else done
        update_ledger(spark, ledger_path, lambda now, asked=asked, done=done: ledger_record(now, asked, done))
    return Written(rows, rejected)
