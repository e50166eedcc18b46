"""dBASE tables as a data source of Spark: ``spark.read.format("dbf")``.

A plan needs only the listing: a condition on the file's name or month is answered from it, so the other files are not
opened, and each task reads the headers of its own files. Only the columns of the given schema are decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith,
)

from lakeward.sources.dbf import LINEAGE, RECORDS_PER_BATCH, TASK_BYTES, DbfHeaders, _column, layout, published_text, record_batches
from lakeward.sources.files import arrow_path

FORMAT, MONTH, KINDS = "dbf", "competencia", "kinds"
# Threads that read headers where no schema is given, and bytes that a small file counts as in a task.
HEADER_THREADS, FILE_COST = 16, 4 << 20
# Two-digit years from this one on are of the last century, unless the option says otherwise.
PIVOT = 70

_TESTS = {
    EqualTo: lambda v, x: v == x,
    EqualNullSafe: lambda v, x: v == x,
    In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x,
    GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x,
    LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x),
    StringEndsWith: lambda v, x: v.endswith(x),
}


class DbfFormat(DataSource):
    """Options: path (a folder or file), period (a pattern whose two groups are year and month in a file's name), pivot (the first
    two-digit year of the last century), encoding, task_bytes. Columns: the fields as trimmed text, as written, then the lineage (the file's name in capitals) and,
    with a pattern, the month."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        """The fields of all files, from their headers. Pass a schema (see `dbf_schema`) to open none."""

        def fields(file: dict) -> list[dict]:
            try:
                return layout(file["path"], file["bytes"])[3]
            except (OSError, ValueError):
                return []

        kinds: dict[str, set[str]] = {}
        with ThreadPoolExecutor(HEADER_THREADS) as pool:
            for found in pool.map(fields, listed(self.options)):
                for field in found:
                    kinds.setdefault(_column(field["name"]), set()).add(field["kind"])
        return _schema(kinds, list(kinds), "period" in self.options)

    def reader(self, schema: T.StructType) -> DbfReader:
        return DbfReader(dict(self.options), schema.fieldNames())


class DbfReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.options, self.columns = options, columns
        self.asked: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on lineage and month are answered from the listing, and wholly; all others are Spark's."""
        for f in filters:
            on_file = getattr(f, "attribute", None) in ((LINEAGE,), (MONTH,))
            if on_file and (type(f) in _TESTS or isinstance(f, IsNotNull)):
                self.asked.append(f)
            else:
                yield f

    def _passes(self, file: dict) -> bool:
        for f in self.asked:
            value = file[f.attribute[0]]
            if isinstance(f, EqualNullSafe) and f.value is None:
                if value is not None:
                    return False
            elif value is None or not (isinstance(f, IsNotNull) or _TESTS[type(f)](value, f.value)):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        """Files in the order of their names in tasks of about task_bytes; a larger file is cut into even parts."""
        limit = int(self.options.get("task_bytes", TASK_BYTES))
        tasks: list[list[tuple]] = []
        room = 0
        for file in listed(self.options):
            if not self._passes(file):
                continue
            parts = max(1, -(-file["bytes"] // limit))
            for part in range(parts):
                cost = max(min(FILE_COST, limit), file["bytes"] // parts)
                if cost > room:
                    tasks.append([])
                    room = limit
                room -= cost
                tasks[-1].append((file, part, parts))
        return [InputPartition(task) for task in tasks or [[]]]

    def read(self, partition: InputPartition) -> Iterator:
        tags = [c for c in self.columns if c in (LINEAGE, MONTH)]
        fields = [c for c in self.columns if c not in tags]
        encoding = self.options.get("encoding", "latin-1")
        for file, part, parts in partition.value:
            records, header_length, record_length, found = layout(file["path"], file["bytes"])
            start = records * part // parts
            item = file | {
                "header_length": header_length, "record_length": record_length, "fields": found,
                "start": start, "count": records * (part + 1) // parts - start,
            }
            for batch in record_batches(item, fields, tags, encoding, RECORDS_PER_BATCH):
                yield batch.select(self.columns)


def listed(options: dict[str, str]) -> list[dict]:
    """The files of the folder: path, bytes, lineage and month, by name."""
    from pyarrow import fs

    system, where = arrow_path(options["path"])
    found = system.get_file_info(where)
    if found.type == fs.FileType.Directory:
        files = [f for f in system.get_file_info(fs.FileSelector(where, recursive=True)) if f.type == fs.FileType.File]
    else:
        files = [found]
    scheme = options["path"][: len(options["path"]) - len(where)] if options["path"].endswith(where) else ""
    out = []
    for f in files:
        if f.path.lower().endswith(".dbf") and not f.base_name.startswith((".", "_")):
            out.append({"path": f"{scheme}{f.path}", "bytes": f.size, LINEAGE: f.base_name.upper(), MONTH: _month(f.base_name, options)})
    return sorted(out, key=lambda f: (f[LINEAGE], f["path"]))


def _month(name: str, options: dict[str, str]) -> str | None:
    match = re.search(options["period"], name.upper()) if "period" in options else None
    if not match:
        return None
    year, month = match[1], match[2]
    if len(year) == 2:
        year = ("19" if int(year) >= int(options.get("pivot", PIVOT)) else "20") + year
    return year + month


def _schema(kinds: dict[str, set[str]], columns: list[str], months: bool) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True, {KINDS: "".join(sorted(kinds[c]))}) for c in columns if c in kinds]
    tags = [LINEAGE, MONTH] if months else [LINEAGE]
    return T.StructType([*fields, *[T.StructField(t, T.StringType()) for t in tags]])


def dbf_schema(headers: DbfHeaders, columns: list[str] | None = None, months: bool = False) -> T.StructType:
    """The schema of files whose headers were read, in many tasks, by `read_headers`: all their columns, or some."""
    return _schema(headers.kinds, [c for c in headers.kinds if columns is None or c in columns], months)


def read_dbf(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """The tables below a folder in conformed text: dates as ``YYYY-MM-DD``, logicals as ``True``/``False``, numbers as written.

    A name whose type differs between files stays as written. Conditions on the lineage and, with `period`, the month
    are answered from the file names.
    """
    spark.dataSource.register(DbfFormat)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format(FORMAT).options(**options)
    raw = (reader.schema(schema) if schema is not None else reader).load(path)
    known = {f.name: set(f.metadata.get(KINDS, "")) for f in (schema if schema is not None else raw.schema)}
    return raw.select(*[published_text(c, known[c]).alias(c) if known[c] else raw[c] for c in raw.columns])
