"""Fixed-width dBASE tables, read in record ranges by many tasks.

Headers are read first, by tasks, into a small written table: one row per file
with its layout or its error. Good files are cut into ranges of records, each
range is one task input, and the tasks hand Arrow batches of trimmed text to
Spark. Typed decoding happens afterwards in column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.functions.fields import is_plain_number, to_date, to_logical, tolerant_number
from lakeward.functions.text import blank_to_null, file_name
from lakeward.operators.conform import clean_name
from lakeward.session import settled_observed
from lakeward.sources.files import open_in_task

RECORDS_PER_RANGE = 250_000
RECORDS_PER_BATCH = 50_000
TASK_BYTES = 128 * 1024 * 1024
RANGE_COST = 4 * 1024 * 1024
LINEAGE = "_ARQUIVO_ORIGEM"

HEADER_TYPE = (
    "path string, bytes bigint, records bigint, header_length int, record_length int, "
    "fields array<struct<name:string,kind:string,first:int,width:int>>, error string"
)


@dataclass
class DbfHeaders:
    """The layouts of files that can be read, those set aside, and the types under which each column occurs."""

    good: DataFrame
    rejected: DataFrame
    kinds: dict[str, set[str]]
    n_rejected: int


@dataclass
class DbfScan:
    """Rows of the readable files; one row per file read; one row per file set aside."""

    rows: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def layout(path: str, size: int) -> tuple[int, int, int, list[dict]]:
    """Records, header length, record length and fields (name, kind, first, width) of a file, from its header."""
    import struct

    with open_in_task(path) as handle:
        start = handle.read(32)
        if len(start) < 32:
            raise ValueError("file is shorter than a header")
        records, header_length, record_length = struct.unpack_from("<IHH", start, 4)
        descriptors = handle.read(max(header_length - 32, 0))
    if size < header_length + records * record_length:
        raise ValueError("file ends before its last record")
    fields, first = [], 1
    for at in range(0, len(descriptors) - 31, 32):
        item = descriptors[at : at + 32]
        if item[0] == 0x0D:
            break
        # Other types (memo pointers, binary numbers) stay as they are written.
        kind = chr(item[11]) if chr(item[11]) in "CNDLF" else "C"
        name = item[:11].split(b"\x00", 1)[0].decode("latin-1")
        fields.append({"name": name, "kind": kind, "first": first, "width": item[16]})
        first += item[16]
    if not fields or first > record_length:
        raise ValueError("fields and record length do not agree")
    return records, header_length, record_length, fields


def scan_headers(files: DataFrame) -> DataFrame:
    """Layout or error of each file of an inventory (columns path, bytes)."""

    def read(batches):
        import pyarrow as pa

        fields_type = pa.list_(
            pa.struct([("name", pa.string()), ("kind", pa.string()), ("first", pa.int32()), ("width", pa.int32())])
        )
        for batch in batches:
            out = {name: [] for name in ("path", "bytes", "records", "header_length", "record_length", "fields", "error")}
            for path, size in zip(batch.column("path").to_pylist(), batch.column("bytes").to_pylist()):
                try:
                    found, error = layout(path, size), None
                except Exception as problem:  # noqa: BLE001 - reported per file
                    found, error = (None, None, None, None), f"{type(problem).__name__}: {problem}"
                for name, value in zip(out, (path, size, *found, error)):
                    out[name].append(value)
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), fields_type, pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out.values(), types)], list(out)
            )

    return files.select("path", "bytes").mapInArrow(read, HEADER_TYPE)


def record_batches(item: dict, columns: list[str], carried: list[str], encoding: str, batch_records: int):
    """Arrow batches of a range of records as trimmed text, each with the carried values of its file.

    `item` has path, header_length, record_length, fields, start and count, and the carried values. Only the bytes of `columns` are decoded.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def text(cells):
        data = np.ascontiguousarray(cells)
        if data.size and data.view(np.uint8).max() > 127:
            column = pa.array(np.char.decode(data, encoding, "replace"), pa.string())
        else:
            column = pa.array(data, pa.binary()).cast(pa.string())
        column = pc.ascii_trim_whitespace(column)
        return pc.if_else(pc.equal(column, ""), pa.scalar(None, pa.string()), column)

    cut = {_column(f["name"]): f for f in item["fields"]}
    present = [c for c in columns if c in cut]
    record = np.dtype(
        {
            "names": ["flag", *[f"f{i}" for i in range(len(present))]],
            "formats": ["S1", *[f"S{cut[c]['width']}" for c in present]],
            "offsets": [0, *[cut[c]["first"] for c in present]],
            "itemsize": item["record_length"],
        }
    )
    with open_in_task(item["path"]) as handle:
        handle.seek(item["header_length"] + item["start"] * item["record_length"])
        left = item["count"]
        while left:
            n = min(left, batch_records)
            raw = handle.read(n * item["record_length"])
            if len(raw) < n * item["record_length"]:
                raise OSError(f"{item['path']} changed while it was read")
            rows = np.frombuffer(raw, dtype=record)
            rows = rows[rows["flag"] == b" "]
            left -= n
            cells = {c: text(rows[f"f{i}"]) for i, c in enumerate(present)}
            empty = pa.nulls(len(rows), pa.string())
            tags = [pa.repeat(pa.scalar(item[c], pa.string()), len(rows)) for c in carried]
            yield pa.RecordBatch.from_arrays([*[cells.get(c, empty) for c in columns], *tags], [*columns, *carried])


def _decode_ranges(
    ranges: DataFrame, columns: list[str], carried: list[str], encoding: str, batch_records: int
) -> DataFrame:
    """Read the records of each (path, start, count) row as trimmed text columns,
    each with the carried values of its file."""

    def read(batches):
        for batch in batches:
            for item in batch.to_pylist():
                yield from record_batches(item, columns, carried, encoding, batch_records)

    schema = ", ".join(f"`{c}` string" for c in [*columns, *carried])
    return ranges.mapInArrow(read, schema)


def read_headers(files: DataFrame) -> DbfHeaders:
    """The headers of an inventory (path, bytes), read once; columns are known by their upper-case name."""
    headers, seen = settled_observed(scan_headers(files), "dbf-headers", n_rejected=F.count("error"))
    good = headers.where(F.col("error").isNull())
    # One row per distinct (field, type), in order of first position.
    fields = (
        good.select(F.explode("fields").alias("f"))
        .groupBy(F.col("f.name").alias("name"), F.col("f.kind").alias("kind"))
        .agg(F.min("f.first").alias("first"))
        .collect()
    )
    kinds: dict[str, set[str]] = {}
    for field in sorted(fields, key=lambda f: (f["first"], f["name"])):
        kinds.setdefault(_column(field["name"]), set()).add(field["kind"])
    rejected = headers.where(F.col("error").isNotNull())
    named = rejected.select("path", file_name("path").alias("name"), "bytes", "error")
    return DbfHeaders(good, named, kinds, seen["n_rejected"])


def _column(name: str) -> str:
    return clean_name(name).upper()


def _dealt(ranges: DataFrame, order_by: str | None) -> DataFrame:
    """Record ranges in tasks of about TASK_BYTES each, neighbours together.

    The cost of the ranges before each one, in the order of the files, gives its task: summed
    within a value of `order_by`, such as a month, after the totals of the values before, which a calendar bounds.
    """
    if order_by is None:
        n_tasks = ranges.agg(F.ceil(F.sum("cost") / TASK_BYTES)).first()[0] or 1
        return ranges.repartitionByRange(int(n_tasks), "path", "start")
    totals = ranges.groupBy(order_by).agg(F.sum("cost").alias("cost")).collect()
    before, offset = 0, {}
    for row in sorted(totals, key=lambda r: (r[0] is not None, r[0])):
        offset[row[0]] = before
        before += row["cost"]
    starts = F.lit(offset.pop(None, 0))
    if offset:
        known = F.create_map(*[F.lit(x) for pair in offset.items() for x in pair])
        starts = F.coalesce(F.try_element_at(known, F.col(order_by)), starts)
    so_far = F.sum("cost").over(Window.partitionBy(order_by).orderBy("path", "start")) - F.col("cost")
    placed = ranges.withColumn("task", F.floor((starts + so_far) / TASK_BYTES).cast("int"))
    return placed.repartitionById(before // TASK_BYTES + 1, "task")


def scan_dbf(
    files: DataFrame,
    columns: list[str] | None = None,
    carry: tuple[str, ...] = (LINEAGE,),
    order_by: str | None = None,
    encoding: str = "latin-1",
    range_records: int = RECORDS_PER_RANGE,
    batch_records: int = RECORDS_PER_BATCH,
    headers: DbfHeaders | None = None,
) -> DbfScan:
    """Union by name of the dBASE files of an inventory: conformed text, tagged by file.

    `columns` limits what is decoded. `carry` names text columns of the inventory
    that each row gets from its file; the lineage is the file name unless the
    inventory has it. `order_by` names a column of the inventory, such as the
    month: tasks then read neighbouring files, so that their rows can be written
    by month without a shuffle. `headers` are those of these files and perhaps others, where they were read before. Deleted records are left out. Names are
    compared and shown in upper case. Dates come as
    ``YYYY-MM-DD``, logicals as ``True``/``False``, numbers as written; a name
    whose type differs between files stays as written.
    """
    if LINEAGE not in files.columns:
        files = files.withColumn(LINEAGE, file_name("path"))
    headers = headers or read_headers(files)
    extra = list(dict.fromkeys([*carry, *([order_by] if order_by else [])]))
    known = headers.good.join(files.select("path", *extra), "path")
    names = [n for n in headers.kinds if columns is None or n in columns]

    # Ranges of small files share tasks: each counts as a few megabytes at least.
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1, F.lit(range_records).cast("bigint"))
    ranges = (
        known.where("records > 0")
        .select(*extra, "path", "header_length", "record_length", "fields", "records", F.explode(starts).alias("start"))
        .withColumn("count", F.least(F.lit(range_records).cast("bigint"), F.col("records") - F.col("start")))
        .withColumn("cost", F.greatest(F.col("count") * F.col("record_length"), F.lit(RANGE_COST)).cast("bigint"))
    )
    decoded = _decode_ranges(_dealt(ranges, order_by), names, list(carry), encoding, batch_records)
    of_files = files.select("path")
    return DbfScan(
        rows=decoded.select(*[published_text(n, headers.kinds[n]).alias(n) for n in names], *carry),
        accepted=headers.good.join(of_files, "path", "left_semi").select("path", file_name("path").alias("name"), "bytes", "records"),
        rejected=headers.rejected.join(of_files, "path", "left_semi"),
    )


def published_text(name: str, kinds: set[str]):
    """Text of a decoded cell, which is trimmed and not empty."""
    value = F.col(f"`{name}`")
    if kinds == {"D"}:
        return to_date(value).cast("string")
    if kinds == {"L"}:
        return F.initcap(to_logical(value).cast("string"))
    if kinds <= {"N", "F"}:
        # Only what is no plain number is looked at more closely.
        return F.when(is_plain_number(value), value).otherwise(blank_to_null(tolerant_number(value)))
    return blank_to_null(value)
