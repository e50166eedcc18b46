"""File listings, row counts per file, and small reads of file heads in tasks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.text import file_name
from lakeward.sinks.tables import hadoop_path

# Bytes that are hashed together, ranges of one task, and files that cost as much to open as a range to read.
RANGE_BYTES, RANGES, FILES = 64 << 20, 4, 64


def path_list(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def scan_file_inventory(
    spark: SparkSession, paths: str | Iterable[str], glob: str | None = None
) -> DataFrame:
    """One row per file: path, name, bytes, mtime. No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listing = reader.load(path_list(paths))
    return listing.select(
        "path",
        file_name("path").alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("mtime"),
    )


def plain_path(encoded: Column) -> Column:
    """A `_metadata.file_path`, in which some characters are encoded, as listings show it."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def content_hashes(
    spark: SparkSession, paths: str | Iterable[str], glob: str | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """A hash of each file (path, name, md5), read in ranges of bytes by many tasks. Reads every byte, so use it where sizes cannot tell.

    A file of one range has its own MD5. A larger one has the MD5 of the digests of its ranges, in their order, with their
    number behind a dash; it depends on `range_bytes`, which must stay the same between runs that are compared. A file that
    changes its size while it is read fails.
    """
    files = scan_file_inventory(spark, paths, glob)
    parts = F.greatest(F.lit(1), F.ceil(F.col("bytes") / range_bytes)).cast("bigint")
    ranges = files.select("path", "bytes", parts.alias("parts"), F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
    # Ranges of one file go to different tasks, small files share them.
    cost = F.ceil(F.sum(F.least(F.col("bytes") / range_bytes, F.lit(1.0)) + 1 / FILES) / RANGES)
    dealt = ranges.repartition(max(1, int(ranges.agg(cost).first()[0] or 0)), F.xxhash64("path", "part"))

    def read(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            digests = []
            for row in rows:
                digest, left = hashlib.md5(), min(range_bytes, row["bytes"] - row["part"] * range_bytes)
                with open_in_task(row["path"]) as handle:
                    handle.seek(row["part"] * range_bytes)
                    while left > 0:
                        block = handle.read(min(left, 1 << 20))
                        if not block:
                            raise OSError(f"{row['path']} changed while it was read")
                        digest.update(block)
                        left -= len(block)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("path", "part", "parts")), pa.array(digests, pa.string())], ["path", "part", "parts", "digest"])

    hashed = dealt.mapInArrow(read, "path string, part bigint, parts bigint, digest string")
    ordered = F.array_sort(F.collect_list(F.struct("part", "digest")))
    whole = hashed.groupBy("path").agg(ordered.alias("d"), F.max("parts").alias("n"))
    tree = F.concat(F.md5(F.array_join("d.digest", "").cast("binary")), F.lit("-"), F.col("n").cast("string"))
    return whole.select("path", file_name("path").alias("name"), F.when(F.col("n") == 1, F.col("d")[0]["digest"]).otherwise(tree).alias("md5"))


def scan_row_counts(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Rows of each Parquet file that has any, from the footers: no column is read."""
    table = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", False)
        .parquet(*path_list(paths))
    )
    counts = table.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(plain_path(F.col("path")).alias("path"), "rows")


def table_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows of each table (name, rows) directly below a folder: of a Parquet file, or of all the files in a folder of them.

    A table whose files have no rows counts zero.
    """
    system, where = hadoop_path(spark, root)
    base = system.makeQualified(where).toString().rstrip("/") + "/"
    files = scan_file_inventory(spark, root, glob="*.parquet").join(scan_row_counts(spark, root), "path", "left")
    message = F.concat(F.lit(f"not below {base}: "), F.col("path"))
    below = F.when(F.startswith("path", F.lit(base)), F.substring("path", len(base) + 1, 1 << 20)).otherwise(F.raise_error(message))
    total = F.sum(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows")
    return files.groupBy(F.substring_index(below, "/", 1).alias("name")).agg(total)


def arrow_path(path: str):
    """(file system, inner path) of a Spark path, for use inside tasks."""
    import re
    import urllib.parse

    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), urllib.parse.unquote("/" + path[len("file:"):].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def open_in_task(path: str):
    """Random-access handle on a file of any file system that Arrow knows."""
    system, inner = arrow_path(path)
    return system.open_input_file(inner)


def scan_first_lines(files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """First line of each text file of an inventory: (path, line, error).

    Reads one block per file inside tasks; a file that cannot be read keeps its
    error and does not stop the others.
    """

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            paths = batch.column("path").to_pylist()
            lines, errors = [], []
            for path in paths:
                try:
                    with open_in_task(path) as handle:
                        head = b""
                        while b"\n" not in head:
                            block = handle.read(65536)
                            if not block:
                                break
                            head += block
                    text = head.split(b"\n", 1)[0].decode(encoding).rstrip("\r")
                    lines.append(text.removeprefix("\ufeff"))
                    errors.append(None)
                except Exception as problem:  # noqa: BLE001 - reported per file
                    lines.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(lines, pa.string()), pa.array(errors, pa.string())],
                ["path", "line", "error"],
            )

    return files.select("path").mapInArrow(read, "path string, line string, error string")
