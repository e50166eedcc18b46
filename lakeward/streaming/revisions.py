"""A stream of file events: files that arrive, and files that are written again under the same name.

Spark's own file stream takes each path once. This source lists the landing folder, keeps each listing with the size and time of
every file, and offers the difference of two listings as rows. An offset is the number of a listing, so the offset log
stays small and a batch that is run again after a failure sees the same events. The rows say which files to read;
reading them is left to the usual readers, which do it in many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lakeward.functions.text import file_name
from lakeward.operators.partitions import merge_partitions
from lakeward.operators.sizing import join_small
from lakeward.session import settled
from lakeward.sinks.tables import publish_table, read_published
from lakeward.sources.dbf import LINEAGE
from lakeward.sources.files import arrow_path

FORMAT = "file_events"
SCHEMA = "path string, bytes bigint, mtime bigint, status string"
# Events of one task.
PER_TASK = 10_000
_LISTING = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("mtime", pa.int64())])


class FileEvents(DataSource):
    """Options: path (the landing folder), listings (a shared folder for the listings), suffix (of the files, any case)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> FileEventReader:
        return FileEventReader(self.options["path"], self.options["listings"], self.options.get("suffix", ""))


class FileEventReader(DataSourceStreamReader):
    def __init__(self, landing: str, listings: str, suffix: str):
        self.landing, self.listings, self.suffix = landing, listings, suffix.lower()

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        """The number of the last listing, or of a new one if the folder differs from it."""
        last = max(self._kept(), default=0)
        seen = self._listed()
        if seen == self._load(last):
            return {"listing": last}
        self._save(last + 1, seen)
        return {"listing": last + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, after = self._load(start["listing"]), self._load(end["listing"])
        events = [(p, *after[p], "changed" if p in before else "new") for p in sorted(after) if before.get(p) != after[p]]
        return [InputPartition(events[i : i + PER_TASK]) for i in range(0, len(events) or 1, PER_TASK)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.value

    def commit(self, end: dict) -> None:
        """Listings before the committed one are not asked for again."""
        system, folder = arrow_path(self.listings)
        for n in self._kept():
            if n < end["listing"]:
                system.delete_file(f"{folder}/{n:08d}.parquet")

    def _listed(self) -> dict[str, tuple[int, int]]:
        from pyarrow import fs

        system, folder = arrow_path(self.landing)
        found = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        scheme = self.landing[: len(self.landing) - len(folder)] if self.landing.endswith(folder) else ""
        return {
            f"{scheme}{f.path}": (f.size, f.mtime_ns or 0)
            for f in found
            if f.type == fs.FileType.File and f.path.lower().endswith(self.suffix) and not f.base_name.startswith((".", "_"))
        }

    def _kept(self) -> list[int]:
        from pyarrow import fs

        system, folder = arrow_path(self.listings)
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [int(f.base_name[:8]) for f in found if f.base_name.endswith(".parquet")]

    def _load(self, n: int) -> dict[str, tuple[int, int]]:
        if not n:
            return {}
        system, folder = arrow_path(self.listings)
        with system.open_input_file(f"{folder}/{n:08d}.parquet") as handle:
            rows = pq.read_table(handle).to_pydict()
        return dict(zip(rows["path"], zip(rows["bytes"], rows["mtime"], strict=True), strict=True))

    def _save(self, n: int, seen: dict[str, tuple[int, int]]) -> None:
        """A listing appears under its number only when it is whole."""
        system, folder = arrow_path(self.listings)
        system.create_dir(folder, recursive=True)
        columns = [list(seen), [b for b, _ in seen.values()], [m for _, m in seen.values()]]
        begun = f"{folder}/{n:08d}.begun"
        with system.open_output_stream(begun) as handle:
            pq.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, _LISTING.types, strict=True)], schema=_LISTING), handle)
        system.move(begun, f"{folder}/{n:08d}.parquet")


def file_events(spark: SparkSession, landing: str, listings: str, suffix: str = "") -> DataFrame:
    """The stream of files (path, bytes, mtime, status: new or changed) of a landing folder."""
    spark.dataSource.register(FileEvents)
    return spark.readStream.format(FORMAT).options(path=landing, listings=listings, suffix=suffix).load()


def stream_revised_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    read: Callable[[DataFrame], DataFrame],
    suffix: str = "",
    lineage: Callable[[str], Column] = file_name,
    column: str = "competencia",
) -> None:
    """Take all files that arrived or were written again since the last call, then stop.

    `read` makes rows of an inventory (path, name, bytes, lineage), with the lineage of their file and the period column; `lineage` makes
    that of a path. The rows replace all earlier rows of their files, in whichever periods these lie, also where a file has no rows any more:
    which periods each file has is kept in a small table beside the data, written after it. A batch that is run again
    after a failure replaces what its first attempt wrote. A file that is gone from the folder keeps its rows.
    """
    spans = f"{target}/_spans"

    def take(events: DataFrame, _: int) -> None:
        files = settled(events.select("path", file_name("path").alias("name"), "bytes", lineage("path").alias(LINEAGE)), "events")
        if files.isEmpty():
            return
        rows = settled(read(files), "arrivals")
        now = settled(rows.select(LINEAGE, column).distinct(), "spans")
        known = read_published(spark, spans)
        if known is None:
            merge_partitions(rows, target, LINEAGE, column, delivered_files=now)
            publish_table(now, spans)
            return
        asked = files.select(F.upper(LINEAGE).alias("_asked")).distinct()
        before = join_small(known, asked, F.upper(LINEAGE), "_asked", "left_semi")
        merge_partitions(rows, target, LINEAGE, column, delivered_files=now.unionByName(before).distinct())
        publish_table(join_small(known, asked, F.upper(LINEAGE), "_asked", "left_anti").unionByName(now), spans)

    (
        file_events(spark, landing, f"{checkpoint}/listings", suffix)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )

