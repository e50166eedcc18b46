"""Files that are written again under the same name are seen by the stream."""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeward.operators.partitions import read_months
from lakeward.sinks.tables import read_published
from lakeward.sources.dbf import LINEAGE
from lakeward.streaming import revisions
from lakeward.streaming.revisions import FileEventReader, stream_revised_files
from tests.conftest import rows_of


@pytest.fixture
def lake(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    os.makedirs(landing)

    def put(name, *rows):
        n, month = zip(*rows, strict=True) if rows else ((), ())
        pq.write_table(pa.table({"n": pa.array(n, pa.int32()), "competencia": pa.array(month, pa.string())}), f"{landing}/{name}.parquet")

    def read(files):
        paths = [r["path"] for r in files.collect()]
        rows = spark.read.schema("n int, competencia string").parquet(*paths)
        return rows.withColumn(LINEAGE, F.col("_metadata.file_name"))

    def arrive():
        stream_revised_files(spark, landing, target, state, read, suffix=".parquet")
        return rows_of(read_months(spark, target).select("n", "competencia"))

    return put, arrive, target, landing


def test_revisions_in_place(lake, spark):
    put, arrive, target, _ = lake
    put("a", (1, "202401"), (2, "202402"))
    put("b", (3, "202402"))
    assert arrive() == [(1, "202401"), (2, "202402"), (3, "202402")]
    versions = len(os.listdir(f"{target}/data"))
    assert arrive() == [(1, "202401"), (2, "202402"), (3, "202402")] and len(os.listdir(f"{target}/data")) == versions
    # The revision leaves a month: its rows there go too.
    put("a", (4, "202403"))
    assert arrive() == [(3, "202402"), (4, "202403")]
    put("a")
    put("c", (5, "202401"))
    assert arrive() == [(3, "202402"), (5, "202401")]
    assert rows_of(read_published(spark, f"{target}/_spans")) == [("b.parquet", "202402"), ("c.parquet", "202401")]


def test_a_batch_that_fails_is_run_again(lake, monkeypatch):
    put, arrive, _, _ = lake
    put("a", (1, "202401"))
    arrive()
    put("a", (2, "202402"))
    real = revisions.publish_table

    def dies(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(revisions, "publish_table", dies)
    with pytest.raises(Exception, match="lost"):
        arrive()
    monkeypatch.setattr(revisions, "publish_table", real)
    assert arrive() == [(2, "202402")]


def test_listings(tmp_path):
    landing, kept = tmp_path / "in", tmp_path / "kept"
    (landing / "sub").mkdir(parents=True)
    reader = FileEventReader(str(landing), str(kept), ".DBF")
    assert reader.latestOffset() == reader.initialOffset()
    (landing / "a.dbf").write_text("1")
    (landing / "sub" / "b.DBF").write_text("22")
    (landing / "c.txt").write_text("no")
    (landing / "_d.dbf").write_text("no")
    first = reader.latestOffset()
    assert first == {"listing": 1} == reader.latestOffset()
    events = [e for p in reader.partitions({"listing": 0}, first) for e in reader.read(p)]
    assert [(e[0].rsplit("/", 1)[1], e[1], e[3]) for e in events] == [("a.dbf", 1, "new"), ("b.DBF", 2, "new")]
    os.utime(landing / "a.dbf", ns=(1, 1))  # written again in the same size
    second = reader.latestOffset()
    again = [e for p in reader.partitions(first, second) for e in reader.read(p)]
    assert [(e[0].rsplit("/", 1)[1], e[3]) for e in again] == [("a.dbf", "changed")]
    reader.commit(second)
    assert sorted(os.listdir(kept)) == ["00000002.parquet"]
    assert FileEventReader(str(landing), str(kept), ".dbf").latestOffset() == second
