"""Months that are not asked for are not opened: their files are broken here."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeward.operators.partitions import write_months
from lakeward.sources.parquet import scan_calendar, scan_months
from tests.conftest import plan_of, rows_of


@pytest.fixture
def table(spark, tmp_path):
    """Twelve months, of which only the first three can be read."""
    path = str(tmp_path / "t")
    rows = spark.range(120).select(F.col("id").alias("n"), F.concat(F.lit("2024"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("competencia"))
    write_months(rows, path)
    for file in Path(path).rglob("*.parquet"):
        if "competencia=" in str(file) and file.parent.name > "competencia=202403":
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    return path


def calendar(spark, *months):
    return spark.createDataFrame([(m, int(m[-2:])) for m in months], "competencia string, number int")


def test_the_fixture_breaks_the_other_months(spark, table):
    with pytest.raises(Exception):  # noqa: B017 - any reader error
        scan_months(spark, table).agg(F.sum("n")).collect()


def test_a_filter(spark, table):
    rows = scan_months(spark, table).where("competencia < '202403' and n > 11")
    assert rows.agg(F.count("n")).first()[0] == 18
    assert "PartitionFilters: [isnotnull(competencia" in plan_of(rows)


def test_a_joined_table_of_months(spark, table, tmp_path):
    calendar(spark, "202401", "202403", "202408").write.parquet(str(tmp_path / "c"))
    months = spark.read.parquet(str(tmp_path / "c")).where("number < 5")
    rows = scan_months(spark, table).join(F.broadcast(months), "competencia")
    assert rows.agg(F.count("n")).first()[0] == 20
    assert "dynamicpruning" in plan_of(rows)


def test_a_calendar_of_any_plan(spark, table, monkeypatch):
    from lakeward.operators import sizing

    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1)  # the join shuffles, so nothing could be pruned from it
    months = calendar(spark, "202401", "202403", "202403", "203001", "none00").groupBy("competencia").agg(F.max("number").alias("number"))
    rows = scan_calendar(spark, table, months)
    assert rows.columns == ["n", "competencia", "number"]
    assert rows_of(rows.groupBy("competencia", "number").count()) == [("202401", 1, 10), ("202403", 3, 10)]
    twice = scan_calendar(spark, table, calendar(spark, "202402", "202402"))
    assert twice.count() == 20
    assert scan_calendar(spark, table, calendar(spark, "203001")).collect() == []
