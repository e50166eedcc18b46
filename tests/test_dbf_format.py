"""dBASE tables as a data source: files and fields that are not asked for are not read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeward.sources.dbf import LINEAGE, read_headers, scan_dbf
from lakeward.sources.dbf_format import DbfFormat, dbf_schema, read_dbf
from lakeward.sources.files import scan_file_inventory
from tests.conftest import dbf_bytes, plan_of, rows_of

FIELDS = [("Nome", "C", 6), ("VALOR", "N", 8), ("DATA", "D", 8), ("OK", "L", 1)]
PERIOD = r"^[A-Z]{4}([0-9]{2})([0-9]{2})"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "PASP9912.dbf").write_bytes(dbf_bytes(FIELDS, [["é a", "1,5", "19991231", "T"], ["gone", "2", "", "F"]], deleted=[1]))
    (tmp_path / "sub" / "PARJ0001.DBF").write_bytes(dbf_bytes(FIELDS[:2], [["b", " 7"], ["", "x"]]))
    (tmp_path / "PASP0002.dbf").write_bytes(dbf_bytes([*FIELDS, ("NOVO", "C", 2)], [["c", "3.0", "00000000", "?", "zz"]] * 50))
    (tmp_path / "PABA0003.dbf").write_bytes(b"broken")
    (tmp_path / "notes.txt").write_text("no")
    return str(tmp_path)


def good(folder):
    return f"{LINEAGE} <> 'PABA0003.DBF'"


def test_equals_the_scan_of_an_inventory(spark, folder):
    files = scan_file_inventory(spark, folder, glob="*.[dD][bB][fF]")
    scan = scan_dbf(files.withColumn(LINEAGE, F.upper("name")))
    rows = read_dbf(spark, folder, period=PERIOD).where("competencia <= '200002'")
    assert rows.columns == [*scan.rows.columns, "competencia"]
    assert rows_of(rows.drop("competencia")) == rows_of(scan.rows) and rows.count() == 53
    assert {(r[LINEAGE], r["competencia"]) for r in rows.collect()} == {("PASP9912.DBF", "199912"), ("PARJ0001.DBF", "200001"), ("PASP0002.DBF", "200002")}


@pytest.mark.parametrize(
    ("condition", "count"),
    [
        ("competencia = '199912'", 1), ("competencia in ('199912', '200001')", 3), ("competencia between '200001' and '200002'", 52),
        (f"{LINEAGE} = 'PARJ0001.DBF' and VALOR = '7'", 1), (f"startswith({LINEAGE}, 'PASP')", 51), ("competencia > '200002' and competencia < '200003'", 0),
    ],
)
def test_files_that_are_not_asked_for_are_not_opened(spark, folder, condition, count):
    headers = read_headers(scan_file_inventory(spark, folder, glob="*.[dD][bB][fF]"))
    rows = read_dbf(spark, folder, dbf_schema(headers, months=True), period=PERIOD)
    with pytest.raises(Exception, match="shorter than a header"):
        rows.collect()
    assert rows.where(condition).count() == count


def test_conditions_that_spark_still_has_to_check(spark, folder):
    rows = read_dbf(spark, folder, period=PERIOD).where("competencia < '200003' and NOME = 'c'")
    plan = plan_of(rows)
    assert "NOME" in plan.split("Physical Plan")[1] and "(competencia" not in plan.split("Physical Plan")[1].split("BatchScan")[0]
    assert rows.count() == 50


def test_only_the_columns_of_the_schema_are_decoded(spark, folder):
    headers = read_headers(scan_file_inventory(spark, folder, glob="PASP*"))
    schema = dbf_schema(headers, ["VALOR", "NOVO"])
    assert schema.fieldNames() == ["VALOR", "NOVO", LINEAGE]
    rows = read_dbf(spark, f"{folder}/PASP9912.dbf", schema)
    assert rows_of(rows) == [("1,5", None, "PASP9912.DBF")] or rows_of(rows) == [("1.5", None, "PASP9912.DBF")]
    reader = DbfFormat({"path": f"{folder}/PASP0002.dbf"}).reader(schema)
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert [b.schema.names for b in batches] == [["VALOR", "NOVO", LINEAGE]]


def test_large_files_are_cut_and_small_ones_share_a_task(spark, folder):
    reader = DbfFormat({"path": f"{folder}/PASP0002.dbf", "task_bytes": "300"}).reader(dbf_schema(read_headers(scan_file_inventory(spark, folder, glob="PASP*"))))
    parts = reader.partitions()
    assert len(parts) > 3 and sum(b.num_rows for p in parts for b in reader.read(p)) == 50
    together = DbfFormat({"path": folder}).reader(reader_schema := DbfFormat({"path": folder}).schema()).partitions()
    assert len(together) == 1 and len(together[0].value) == 4 and LINEAGE in reader_schema.fieldNames()
