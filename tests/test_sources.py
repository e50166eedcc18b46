"""Readers on small deliveries written by the tests themselves."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakeward.operators.conform import align_to, clean_column_names, conform, exclude_columns, union_by_name
from lakeward.operators.partitions import write_months
from lakeward.sinks.tables import publish_text, write_csv
from lakeward.sources.dbf import LINEAGE, scan_dbf
from lakeward.sources.delimited import scan_csv_union_by_header, scan_delimited, scan_delimited_with_rejects
from lakeward.sources.files import content_hashes, scan_file_inventory, scan_row_counts, table_row_counts
from lakeward.sources.json_arrays import scan_header_first_json, scan_population
from lakeward.sources.parquet import scan_month_range, scan_parquet_union_by_name
from lakeward.sources.rawtext import apply_layout, scan_raw_text
from tests.conftest import dbf_bytes, plan_of, rows_of

# ---- delimited text ----------------------------------------------------------


@pytest.fixture
def establishments(tmp_path):
    path = tmp_path / "estab.csv"
    text = 'CO_CNES;NO_RAZÃO;CO_UF\n0012;São João;35\n0013;short\n0014;a;b;long\n0015;"with;sep";33\n0016;;\n'
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CO;NO\n1;x\n")
    (tmp_path / "b.csv").write_text("NO;CO\ny;2\nz\n")
    (tmp_path / "c.csv").write_text("")
    good, rejected = scan_delimited_with_rejects(spark, str(tmp_path))
    assert rows_of(good.select("CO", "NO")) == [("1", "x"), ("2", "y")] and rows_of(rejected) == [("b.csv", "z")]


def test_bad_lines_are_dropped(spark, establishments):
    rows = scan_delimited(spark, establishments)
    assert rows.columns == ["CO_CNES", "NO_RAZÃO", "CO_UF"] and {t for _, t in rows.dtypes} == {"string"}
    assert rows_of(rows) == [("0012", "São João", "35"), ("0015", "with;sep", "33"), ("0016", None, None)]


def test_bad_lines_stay_dropped_when_columns_are(spark, establishments):
    rows = scan_delimited(spark, establishments)
    assert rows.count() == 3
    assert rows_of(rows.select("CO_CNES")) == [("0012",), ("0015",), ("0016",)]
    assert rows.groupBy("CO_UF").count().count() == 3


def test_rejects_are_set_aside(spark, establishments):
    good, rejected = scan_delimited_with_rejects(spark, establishments)
    assert rows_of(good.select("CO_CNES")) == [("0012",), ("0015",), ("0016",)]
    assert good.count() == 3 and rejected.count() == 2
    assert rows_of(rejected) == [("estab.csv", "0013;short"), ("estab.csv", "0014;a;b;long")]


def test_byte_order_mark(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes("﻿cod_municipio;nome\n12345;Água\n".encode())
    rows = scan_delimited(spark, str(path), encoding="UTF-8")
    assert rows.columns == ["cod_municipio", "nome"] and rows_of(rows) == [("12345", "Água")]


def test_union_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ano,municipio,valor\n2020,X,1\n2021,Y,2\n")
    (tmp_path / "b.csv").write_text("valor,ano,extra\nabc,2022,q\n")
    (tmp_path / "c.csv").write_text("ano,municipio,valor\n2023,Z,3\n")
    (tmp_path / "empty.csv").write_text("")
    rows = scan_csv_union_by_header(spark, str(tmp_path))
    assert dict(rows.dtypes) == {"ano": "int", "municipio": "string", "valor": "string", "extra": "string"}
    got = rows_of(rows.select("ano", "municipio", "valor", "extra"))
    assert got == [(2020, "X", "1", None), (2021, "Y", "2", None), (2022, None, "abc", "q"), (2023, "Z", "3", None)]


def test_union_by_header_without_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a\n")
    with pytest.raises(ValueError):
        scan_csv_union_by_header(spark, str(tmp_path))


def test_csv_sink(spark, tmp_path):
    rows = spark.createDataFrame([('say "hi", all', 1), ("línea", None)], "t string, n int")
    first = write_csv(rows.limit(0), str(tmp_path / "out"))
    second = write_csv(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(second)
    assert first != second and spark.read.option("header", True).csv(first).count() == 0
    assert set(rows_of(back)) == {('say "hi", all', "1"), ("línea", None)}


# ---- yearly JSON -------------------------------------------------------------


def answers(folder, stem, by_year):
    for year, elements in by_year.items():
        (folder / f"{stem}_{year}.json").write_text(json.dumps(elements, ensure_ascii=False), encoding="utf-8")


def test_population(spark, tmp_path):
    header = {"D1C": "Município (Código)", "D1N": "Município", "V": "Valor", "X": "?"}
    answers(
        tmp_path,
        "populacao",
        {2020: [header, {"D1C": "1", "D1N": "A", "V": "10", "X": "z"}, {"D1C": "2", "V": "..."}], 2021: [header]},
    )
    rows = scan_population(spark, str(tmp_path / "populacao_*.json"))
    assert rows.columns == ["COD_MUNICIPIO", "NOME_MUNICIPIO", "ANO", "POPULACAO_ESTIMADA"]
    assert rows_of(rows) == [("1", "A", 2020, "10"), ("2", None, 2020, "...")]


def test_columns_follow_each_files_labels(spark, tmp_path):
    answers(
        tmp_path,
        "pib",
        {
            2019: [{"a": "Município", "b": "Valor [R$]"}, {"a": "X", "b": "1"}],
            2020: [{"b": "Município", "c": "Valor (R$)", "d": "Notas"}, {"b": "Y", "c": "2", "d": "n"}, {"b": "Z"}],
            2021: [{"a": "Valor R$", "b": "valor (r$)"}, {"a": "first", "b": "last"}],
        },
    )
    rows = scan_header_first_json(spark, str(tmp_path))
    assert rows.columns == ["MUNICIPIO", "NOTAS", "VALOR_R", "ANO"]
    assert rows_of(rows) == sorted(
        [("X", None, "1", 2019), ("Y", "n", "2", 2020), ("Z", None, None, 2020), (None, None, "last", 2021)], key=repr
    )


# ---- dBASE -------------------------------------------------------------------

FIELDS = [("NOME", "C", 12), ("VA\x00L", "N", 8), ("DIA", "D", 8), ("OK", "L", 1), ("F1", "F", 6)]
RECORDS = [
    ["São Paulo", "   12.50", "20240131", "T", "1.5"],
    ["  ", '"7', "00000000", "Y", ""],
    ["deleted", "1", "20240101", "F", "2"],
    ["None", "abc", "20240230", "?", "x"],
    ["x", "", "", "n", "-.5"],
]


@pytest.fixture
def dbf_folder(tmp_path):
    (tmp_path / "PASP2401.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS, deleted={2}))
    other = [("DIA", "D", 8), ("EXTRA", "C", 3)]
    (tmp_path / "PARJ2401.DBF").write_bytes(dbf_bytes(other, [["20240301", "e1"], ["20240302", "e2"]]))
    (tmp_path / "PAMG2401.dbf").write_bytes(dbf_bytes(FIELDS, []))
    (tmp_path / "PABA2401.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS)[:-40])
    (tmp_path / "PARS2401.dbf").write_bytes(b"not a table")
    (tmp_path / "PASC2401.dbf").write_bytes(dbf_bytes([("Z", "Q", 3)], [["a"]]))
    return str(tmp_path)


@pytest.mark.parametrize("range_records", [1, 2, 1000])
def test_dbf(spark, dbf_folder, range_records):
    files = scan_file_inventory(spark, dbf_folder, glob="*.[dD][bB][fF]")
    scan = scan_dbf(files, range_records=range_records, batch_records=1)
    rows = scan.rows.select("NOME", "VA", "DIA", "OK", "F1", "EXTRA", LINEAGE)
    assert rows_of(rows) == sorted(
        [
            ("São Paulo", "12.50", "2024-01-31", "True", "1.5", None, "PASP2401.dbf"),
            (None, "7", None, "True", None, None, "PASP2401.dbf"),
            (None, "abc", None, None, "x", None, "PASP2401.dbf"),
            ("x", None, None, "False", "-.5", None, "PASP2401.dbf"),
            (None, None, "2024-03-01", None, None, "e1", "PARJ2401.DBF"),
            (None, None, "2024-03-02", None, None, "e2", "PARJ2401.DBF"),
            (None, None, None, None, None, None, "PASC2401.dbf"),
        ],
        key=repr,
    )
    assert {r["name"] for r in scan.accepted.collect()} == {"PASP2401.dbf", "PARJ2401.DBF", "PAMG2401.dbf", "PASC2401.dbf"}
    rejected = {r["name"]: r["error"] for r in scan.rejected.collect()}
    assert set(rejected) == {"PABA2401.dbf", "PARS2401.dbf"}
    assert "last record" in rejected["PABA2401.dbf"]
    # A type that is not known stays as it is written.
    assert rows_of(scan.rows.where("Z is not null").select("Z", LINEAGE)) == [("a", "PASC2401.dbf")]


def test_dbf_columns_and_mixed_types(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("K", "C", 4), ("D", "D", 8)], [["a", "20200101"]]))
    (tmp_path / "b.dbf").write_bytes(dbf_bytes([("K", "N", 4), ("D", "C", 8)], [["12", "20200102"]]))
    files = scan_file_inventory(spark, str(tmp_path), glob="*.dbf")
    scan = scan_dbf(files)
    # A name whose type differs between files stays as written.
    assert rows_of(scan.rows.select("K", "D")) == [("12", "20200102"), ("a", "20200101")]
    assert scan_dbf(files, columns=["K"]).rows.columns == ["K", LINEAGE]


def test_dbf_names_in_other_letters(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("UF", "C", 2), ("V", "N", 2)], [["SP", "1"]]))
    (tmp_path / "b.dbf").write_bytes(dbf_bytes([("v", "N", 2), ("uf", "C", 2)], [["2", "RJ"]]))
    scan = scan_dbf(scan_file_inventory(spark, str(tmp_path), glob="*.dbf"))
    assert rows_of(scan.rows.select("UF", "V")) == [("RJ", "2"), ("SP", "1")]


def test_dbf_ranges_are_dealt_by_bytes_in_the_order_of_months(spark, tmp_path, monkeypatch):
    from lakeward.sources import dbf

    monkeypatch.setattr(dbf, "TASK_BYTES", 4000)
    monkeypatch.setattr(dbf, "RANGE_COST", 100)
    for month in range(1, 7):
        rows = [[str(i), "x" * 90] for i in range(60 if month == 3 else 6)]
        (tmp_path / f"PASP240{month}.dbf").write_bytes(dbf_bytes([("N", "N", 4), ("T", "C", 90)], rows))
    files = scan_file_inventory(spark, str(tmp_path), glob="*.dbf").withColumn("m", F.substring("name", 5, 4))
    scan = scan_dbf(files, carry=("m",), order_by="m", range_records=10)
    got = scan.rows.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("m"), F.max("m"), F.count("*")).orderBy("p").collect()
    assert sum(r[3] for r in got) == 90 and max(r[3] for r in got) <= 60
    assert all(a[2] <= b[1] for a, b in zip(got, got[1:])) and len(got) >= 2


def test_dbf_without_readable_files(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(b"x")
    scan = scan_dbf(scan_file_inventory(spark, str(tmp_path), glob="*.dbf"))
    assert scan.rows.count() == 0 and scan.accepted.count() == 0 and scan.rejected.count() == 1


# ---- text, Parquet, listings -------------------------------------------------


def test_raw_text(spark, tmp_path):
    (tmp_path / "PNS.txt").write_text("01é  x \n02ab y  \n", encoding="utf-8")
    lines = scan_raw_text(spark, str(tmp_path / "PNS.txt"))
    assert rows_of(scan_raw_text(spark, publish_text(lines, str(tmp_path / "out")))) == [("01é  x ",), ("02ab y  ",)]
    cut = apply_layout(lines, [("UF", 1, 2), ("V", 3, 2)])
    assert rows_of(cut) == [("01", "é "), ("02", "ab")]


def test_drifting_parts(spark, tmp_path):
    spark.createDataFrame([("1", "a")], "x string, y string").write.parquet(str(tmp_path / "p/1"))
    spark.createDataFrame([("b", "2")], "z string, x string").write.parquet(str(tmp_path / "p/2"))
    rows = scan_parquet_union_by_name(spark, [str(tmp_path / "p/1"), str(tmp_path / "p/2")])
    assert rows_of(rows.select("x", "y", "z")) == [("1", "a", None), ("2", None, "b")]


def test_month_range_opens_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(f"2007{m:02d}", "o") for m in range(1, 13)], "competencia string, a string")
    new = spark.createDataFrame([(f"2008{m:02d}", "n") for m in range(1, 13)], "competencia string, b string")
    write_months(old, path)
    write_months(new, path)
    rows = scan_month_range(spark, path, start="200711", end="200802")
    assert dict(rows.dtypes) == {"a": "string", "b": "string", "competencia": "string"}
    assert rows.count() == 4 and len(rows.inputFiles()) == 4
    assert scan_month_range(spark, path, year="2008").columns == ["b", "competencia"]
    with pytest.raises(ValueError):
        scan_month_range(spark, path, year="1990")


def test_row_counts_read_no_column(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.range(5).coalesce(1).write.parquet(root + "/a")
    spark.createDataFrame([], "q string").write.parquet(root + "/b")
    counts = scan_row_counts(spark, root)
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    files = scan_file_inventory(spark, root, glob="*.parquet").join(counts, "path", "left")
    assert sorted(r["rows"] or 0 for r in files.collect()) == [0, 5]
    odd = str(tmp_path / "pasta ção 100%+x")
    spark.range(3).coalesce(1).write.parquet(odd)
    files = scan_file_inventory(spark, odd, glob="*.parquet").join(scan_row_counts(spark, odd), "path", "left")
    assert [r["rows"] for r in files.collect()] == [3]


def test_rows_of_a_table_in_several_files(spark, tmp_path):
    root = str(tmp_path / "pasta.parquet ção 100%+x")
    spark.range(7).repartition(3).write.parquet(f"{root}/many.parquet")
    spark.range(6).selectExpr("id", "id % 2 as part").write.partitionBy("part").parquet(f"{root}/parts.parquet")
    spark.createDataFrame([], "q string").write.parquet(f"{root}/none.parquet")
    one = next(iter((tmp_path / "pasta.parquet ção 100%+x" / "none.parquet").glob("*.parquet")))
    (tmp_path / "pasta.parquet ção 100%+x" / "file.parquet").write_bytes(one.read_bytes())
    want = [("file.parquet", 0), ("many.parquet", 7), ("none.parquet", 0), ("parts.parquet", 6)]
    for path in (root, root + "/", "file://" + root):
        assert rows_of(table_row_counts(spark, path)) == want


def test_inventory_does_not_read_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"123")
    files = scan_file_inventory(spark, str(tmp_path))
    assert "content" not in plan_of(files.select("name", "bytes")).split("Physical Plan")[1]
    assert rows_of(files.select("name", "bytes")) == [("a.bin", 3)]
    assert content_hashes(spark, str(tmp_path)).first()["md5"] == "202cb962ac59075b964b07152d234b70"


# ---- conforming --------------------------------------------------------------


def test_union_widens_only_clashing_types(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    right = spark.createDataFrame([("x", 3)], "A string, c int")
    assert rows_of(union_by_name(left, right, as_text=False)) == [("1", 2, None), ("x", None, 3)]
    assert union_by_name(left, right).dtypes == [("a", "string"), ("b", "string"), ("c", "string")]


def test_align_keeps_further_columns(spark):
    reference = spark.createDataFrame([], "a string, b int")
    rows = align_to(spark.createDataFrame([(1, "z", 5)], "new int, A string, b int"), reference)
    assert rows.columns == ["a", "b", "new"] and rows_of(rows) == [("z", 5, 1)]


def test_clean_names_collide(spark):
    with pytest.raises(ValueError):
        clean_column_names(spark.createDataFrame([(1, 2)], ["a\x00", " A"]))
    with pytest.raises(ValueError):
        exclude_columns(spark.range(1), "nope")


def test_conform(spark):
    raw = spark.createDataFrame([(1, " NaT ", 2.5), (2, " keep ", None)], "k int, t string, d double")
    got = conform(raw, lineage=F.lit("f.dbc"))
    assert rows_of(got) == [("1", None, "2.5", "f.dbc"), ("2", " keep ", None, "f.dbc")]
