"""Lines and headers that do not fit are set aside, and nothing else is."""

from __future__ import annotations

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeward.plans.ingest import ingest_budget, ingest_delimited
from lakeward.sinks.tables import read_published
from lakeward.sources.delimited import scan_csv_union_by_header, scan_csv_union_with_rejects, scan_delimited_files
from lakeward.sources.files import scan_file_inventory
from lakeward.sources.headed import scan_headed, split_fields, unquoted
from tests.conftest import plan_of, rows_of


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def aside(found):
    return sorted((r["name"], r["error"]) for r in found.collect())


def test_lines_that_are_too_long_or_too_short(spark, tmp_path):
    path = write(tmp_path, x="a,b\n1,2\n3,4,5\n6\n", y="a,b,c\n7,8,9\n1,2,3,4\n", z="c,a\n,8\n")
    rows, bad = scan_csv_union_with_rejects(spark, path, infer=False)
    assert rows.columns == ["a", "b", "c"]
    assert rows_of(rows) == sorted([("1", "2", None), ("7", "8", "9"), ("8", None, None)], key=repr)
    assert aside(bad) == [("x.csv", "malformed line: 3,4,5"), ("x.csv", "malformed line: 6"), ("y.csv", "malformed line: 1,2,3,4")]
    assert {r["path"].rsplit("/", 1)[-1] for r in bad.collect()} == {"x.csv", "y.csv"}
    assert [r["a"] for r in scan_csv_union_by_header(spark, path).orderBy("a").collect()] == [1, 7, 8]


def test_headers_that_repeat_a_name(spark, tmp_path):
    path = write(tmp_path, x="a,A\n1,2\n", y="a,b\n3,4\n")
    rows, bad = scan_csv_union_with_rejects(spark, path, infer=False)
    assert rows_of(rows) == [("3", "4")] and aside(bad) == [("x.csv", "repeated name in header: a,A")]
    found = scan_headed(spark, scan_file_inventory(spark, str(tmp_path / "x.csv")))
    assert found.rows is None and aside(found.aside) == [("x.csv", "repeated name in header: a,A")]


def test_quotes(spark, tmp_path):
    lines = ['1,"x, y"', '2,"say ""hi"""', '3,""', "4,", '5,it"s', '6,"open', '7,"a" b', '"8","z,"",z"', "9,\x01", "a,b"]
    path = write(tmp_path, x="﻿a,b\r\n" + "\r\n".join(lines))
    rows, bad = scan_csv_union_with_rejects(spark, path, infer=False)
    assert rows_of(rows) == sorted(
        [("1", "x, y"), ("2", 'say "hi"'), ("3", None), ("4", None), ("5", 'it"s'), ("8", 'z,",z'), ("9", "\x01"), ("a", "b")], key=repr
    )
    assert aside(bad) == [("x.csv", 'malformed line: 6,"open'), ("x.csv", 'malformed line: 7,"a" b')]


def test_files_without_lines_and_in_other_encodings(spark, tmp_path):
    path = write(tmp_path, empty="", head="a;b\n", bad="\xe9;b\n1;2\n".encode("latin-1"), good="a;b\n1;é\n")
    rows, bad = scan_delimited_files(spark, scan_file_inventory(spark, path), encoding="UTF-8")
    assert rows_of(rows) == [("1", "é")]
    assert [(n, e.split(":")[0]) for n, e in aside(bad)] == [("bad.csv", "UnicodeDecodeError")]
    latin, none = scan_delimited_files(spark, scan_file_inventory(spark, f"{path}/bad.csv"))
    assert latin.columns == ["é", "b"] and rows_of(latin) == [("1", "2")] and none.collect() == []
    nothing = scan_headed(spark, scan_file_inventory(spark, f"{path}/empty.csv"))
    assert nothing.rows is None and nothing.aside.collect() == []


def test_many_headers_are_one_plan(spark, tmp_path):
    names = [f"n{i}" for i in range(30)]
    files = {f"f{i}": f"k,{name}\n{i},v{i}\n" for i, name in enumerate(names)}
    rows, _ = scan_csv_union_with_rejects(spark, write(tmp_path, **files), infer=False)
    assert rows.columns == ["k", *sorted(names, key=lambda n: f"f{n[1:]}.csv")]
    assert plan_of(rows).count("FileScan") == 1
    assert all(r[f"n{r['k']}"] == f"v{r['k']}" and sum(v is not None for v in r) == 2 for r in rows.collect())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(st.sampled_from('ab",; é'), max_size=6), min_size=1, max_size=5), min_size=1, max_size=12))
def test_fields_of_written_lines(spark, records):
    lines = []
    for record in records:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(record)
        lines.append((out.getvalue(),))
    df = spark.createDataFrame(lines, "line string")
    cut = df.select(split_fields(df.line, ",").alias("f"))
    got = [list(r["v"]) for r in cut.select(F.transform("f", lambda f: unquoted(f)).alias("v")).collect()]
    assert got == [r or [""] for r in records]


def test_budget_rejects_are_told(spark, tmp_path):
    for folder in ("csv_siops_subfuncao", "csv_siops_rreo", "csv_siops_indicador"):
        (tmp_path / folder).mkdir()
        write(tmp_path / folder, a="municipio,ano,valor\n1,2020,5\n2,2020\n", b="ano,valor,municipio\n2021,6,3\n")
    outcomes = ingest_budget(spark, str(tmp_path), str(tmp_path / "out"))
    for outcome in outcomes:
        assert aside(outcome.rejected) == [("a.csv", "malformed line: 2,2020")]
        assert spark.read.option("header", True).csv(outcome.target).count() == 2


def test_a_repeated_name_stops_a_whole_delivery(spark, tmp_path):
    (tmp_path / "in").mkdir()
    landing, lake = write(tmp_path / "in", a="CO;NO\n1;x\n"), str(tmp_path / "lake")
    first = ingest_delimited(spark, landing, lake, "cnes", "estabelecimentos")
    assert first.rows == 1
    write(tmp_path / "in", b="CO;CO\n2;y\n")
    again = ingest_delimited(spark, landing, lake, "cnes", "estabelecimentos")
    assert not again.changed and aside(again.rejected) == [("b.csv", "repeated name in header: CO;CO")]
    assert rows_of(read_published(spark, first.target)) == [("1", "x")]


@pytest.mark.parametrize("bad", [b"a,b\n\xff\xfe,1\n"])
def test_bytes_that_are_no_text_do_not_stop_the_scan(spark, tmp_path, bad):
    rows, _ = scan_csv_union_with_rejects(spark, write(tmp_path, x=bad, y="a,b\n1,2\n"), infer=False)
    assert rows.count() == 2
