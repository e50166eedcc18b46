"""Column functions against plain Python."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import functions as F

from lakeward.functions import fields, periods, report, text


def column(spark, values, expression, name="v"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_blank_markers(spark):
    values = ["", "  ", "\t", " ", "None", " nan ", "NaT\n", "none", "NAN", " a b ", "0", None, " "]
    want = [None if v is None or v.strip() in ("", "None", "nan", "NaT") else v for v in values]
    assert column(spark, values, text.blank_to_null("v")) == want


def test_labels_as_in_python(spark):
    values = [
        "Município (Código)", "Valor adicionado bruto a preços correntes da Indústria", "__a--b__", "Àü Ñ x",
        "Produto Interno Bruto [Mil R$]", "", "éÉ", "straße",
    ]

    def python(label):
        table = str.maketrans("ÁÃÂÉÊÍÓÕÔÚÇ", "AAAEEIOOOUC")
        return re.sub("[^A-Z0-9]+", "_", label.upper().translate(table)).strip("_")

    assert column(spark, values, text.normalize_label("v")) == [python(v) for v in values]


def test_zero_fill_never_cuts(spark):
    values = ["1", "35001", "350010", "3500105", "", None]
    assert column(spark, values, text.zero_fill("v")) == ["000001", "035001", "350010", "3500105", "000000", None]


def test_paths_and_digits(spark):
    values = ["sim/a/b.parquet", "root.csv", "PASP2401.dbc", "PASP2401a.dbc"]
    assert column(spark, values, text.file_name("v")) == ["b.parquet", "root.csv", "PASP2401.dbc", "PASP2401a.dbc"]
    assert column(spark, values, text.top_folder("v")) == ["sim", "", "", ""]
    assert column(spark, values, text.period_digits("v"))[2:] == ["2401", "PASP2401a.dbc"]
    assert column(spark, values, text.regex_group("v", "^PA(..)")) == [None, None, "SP", "SP"]


def test_tolerant_numbers(spark):
    values = ['"12', "'7'", "  3.5 ", "abc", "  ", "1.50", "1,5", "****", "-4", "1d", "NaN", "1e3", '"', None]
    want = ["12", "7", "3.5", "abc", None, "1.50", "1.5", None, "-4", "1d", "NaN", "1e3", '"', None]
    assert column(spark, values, fields.tolerant_number("v")) == want
    doubles = [12.0, 7.0, 3.5, None, None, 1.5, 1.5, None, -4.0, None, None, 1000.0, None, None]
    assert column(spark, values, fields.to_double("v")) == doubles
    assert column(spark, ["12", "12.0", "x", "99999999999999999999"], fields.to_long("v")) == [12, None, None, None]


def test_dates_and_logicals(spark):
    days = ["20240131", "00000000", "20240230", " 19991231 ", "2024013", "", None, "2024-1-1"]
    want = [datetime.date(2024, 1, 31), None, None, datetime.date(1999, 12, 31), None, None, None, None]
    assert column(spark, days, fields.to_date("v")) == want
    letters = ["T", "t", "Y", "y", "N", "n", "F", "f", "?", "", None]
    assert column(spark, letters, fields.to_logical("v")) == [True] * 4 + [False] * 4 + [None] * 3


def test_years(spark):
    digits = ["79", "78", "94", "00", "26", "xx", "1987"]
    assert column(spark, digits, periods.full_year("v", 79)) == [1979, 2078, 1994, 2000, 2026, None, 1987]
    assert column(spark, digits[:5], periods.pivot_year("v", 94)) == [2079, 2078, 1994, 2000, 2026]
    assert column(spark, digits[:5], periods.pivot_year("v", None)) == [1979, 1978, 1994, 1900, 1926]


def test_month_texts(spark):
    assert column(spark, ["199407"], periods.month_label("v")) == ["07/1994"]
    assert column(spark, ["199407"], periods.year_span("v", F.lit("202605"))) == ["1994-2026"]
    assert column(spark, ["199407"], periods.month_key(F.lit(99), F.lit(7))) == ["009907"]


def test_sizes_as_in_python(spark):
    def python(n):
        size = float(n)
        for unit in ("B", "KiB", "MiB", "GiB", "TiB"):
            if size < 1024 or unit == "TiB":
                return f"{size:,.1f} {unit}"
            size /= 1024

    values = [0, 1, 1023, 1024, 1536, 1048575, 1048576, 73746999712, 2**40, 5 * 2**52, 999 * 2**20 + 7]
    assert column(spark, [str(v) for v in values], report.byte_size(F.col("v").cast("bigint"))) == [python(v) for v in values]
    assert column(spark, ["73746999712"], report.gibibytes("v")) == [f"{73746999712 / 1024**3:.2f} GiB"]


def test_local_time_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            instant = spark.sql("select timestamp '2024-03-10 07:30:00Z' as t, timestamp_ntz '2024-03-10 07:30:00' as n")
            got = instant.select(report.local_time("t"), report.local_time("n", "UTC")).first()
            assert tuple(got) == ("2024-03-10 04:30:00",) * 2, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_fingerprint_ignores_order_but_not_copies(spark):
    rows = [("a", 1), ("b", None), ("a", 1)]
    one = report.fingerprint(spark.createDataFrame(rows, "k string, v int")).first()
    two = report.fingerprint(spark.createDataFrame(rows[::-1], "k string, v int").repartition(3)).first()
    fewer = report.fingerprint(spark.createDataFrame(rows[:2], "k string, v int")).first()
    text_null = report.fingerprint(spark.createDataFrame([("a", "1"), ("b", "n"), ("a", "1")], "k string, v string")).first()
    assert one == two and one["digest"] != fewer["digest"] and one["digest"] != text_null["digest"]
