"""Catalogues, coverage, rates, lookups and the stream."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from lakeward.operators import catalogue as cat
from lakeward.operators.enrich import dimension_lookup, first_substring_match, left_enrich, municipality, rate_per, rate_per_municipality
from lakeward.operators.partitions import read_months
from lakeward.plans import registry
from lakeward.streaming.arrivals import stream_append_new_files
from tests.conftest import rows_of


@pytest.fixture
def files(spark):
    at = datetime.datetime(2024, 5, 1, 2, 0, 0)
    rows = [
        ("199407", 10, 100, at), ("199408", 0, 5, at), ("199612", 7, 50, at + datetime.timedelta(days=1)),
        ("199612", 3, 25, at), (None, 1, 1, at),
    ]
    return spark.createDataFrame(rows, "period string, rows bigint, bytes bigint, mtime timestamp_ntz")


def test_yearly_profile(files):
    got = [tuple(r) for r in cat.yearly_profile(files, "period", "UTC").collect()]
    assert got == [
        (1996, 2, "12/1996", 10, 20, "2024-05-01 23:00:00"),
        (1994, 2, "08/1994", 10, 10, "2024-04-30 23:00:00"),
    ]


def test_last_running_total_is_the_sum(files):
    profile = cat.yearly_profile(files, "period", "UTC").collect()
    summary = cat.grand_summary(files, "period", "UTC").first()
    assert profile[0]["registros_acumulado"] == sum(r["num_registros"] for r in profile) == summary["total_registros"]
    assert tuple(summary) == (4, 3, 20, 180, "199407", "199612", "1994-1996", "2024-05-01 23:00:00")


def test_coverage(files):
    got = [tuple(r) for r in cat.coverage_with_total(files, "period").collect()]
    assert [g[:4] for g in got] == [(1994, 2, 2, 105), (1995, 0, 0, 0), (1996, 2, 1, 75), (None, 4, 3, 180)]
    assert got[0][4] == "meses 01,02,03,04,05,06,09,10,11,12" and got[1][4] == "" and got[3][4] == ""
    gaps = dict(tuple(r) for r in cat.coverage_gaps(files, "period").collect())
    assert set(gaps) == {1994, 1996} and gaps[1996] == "01,02,03,04,05,06,07,08,09,10,11"


def test_empty_inventory(spark, files):
    none = files.where("false")
    assert cat.yearly_profile(none, "period").count() == 0
    assert cat.coverage_gaps(none, "period").count() == 0
    assert cat.grand_summary(none, "period").first()["total_competencias"] == 0


def test_first_match_and_longest(spark):
    names = spark.createDataFrame([("servicos_profissionais.parquet",), ("leitos.parquet",), ("x",)], "n string")
    first = names.select(first_substring_match("n", registry.FILE_FRAGMENTS)).collect()
    assert [r[0] for r in first] == ["cnes_profissionais", "cnes_leitos", None]
    longest = names.select(first_substring_match("n", registry.FILE_FRAGMENTS, longest=True)).collect()
    assert [r[0] for r in longest] == ["sih_sp", "cnes_leitos", None]


def test_lookup_is_strict(spark):
    dimension = registry.source_dimension(spark).select("id", "nome")
    known = spark.createDataFrame([("ciha",)], "id string")
    assert dimension_lookup(known, dimension, "id").first()["nome"].startswith("CIHA")
    unknown = spark.createDataFrame([("nope",)], "id string")
    with pytest.raises(Exception, match="unknown id: nope"):
        dimension_lookup(unknown, dimension, "id").collect()
    assert dimension_lookup(unknown, dimension, "id", strict=False).first()["nome"] is None


def test_enrich(spark):
    left = spark.createDataFrame([("1",), ("3500105",), (None,)], "cod string")
    right = spark.createDataFrame([("00001", "a"), ("1", "b"), ("350010", "c")], "MUNCOD string, x string")
    got = left_enrich(left, right, "cod", "MUNCOD")
    assert rows_of(got) == sorted([("000001", "a"), ("000001", "b"), ("3500105", None), (None, None)], key=repr)


def test_rates(spark):
    events = spark.createDataFrame([("3500105", 2020)] * 3 + [("350020", 2020), ("350030", 2020)], "code string, ano int")
    events = events.withColumn("place", municipality("code"))
    people = spark.createDataFrame(
        [("350010", 2020, 1000), ("350020", 2020, 0), ("350010", 2021, 5)], "place string, ano int, population bigint"
    )
    assert rows_of(rate_per(events, people, "place", "ano")) == [
        ("350010", 2020, 3, 1000, 300.0), ("350020", 2020, 1, 0, None), ("350030", 2020, 1, None, None),
    ]


def test_rates_by_codes_of_six_and_seven_digits(spark):
    events = spark.createDataFrame([("3550308", 2020), ("355030", 2020), ("3500105", 2020)], "code string, ano int")
    people = spark.createDataFrame([("355030", 2020, 1000), ("3500105", 2020, 10), ("355030", 2021, 7)], "place string, ano int, population bigint")
    got = rows_of(rate_per_municipality(events, people, "code", "place", "ano"))
    assert got == [("350010", 2020, 1, 10, 10000.0), ("355030", 2020, 2, 1000, 200.0)]
    twice = people.union(spark.createDataFrame([("3550308", 2020, 5)], people.schema))
    with pytest.raises(Exception, match="several codes for municipality 355030 in 2020"):
        rate_per_municipality(events, twice, "code", "place", "ano").collect()


def test_stream_takes_files_once_and_replaces_by_source(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k int, period string"
    period = lambda df: df.withColumn("competencia", F.col("period"))

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(landing)

    def take():
        stream_append_new_files(spark, landing, spark.createDataFrame([], schema).schema, target, state, period)
        return rows_of(read_months(spark, target).select("k", "competencia"))

    arrive((1, "202001"), (2, "202002"))
    assert take() == [(1, "202001"), (2, "202002")]
    arrive((3, "202002"), (4, "202003"))
    assert take() == [(1, "202001"), (2, "202002"), (3, "202002"), (4, "202003")]
    assert take() == [(1, "202001"), (2, "202002"), (3, "202002"), (4, "202003")]
