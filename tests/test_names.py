from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeward.operators.names import classify_names, matches_name, rule_table, unclassified
from lakeward.operators.periods import check_window, period_window
from lakeward.plans import registry
from tests.conftest import rows_of

CASES = {
    "ABSP0901.dbc": ("sia_ab", "SP", 2009, "200901"),
    "ABOSP1304.DBC": ("sia_abo", "SP", 2013, "201304"),
    "pasp2401a.dbc": ("sia_pa", "SP", 2024, "202401"),
    "PARJ9407.dbc": ("sia_pa", "RJ", 1994, "199407"),
    "CIHAMG1112.dbc": ("ciha", "MG", 2011, "201112"),
    "DENGBR07.dbc": ("dengue", "BR", 2007, None),
    "LERBR10.dbc": ("ler_dort", "BR", 2010, None),
    "LERDBR10.dbc": ("ler_dort_detalhado", "BR", 2010, None),
    "DOEXT95.DBC": ("sim_causas_externas_cid9", "", 1995, None),
    "DOEXT96.DBC": ("sim_causas_externas_cid10", "", 1996, None),
    "DOEXT2019.DBC": ("sim_causas_externas_cid10", "", 2019, None),
    "DORBR79.dbc": ("sim_do_cid9", "", 1979, None),
    "DOBR2020.dbc": ("sim_do_cid10", "", 2020, None),
    "DNSP1999.dbc": ("sinasc", "SP", 1999, None),
    "DNSP94.dbc": ("sinasc", "SP", 1994, None),
    "DNEX2015.dbc": ("sinasc_dnex", "", 2015, None),
    "SPSP0801.dbc": ("sih_sp", "SP", 2008, "200801"),
    "PFAC2605.dbc": ("cnes_profissionais", "AC", 2026, "202605"),
}
REFUSED = ["DNBR1999.dbc", "PASP2413.dbc", "PASP240.dbc", "PASP2401ab.dbc", "ABSP0901.csv", "readme.txt",
           "DOBR1995.dbc", "PA2401.dbc", "DENGSP07.dbc", "PASP2401_1.dbc", ""]


def test_classification(spark):
    names = spark.createDataFrame([(n,) for n in [*CASES, *REFUSED]], "name string")
    found = classify_names(names, rule_table(spark, registry.name_rules()))
    got = {r["name"]: (r["source"], r["place"], r["year"], r["period"]) for r in found.collect()}
    assert got == CASES
    assert {r["name"] for r in unclassified(names, found).collect()} == set(REFUSED)


def test_prefix_guard(spark):
    names = spark.createDataFrame([(n,) for n in ("ABSP0901.dbc", "ABOSP0901.dbc", "absp0901A.dbc")], "name string")
    got = names.select(matches_name("name", "AB", "uf", "month")).collect()
    assert [r[0] for r in got] == [True, False, True]


def test_registry_is_whole():
    assert len(registry.SOURCES) == 39 and len({s.id for s in registry.SOURCES}) == 39
    assert len(registry.DISEASES) == 58 and len(dict(registry.DISEASES)) == 58
    assert sum(s.tipo == "pipeline_manual" for s in registry.SOURCES) == 2
    assert {target for _, target in registry.FILE_FRAGMENTS} == {s.id for s in registry.SOURCES} - {"sinan"}
    assert registry.get_source("ciha").table == "comunicacao_internacao_hospitalar_ambulatorial"
    with pytest.raises(KeyError):
        registry.get_source("nope")


def test_windows(spark):
    frame = spark.createDataFrame([(f"{y}{m:02d}",) for y in (2019, 2020) for m in range(1, 13)], "competencia string")
    assert period_window(frame, year="2020").count() == 12
    assert rows_of(period_window(frame, month="202003")) == [("202003",)]
    assert period_window(frame, start="201911", end="202002").count() == 4
    assert period_window(frame).count() == 24


@pytest.mark.parametrize(
    "bad",
    [
        {"year": "20"}, {"month": "202013"}, {"month": "202000"}, {"start": "202001"}, {"end": "202001"},
        {"start": "202005", "end": "202001"}, {"year": "2020", "month": "202001"}, {"start": "2020", "end": "2021"},
    ],
)
def test_bad_windows(bad):
    with pytest.raises(ValueError):
        check_window(**bad)


def test_each_death_file_belongs_to_one_source(spark):
    names = [f"{kind}{year % 100:02d}.DBC" for kind in ("DOEXT", "DOFET", "DOINF", "DOMAT", "DOREXT", "DORBR") for year in range(1979, 2079)]
    found = classify_names(spark.createDataFrame([(n,) for n in names], "name string"), rule_table(spark, registry.name_rules()))
    counts = {r["name"]: (r["n"], r["first"]) for r in found.groupBy("name").agg(F.count("*").alias("n"), F.min("year").alias("first")).collect()}
    assert {n for n, _ in counts.values()} == {1}
    assert counts["DOEXT85.DBC"] == (1, 1985) and counts["DOEXT05.DBC"] == (1, 2005) and "DOMAT85.DBC" not in counts
