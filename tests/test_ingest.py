"""Sources from landing folder to lake, several deliveries in a row."""

from __future__ import annotations

import json

import pytest

from lakeward import session
from lakeward.operators import catalogue as cat
from lakeward.operators.partitions import month_folders, read_months
from lakeward.plans import registry
from lakeward.plans.ingest import ingest, ingest_budget, ingest_months, ledger_path, table_path, tidy_lake
from lakeward.session import clear_scratch, settled
from lakeward.sinks.tables import latest_version, read_ledger, read_published
from lakeward.sources.dbf import LINEAGE
from tests.conftest import dbf_bytes, rows_of

FIELDS = [("ID", "C", 6), ("N", "N", 4)]


def deliver(folder, name, *ids, fields=FIELDS):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(dbf_bytes(fields, [[i, "1", *["e"] * (len(fields) - 2)] for i in ids]))


def keys(spark, lake, folder, table):
    return {r["key"] for r in read_ledger(spark, ledger_path(lake, folder, table)).collect()}


def test_merge_source(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    deliver(landing, "RDSP0801.dbf", "a", "b")
    deliver(landing, "RDRJ0801.dbf", "c")
    deliver(landing, "SPSP0801.dbf", "other source")
    (landing / "RDMG0801.dbf").write_bytes(b"broken")
    (outcome,) = ingest(spark, "sih_rd", str(landing), lake)
    assert outcome.changed and outcome.rows == 3 and [r["name"] for r in outcome.rejected.collect()] == ["RDMG0801.dbf"]
    table = table_path(lake, "sih", "aih_reduzida")
    assert rows_of(read_months(spark, table).select("ID", LINEAGE)) == [
        ("a", "RDSP0801.DBC"), ("b", "RDSP0801.DBC"), ("c", "RDRJ0801.DBC"),
    ]
    assert keys(spark, lake, "sih", "aih_reduzida") == {"RDSP0801.DBC", "RDRJ0801.DBC"}

    # The broken file is tried again; nothing else is.
    (outcome,) = ingest(spark, "sih_rd", str(landing), lake)
    assert outcome.changed and read_months(spark, table).count() == 3

    # A file is revised to fewer rows, one to none, one is new with a further column,
    # and the broken one arrives whole under another case.
    deliver(landing, "RDSP0801.dbf", "a2")
    deliver(landing, "RDRJ0801.dbf")
    deliver(landing, "RDSP0802.dbf", "d", fields=[*FIELDS, ("X", "C", 2)])
    (landing / "RDMG0801.dbf").write_bytes(dbf_bytes(FIELDS, [["m", "1"]]))
    ingest(spark, "sih_rd", str(landing), lake)
    assert rows_of(read_months(spark, table).select("ID", "X", LINEAGE)) == [
        ("a2", None, "RDSP0801.DBC"), ("d", "e", "RDSP0802.DBC"), ("m", None, "RDMG0801.DBC"),
    ]
    assert month_folders(spark, table) == ["200801", "200802"]
    (outcome,) = ingest(spark, "sih_rd", str(landing), lake)
    assert not outcome.changed

    # Another source of the same folder has a table and a ledger of its own.
    ingest(spark, "sih_sp", str(landing), lake)
    assert keys(spark, lake, "sih", "servicos_profissionais") == {"SPSP0801.DBC"}
    assert len(keys(spark, lake, "sih", "aih_reduzida")) == 4


def test_snapshot_source(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    deliver(landing, "LTSP9912.dbf", "nineties")
    deliver(landing, "LTSP2601.dbf", "old")
    deliver(landing, "LTRJ2601.dbf", "old")
    ingest(spark, "cnes_leitos", str(landing), lake)
    table = table_path(lake, "cnes", "leitos")
    assert rows_of(read_published(spark, table).select("ID")) == [("old",), ("old",)]
    deliver(landing, "LTSP2602.dbf", "s")
    deliver(landing, "LTRJ2602.dbf", "r")
    ingest(spark, "cnes_leitos", str(landing), lake)
    assert keys(spark, lake, "cnes", "leitos") == {"LTSP2602.DBC", "LTRJ2602.DBC"}
    # One state alone is revised: the snapshot still holds every state.
    deliver(landing, "LTSP2602.dbf", "s1", "s2")
    ingest(spark, "cnes_leitos", str(landing), lake)
    assert rows_of(read_published(spark, table).select("ID")) == [("r",), ("s1",), ("s2",)]

    # A broken revision keeps the state's rows and is tried again; without any file that can be read nothing changes.
    deliver(landing, "LTRJ2602.dbf", "r1")
    (landing / "LTSP2602.dbf").write_bytes(dbf_bytes(FIELDS, [["s3", "1"]])[:-8])
    (outcome,) = ingest(spark, "cnes_leitos", str(landing), lake)
    assert [r["name"] for r in outcome.rejected.collect()] == ["LTSP2602.dbf"]
    assert rows_of(read_published(spark, table).select("ID")) == [("r1",), ("s1",), ("s2",)]
    assert keys(spark, lake, "cnes", "leitos") == {"LTRJ2602.DBC"}
    (landing / "LTRJ2602.dbf").write_bytes(b"broken too")
    (outcome,) = ingest(spark, "cnes_leitos", str(landing), lake)
    assert not outcome.changed and outcome.rejected.count() == 2
    assert rows_of(read_published(spark, table).select("ID")) == [("r1",), ("s1",), ("s2",)]
    deliver(landing, "LTSP2602.dbf", "s4")
    deliver(landing, "LTRJ2602.dbf", "r2")
    ingest(spark, "cnes_leitos", str(landing), lake)
    assert rows_of(read_published(spark, table).select("ID")) == [("r2",), ("s4",)]


def test_a_broken_file_keeps_its_rows_in_a_rebuilt_month(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    for name in ("PASP2401", "PASP2401a", "PARJ2401", "PASP2402"):
        deliver(landing, f"{name}.dbf", f"{name[2:4]}1")
    ingest(spark, "sia_pa", str(landing), lake)
    table = table_path(lake, "producao_ambulatorial", "producao_ambulatorial")
    for name in ("PASP2401", "PASP2402"):
        (landing / f"{name}.dbf").write_bytes(dbf_bytes(FIELDS, [["x", "1"]] * 2)[:-5])
    deliver(landing, "PARJ2401.dbf", "RJ2", "RJ2")
    (outcome,) = ingest(spark, "sia_pa", str(landing), lake)
    assert outcome.rejected.count() == 2
    got = rows_of(read_months(spark, table).select("ID", "competencia"))
    assert got == [("RJ2", "202401"), ("RJ2", "202401"), ("SP1", "202401"), ("SP1", "202401"), ("SP1", "202402")]
    (outcome,) = ingest(spark, "sia_pa", str(landing), lake)
    assert outcome.changed  # the broken files are tried again
    deliver(landing, "PASP2402.dbf", "SP3")
    ingest(spark, "sia_pa", str(landing), lake)
    assert rows_of(read_months(spark, table).where("competencia = '202402'").select("ID")) == [("SP3",)]


def test_a_revision_of_equal_size(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    deliver(landing, "RDSP0801.dbf", "one")
    ingest(spark, "sih_rd", str(landing), lake, by_content=True)
    deliver(landing, "RDSP0801.dbf", "two")
    (outcome,) = ingest(spark, "sih_rd", str(landing), lake, by_content=True)
    assert outcome.changed
    assert rows_of(read_months(spark, table_path(lake, "sih", "aih_reduzida")).select("ID")) == [("two",)]
    assert not ingest(spark, "sih_rd", str(landing), lake, by_content=True)[0].changed


def test_month_source(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    for month in ("9407", "0701", "2401", "2402"):
        deliver(landing, f"PASP{month}.dbf", f"s{month}")
    deliver(landing, "PASP2401a.dbf", "part a")
    ingest(spark, "sia_pa", str(landing), lake, batch_bytes=200)
    table = table_path(lake, "producao_ambulatorial", "producao_ambulatorial")
    assert month_folders(spark, table) == ["199407", "200701", "202401", "202402"]
    assert read_months(spark, table).where("competencia = '202401'").count() == 2
    before = {f: f for f in read_months(spark, table).inputFiles()}

    deliver(landing, "PARJ2402.dbf", "rj")
    (outcome,) = ingest(spark, "sia_pa", str(landing), lake)
    assert outcome.changed and read_months(spark, table).where("competencia = '202402'").count() == 2
    kept = {f for f in read_months(spark, table).inputFiles() if f in before}
    assert len(kept) >= 3 and not any("202402" in f for f in kept)
    (outcome,) = ingest(spark, "sia_pa", str(landing), lake)
    assert not outcome.changed

    rule = registry.get_source("sia_pa").rule
    again = ingest_months(spark, str(landing), lake, "producao_ambulatorial", rule, year="2007")
    assert again.changed
    none = ingest_months(spark, str(landing), lake, "producao_ambulatorial", rule, month="199001")
    assert not none.changed
    with pytest.raises(ValueError):
        ingest_months(spark, str(landing), lake, "producao_ambulatorial", rule, year="07")


def test_diseases(spark, tmp_path, monkeypatch):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    monkeypatch.setattr(registry, "DISEASES", [("LER", "ler_dort"), ("LERD", "ler_dort_detalhado")])
    deliver(landing, "LERBR10.dbf", "x")
    deliver(landing / "FINAIS", "LERDBR10.dbf", "y")
    deliver(landing / "PRELIM", "lerdbr10.dbf", "preliminary")
    deliver(landing / "A" / "PRELIM", "LERDBR11.dbf", "later")
    outcomes = ingest(spark, "sinan", str(landing), lake)
    assert [o.changed for o in outcomes] == [True, True]
    assert rows_of(read_months(spark, table_path(lake, "sinan", "ler_dort")).select("ID", "competencia")) == [("x", "2010")]
    assert rows_of(read_months(spark, table_path(lake, "sinan", "ler_dort_detalhado")).select("ID")) == [("later",), ("y",)]


def test_yearly_sources(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    landing.mkdir()
    header = {"D1C": "Município (Código)", "D1N": "Município", "V": "Valor"}

    def year(stem, y, *rows):
        (landing / f"{stem}_{y}.json").write_text(json.dumps([header, *rows], ensure_ascii=False), encoding="utf-8")

    year("populacao", 2020, {"D1C": "1", "D1N": "A", "V": "10"})
    year("populacao", 2021, {"D1C": "1", "D1N": "A", "V": "11"})
    year("pib", 2020, {"D1C": "1", "D1N": "A", "V": "99"})
    ingest(spark, "ibge_populacao", str(landing), lake)
    ingest(spark, "ibge_pib_municipal", str(landing), lake)
    people = table_path(lake, "ibge", "populacao_estimada")
    year("populacao", 2021, {"D1C": "1", "D1N": "A", "V": "12"}, {"D1C": "2", "D1N": "B", "V": "..."})
    year("populacao", 2020)
    ingest(spark, "ibge_populacao", str(landing), lake)
    assert rows_of(read_published(spark, people)) == [("1", "A", 2021, "12"), ("2", "B", 2021, "...")]
    assert not ingest(spark, "ibge_populacao", str(landing), lake)[0].changed
    product = read_published(spark, table_path(lake, "ibge", "pib_municipal"))
    assert product.columns == ["MUNICIPIO", "MUNICIPIO_CODIGO", "VALOR", "ANO"] and product.count() == 1
    assert keys(spark, lake, "ibge", "populacao_estimada") == {"POPULACAO_2020.JSON", "POPULACAO_2021.JSON"}
    assert keys(spark, lake, "ibge", "pib_municipal") == {"PIB_2020.JSON"}

    # Error pages, empty answers and files without a year tell nothing about theirs.
    (landing / "populacao_2021.json").write_text("<html>error</html>")
    (landing / "populacao_2022.json").write_text("[]")
    (landing / "populacao_x.json").write_text("[{}]")
    (outcome,) = ingest(spark, "ibge_populacao", str(landing), lake)
    assert not outcome.changed and outcome.rejected.count() == 3
    year("populacao", 2020, {"D1C": "3", "D1N": "C", "V": "1"})
    (outcome,) = ingest(spark, "ibge_populacao", str(landing), lake)
    assert {r["name"] for r in outcome.rejected.collect()} == {"populacao_2021.json", "populacao_2022.json", "populacao_x.json"}
    assert rows_of(read_published(spark, people)) == [("1", "A", 2021, "12"), ("2", "B", 2021, "..."), ("3", "C", 2020, "1")]
    assert keys(spark, lake, "ibge", "populacao_estimada") == {"POPULACAO_2020.JSON"}
    assert ingest(spark, "ibge_populacao", str(landing), lake)[0].rejected.count() == 3


def test_files_published_whole(spark, tmp_path):
    lake = str(tmp_path / "lake")
    estab = tmp_path / "estab"
    estab.mkdir()
    (estab / "cnes.csv").write_bytes("CO;NO\n01;ação\nbad\n".encode("latin-1"))
    (outcome,) = ingest(spark, "cnes_estabelecimentos", str(estab), lake)
    assert [r["error"] for r in outcome.rejected.collect()] == ["malformed line: bad"]
    (estab / "more.csv").write_bytes(b"NO;CO\nx;02\n")
    ingest(spark, "cnes_estabelecimentos", str(estab), lake)
    both = read_published(spark, table_path(lake, "cnes", "estabelecimentos_de_saude"))
    assert rows_of(both.select("CO", "NO")) == [("01", "ação"), ("02", "x")]
    (estab / "more.csv").unlink()
    (estab / "cnes.csv").write_bytes("CO;NO\n01;ação;\n01;a\n".encode("latin-1"))
    ingest(spark, "cnes_estabelecimentos", str(estab), lake)
    assert rows_of(read_published(spark, table_path(lake, "cnes", "estabelecimentos_de_saude"))) == [("01", "a")]

    macro = tmp_path / "macro"
    macro.mkdir()
    (macro / "m.csv").write_bytes("﻿cod_municipio;macro\n12345;A\n3500105;B\n".encode())
    places = spark.createDataFrame([("012345", "-23.5")], "MUNCOD string, lat string")
    ingest(spark, "macroregiao", str(macro), lake, places=places)
    got = rows_of(read_published(spark, table_path(lake, "geo", "macroregiao_de_saude")))
    assert got == [("012345", "A", "-23.5"), ("3500105", "B", None)]

    raw = tmp_path / "PNS_2013.txt"
    raw.write_text("0001\n")
    assert ingest(spark, "pns_2013", str(raw), lake)[0].changed
    assert not ingest(spark, "pns_2013", str(raw), lake)[0].changed
    raw.write_text("0001\n0002\n")
    assert ingest(spark, "pns_2013", str(raw), lake)[0].changed
    assert spark.read.text(latest_version(spark, table_path(lake, "ibge", "microdados_pns_2013.txt"))).count() == 2

    # The catalogue of all this.
    reports = cat.lake_reports(spark, lake, "sia/x", registry.FILE_FRAGMENTS, registry.source_dimension(spark), registry.FOLDER_SOURCES)
    tables = {r["tabela"]: r for r in reports.tables.collect()}
    assert set(tables) == {"cnes/estabelecimentos_de_saude", "geo/macroregiao_de_saude", "ibge/microdados_pns_2013.txt"}
    assert tables["cnes/estabelecimentos_de_saude"]["nome_fonte"] == "CNES - Estabelecimentos de Saúde"
    assert tables["cnes/estabelecimentos_de_saude"]["num_registros"] == 1
    assert tables["ibge/microdados_pns_2013.txt"]["nome_fonte"] == "PNS/IBGE 2013 - Microdados Brutos"
    assert tables["ibge/microdados_pns_2013.txt"]["num_registros"] is None
    assert tables["ibge/microdados_pns_2013.txt"]["tamanho_bytes"] == 10
    assert reports.profile.collect() == []


def test_tidying_changes_no_table(spark, tmp_path):
    landing, lake = tmp_path / "in", str(tmp_path / "lake")
    for ids in (["a"], ["a", "b"], ["c", "d", "e"]):
        deliver(landing, "RDSP0801.dbf", *ids)
        deliver(landing, "LTSP2601.dbf", *ids)
        ingest(spark, "sih_rd", str(landing), lake)
        ingest(spark, "cnes_leitos", str(landing), lake)
    assert tidy_lake(spark, lake, keep=1) > 0
    assert rows_of(read_months(spark, table_path(lake, "sih", "aih_reduzida")).select("ID")) == [("c",), ("d",), ("e",)]
    assert rows_of(read_published(spark, table_path(lake, "cnes", "leitos")).select("ID")) == [("c",), ("d",), ("e",)]
    assert not ingest(spark, "sih_rd", str(landing), lake)[0].changed
    assert tidy_lake(spark, lake, keep=1) == 0


def test_scratch_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_scratch_base", lambda _: str(tmp_path / "scratch"))
    assert settled(spark.range(3), "x").count() == 3 and any(tmp_path.rglob("*.parquet"))
    clear_scratch(spark)
    assert not any(tmp_path.rglob("*"))


def test_reports_of_an_empty_lake(spark, tmp_path):
    reports = cat.lake_reports(spark, str(tmp_path), "sia/x", registry.FILE_FRAGMENTS, registry.source_dimension(spark))
    assert reports.files.collect() == reports.tables.collect() == []


def test_budget(spark, tmp_path):
    for folder, header in (
        ("csv_siops_subfuncao", "ano,municipio,v"),
        ("csv_siops_rreo", "municipio,ano"),
        ("csv_siops_indicador", "ano,municipio"),
    ):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(header + "\n" + ",".join("123"[: header.count(",") + 1]) + "\n")
    # One file in another encoding does not stop its folder.
    (tmp_path / "csv_siops_rreo" / "y.csv").write_bytes("município,ano\n1,2\n".encode("latin-1"))
    outcomes = ingest_budget(spark, str(tmp_path), str(tmp_path / "out"))
    assert [o.rejected.count() for o in outcomes] == [0, 1, 0]
    read = spark.read.option("header", True)
    assert [read.csv(o.target).columns for o in outcomes] == [["ano", "v"], ["ano"], ["ano", "municipio"]]
