"""Sources, their file names, tables and ways of merging.

The ids, names, folders, tables, prefixes and year limits below are fixed
values: published paths, file names and reports depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeward.operators.names import NameRule
from lakeward.session import small_table

MERGE = "merge"  # replace the rows of files delivered again
SNAPSHOT = "snapshot"  # keep the latest month only
MONTHS = "months"  # one partition per month
YEARS = "years"  # replace whole years
REPLACE = "replace"  # one file, published whole
TEXT = "text"  # raw lines


@dataclass(frozen=True)
class Source:
    id: str
    nome: str
    descricao: str
    tipo: str
    pasta: str
    table: str
    way: str
    rule: NameRule | None = None


def _monthly(source: str, prefix: str) -> NameRule:
    return NameRule(source, prefix, "uf", "month", 90)


# Id, name, prefix, table of the authorisation records.
_SIA = [
    ("sia_am", "SIA/SUS - APAC de Medicamentos", "AM", "apac_medicamentos"),
    ("sia_aq", "SIA/SUS - APAC de Quimioterapia", "AQ", "apac_quimioterapia"),
    ("sia_ar", "SIA/SUS - APAC de Radioterapia", "AR", "apac_radioterapia"),
    ("sia_atd", "SIA/SUS - APAC de Tratamento Dialítico", "ATD", "apac_tratamento_dialitico"),
    ("sia_an", "SIA/SUS - APAC de Nefrologia", "AN", "apac_nefrologia"),
    ("sia_ad", "SIA/SUS - APAC de Laudos Diversos", "AD", "apac_laudos_diversos"),
    ("sia_ps", "SIA/SUS - Psicossocial (RAAS)", "PS", "psicossocial"),
    ("sia_sad", "SIA/SUS - Atenção Domiciliar (RAAS)", "SAD", "atencao_domiciliar"),
    ("sia_acf", "SIA/SUS - APAC de Confecção de Fístula Arteriovenosa", "ACF", "apac_confeccao_fistula"),
    ("sia_ab", "SIA/SUS - APAC de Cirurgia Bariátrica", "AB", "apac_cirurgia_bariatrica"),
    ("sia_abo", "SIA/SUS - APAC de Acompanhamento Pós Cirurgia Bariátrica", "ABO", "apac_pos_cirurgia_bariatrica"),
]

# Id, name, prefix, table of the registry snapshots.
_CNES = [
    ("cnes_habilitacoes", "CNES - Habilitações", "HB", "habilitacoes"),
    ("cnes_leitos", "CNES - Leitos", "LT", "leitos"),
    ("cnes_profissionais", "CNES - Profissionais", "PF", "profissionais"),
    ("cnes_equipamentos", "CNES - Equipamentos", "EQ", "equipamentos"),
]

# Id, name, prefix, table of the hospital admissions.
_SIH = [
    ("sih_rd", "SIH/SUS - AIH Reduzida", "RD", "aih_reduzida"),
    ("sih_rj", "SIH/SUS - AIH Rejeitadas", "RJ", "aih_rejeitada"),
    ("sih_sp", "SIH/SUS - Serviços Profissionais", "SP", "servicos_profissionais"),
]

# Id, name, table, file name rule of the death records.
_SIM = [
    ("sim_do_cid9", "SIM - Declaração de Óbito, CID-9 (1979-1995)", "declaracoes_de_obito_cid9",
     NameRule("sim_do_cid9", "DORBR", "none", "year", 79, 1979, 1995)),
    ("sim_do_cid10", "SIM - Declaração de Óbito, CID-10 (1996-atual)", "declaracoes_de_obito_cid10",
     NameRule("sim_do_cid10", "DOBR", "none", "year4", None, 1996, None)),
    ("sim_causas_externas_cid9", "SIM - Causas Externas, CID-9 (1979-1995)", "declaracoes_de_obito_causas_externas_cid9",
     NameRule("sim_causas_externas_cid9", "DOEXT", "none", "year", 79, 1979, 1995)),
    ("sim_causas_externas_cid10", "SIM - Causas Externas, CID-10 (1996-atual)", "declaracoes_de_obito_causas_externas_cid10",
     NameRule("sim_causas_externas_cid10", "DOEXT", "none", "year", 79, 1996, None)),
    ("sim_dofet_cid9", "SIM - Óbitos Fetais, CID-9 (1979-1995)", "declaracoes_de_obito_fetais_cid9",
     NameRule("sim_dofet_cid9", "DOFET", "none", "year2", 79, 1979, 1995)),
    ("sim_dofet_cid10", "SIM - Óbitos Fetais, CID-10 (1996-atual)", "declaracoes_de_obito_fetais_cid10",
     NameRule("sim_dofet_cid10", "DOFET", "none", "year2", 79, 1996, None)),
    ("sim_doinf_cid9", "SIM - Óbitos Infantis, CID-9 (1979-1995)", "declaracoes_de_obito_infantis_cid9",
     NameRule("sim_doinf_cid9", "DOINF", "none", "year2", 79, 1979, 1995)),
    ("sim_doinf_cid10", "SIM - Óbitos Infantis, CID-10 (1996-atual)", "declaracoes_de_obito_infantis_cid10",
     NameRule("sim_doinf_cid10", "DOINF", "none", "year2", 79, 1996, None)),
    ("sim_domat", "SIM - Óbitos Maternos (1996-atual)", "declaracoes_de_obito_maternos_cid10",
     NameRule("sim_domat", "DOMAT", "none", "year2", 79, 1996, None)),
    ("sim_dorext", "SIM - Mortalidade de Residentes no Exterior (2013-atual)", "declaracoes_de_obito_residentes_exterior_cid10",
     NameRule("sim_dorext", "DOREXT", "none", "year2", 79, 2013, None)),
]

SOURCES: list[Source] = [
    Source("cnes_estabelecimentos", "CNES - Estabelecimentos de Saúde", "Cadastro dos estabelecimentos de saúde.",
           "pipeline", "cnes", "estabelecimentos_de_saude", REPLACE),
    *[Source(i, n, "Retrato do último mês do cadastro.", "pipeline", "cnes", t, SNAPSHOT, _monthly(i, p)) for i, n, p, t in _CNES],
    *[Source(i, n, "Registros anuais de óbitos.", "pipeline", "sim", t, MERGE, r) for i, n, t, r in _SIM],
    Source("sinasc", "SINASC - Nascidos Vivos", "Registros anuais de nascimentos por estado.",
           "pipeline", "sinasc", "declaracoes_de_nascido_vivo", MERGE, NameRule("sinasc", "DN", "state", "year", None)),
    Source("sinasc_dnex", "SINASC - Nascidos Vivos no Exterior (DNEX)", "Registros anuais de nascimentos no exterior.",
           "pipeline", "sinasc", "declaracoes_de_nascido_vivo_exterior", MERGE, NameRule("sinasc_dnex", "DNEX", "none", "year4", None)),
    *[Source(i, n, "Internações por estado e mês.", "pipeline", "sih", t, MERGE, _monthly(i, p)) for i, n, p, t in _SIH],
    Source("sinan", "SINAN - Doenças e Agravos de Notificação Compulsória", "Uma tabela por agravo.",
           "pipeline", "sinan", "", MERGE),
    Source("sia_pa", "SIA/SUS - Produção Ambulatorial", "Procedimentos ambulatoriais, uma partição por mês.",
           "pipeline", "sia", "producao_ambulatorial", MONTHS, NameRule("sia_pa", "PA", "uf", "month", 94)),
    *[Source(i, n, "Autorizações e atendimentos por estado e mês.", "pipeline", "sia", t, MERGE, _monthly(i, p)) for i, n, p, t in _SIA],
    Source("ciha", "CIHA - Comunicação de Informação Hospitalar e Ambulatorial", "Internações e atendimentos comunicados.",
           "pipeline", "ciha", "comunicacao_internacao_hospitalar_ambulatorial", MERGE, _monthly("ciha", "CIHA")),
    Source("macroregiao", "Macrorregiões de Saúde (geolocalização)", "Municípios com sua macrorregião e coordenadas.",
           "pipeline", "geo", "macroregiao_de_saude", REPLACE),
    Source("ibge_populacao", "IBGE - População Estimada por Município", "População por município e ano.",
           "pipeline", "ibge", "populacao_estimada", YEARS),
    Source("ibge_pib_municipal", "IBGE - PIB Municipal", "Produto interno bruto por município e ano.",
           "pipeline", "ibge", "pib_municipal", YEARS),
    Source("pns_2013", "PNS/IBGE 2013 - Microdados Brutos", "Linhas de posição fixa.",
           "pipeline_manual", "ibge", "microdados_pns_2013.txt", TEXT),
    Source("pns_2019", "PNS/IBGE 2019 - Microdados Brutos", "Linhas de posição fixa.",
           "pipeline_manual", "ibge", "microdados_pns_2019.txt", TEXT),
]

# Prefix and table of each notifiable disease.
DISEASES: list[tuple[str, str]] = [
    ("DENG", "dengue"),
    ("CHIK", "chikungunya"),
    ("ZIKA", "zika"),
    ("TUBE", "tuberculose"),
    ("VIOL", "violencia_interpessoal_autoprovocada"),
    ("SIFA", "sifilis_adquirida"),
    ("SIFC", "sifilis_congenita"),
    ("SIFG", "sifilis_em_gestante"),
    ("HANS", "hanseniase"),
    ("AIDA", "aids_adulto"),
    ("AIDC", "aids_crianca"),
    ("HIVA", "hiv_adulto"),
    ("HIVC", "hiv_crianca"),
    ("HIVE", "hiv_gestante"),
    ("HIVG", "hiv_outro_perfil"),
    ("HEPA", "hepatites_virais"),
    ("MALA", "malaria"),
    ("LEPT", "leptospirose"),
    ("CHAG", "doenca_de_chagas_aguda"),
    ("ESQU", "esquistossomose"),
    ("LEIV", "leishmaniose_visceral"),
    ("LTAN", "leishmaniose_tegumentar_americana"),
    ("MENI", "meningite"),
    ("PNEU", "doenca_pneumococica_invasiva"),
    ("DIFT", "difteria"),
    ("COQU", "coqueluche"),
    ("TETA", "tetano_acidental"),
    ("TETN", "tetano_neonatal"),
    ("ANIM", "acidente_por_animal_peconhento"),
    ("FMAC", "febre_maculosa"),
    ("ACBI", "acidente_trabalho_material_biologico"),
    ("ACGR", "acidente_trabalho_grave"),
    ("CANC", "cancer_relacionado_ao_trabalho"),
    ("DERM", "dermatose_ocupacional"),
    ("LER", "ler_dort"),
    ("LERD", "ler_dort_detalhado"),
    ("MENT", "transtorno_mental_relacionado_ao_trabalho"),
    ("PAIR", "perda_auditiva_indzuida_por_ruido"),
    ("PEST", "peste"),
    ("ANTR", "antraz"),
    ("BOTU", "botulismo"),
    ("COLE", "colera"),
    ("TRAC", "tracoma"),
    ("RAIV", "raiva_humana"),
    ("HANT", "hantavirose"),
    ("FTIF", "febre_tifoide"),
    ("TOXC", "toxoplasmose_congenita"),
    ("TOXG", "toxoplasmose_gestacional"),
    ("PFAN", "paralisia_flacida_aguda"),
    ("ROTA", "rotavirus"),
    ("SDTA", "surto_doenca_transmitida_por_alimentos"),
    ("IEXO", "intoxicacao_exogena"),
    ("SRC", "sindrome_da_rubeola_congenita"),
    ("EXAN", "doenca_exantematica_suspeita"),
    ("VARC", "varicela_grave"),
    ("DCRJ", "doenca_de_chagas_reacao_transfusional"),
    ("NTRA", "notificacao_acidente_trabalho"),
    ("ESPO", "esporotricose"),
]

# Part of a published file name and the source it belongs to, in
# the order in which they are tried.
FILE_FRAGMENTS: list[tuple[str, str]] = [
    ("estabelecimentos_de_saude", "cnes_estabelecimentos"),
    ("habilitacoes", "cnes_habilitacoes"),
    ("leitos", "cnes_leitos"),
    ("profissionais", "cnes_profissionais"),
    ("equipamentos", "cnes_equipamentos"),
    ("causas_externas_cid10", "sim_causas_externas_cid10"),
    ("causas_externas_cid9", "sim_causas_externas_cid9"),
    ("fetais_cid10", "sim_dofet_cid10"),
    ("fetais_cid9", "sim_dofet_cid9"),
    ("infantis_cid10", "sim_doinf_cid10"),
    ("infantis_cid9", "sim_doinf_cid9"),
    ("maternos_cid10", "sim_domat"),
    ("residentes_exterior", "sim_dorext"),
    ("declaracoes_de_obito_cid10", "sim_do_cid10"),
    ("declaracoes_de_obito_cid9", "sim_do_cid9"),
    ("nascido_vivo_exterior", "sinasc_dnex"),
    ("nascido_vivo", "sinasc"),
    ("aih_reduzida", "sih_rd"),
    ("aih_rejeitada", "sih_rj"),
    ("servicos_profissionais", "sih_sp"),
    ("producao_ambulatorial", "sia_pa"),
    ("apac_medicamentos", "sia_am"),
    ("apac_quimioterapia", "sia_aq"),
    ("apac_radioterapia", "sia_ar"),
    ("apac_nefrologia", "sia_an"),
    ("apac_tratamento_dialitico", "sia_atd"),
    ("apac_laudos_diversos", "sia_ad"),
    ("psicossocial", "sia_ps"),
    ("atencao_domiciliar", "sia_sad"),
    ("apac_confeccao_fistula", "sia_acf"),
    ("apac_pos_cirurgia_bariatrica", "sia_abo"),
    ("apac_cirurgia_bariatrica", "sia_ab"),
    ("comunicacao_internacao_hospitalar_ambulatorial", "ciha"),
    ("macroregiao_de_saude", "macroregiao"),
    ("populacao_estimada", "ibge_populacao"),
    ("pib_municipal", "ibge_pib_municipal"),
    ("pns_2013", "pns_2013"),
    ("pns_2019", "pns_2019"),
]

# Folders whose files belong to one source whatever their name.
FOLDER_SOURCES = {"sinan": "sinan"}


def disease_rules() -> list[NameRule]:
    return [NameRule(table, prefix, "br", "year2", 90) for prefix, table in DISEASES]


def name_rules() -> list[NameRule]:
    return [s.rule for s in SOURCES if s.rule] + disease_rules()


def get_source(source_id: str) -> Source:
    for source in SOURCES:
        if source.id == source_id:
            return source
    raise KeyError(f"source {source_id!r} is not registered")


def source_dimension(spark: SparkSession) -> DataFrame:
    columns = ("id", "nome", "descricao", "tipo", "pasta")
    rows = [{name: getattr(source, name) for name in columns} for source in SOURCES]
    return small_table(spark, rows, pa.schema([(name, pa.string()) for name in columns]))


def disease_dimension(spark: SparkSession) -> DataFrame:
    rows = [{"prefix": prefix, "table": table} for prefix, table in DISEASES]
    return small_table(spark, rows, pa.schema([("prefix", pa.string()), ("table", pa.string())]))
