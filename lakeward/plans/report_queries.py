"""Rates, enrichment, catalogues and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.periods import month_key_of
from lakeward.operators import catalogue as cat
from lakeward.operators.enrich import (
    dimension_lookup,
    first_substring_match,
    fragment_matches,
    left_enrich,
    rate_carried,
    rate_per,
    unmapped_folders,
)
from lakeward.operators.enrich import rate_per_municipality as municipality_rates
from lakeward.operators.partitions import month_list, rebuild_partitions, write_months
from lakeward.plans import registry
from lakeward.plans.catalog import query
from lakeward.plans.deliveries import SQL_LISTING, SQL_TAGGED, listing, table, tagged_orders
from lakeward.session import scratch_path
from lakeward.sinks.tables import hadoop_path, publish_table, publish_text
from lakeward.sources.files import table_row_counts


@query("""WITH pop AS (SELECT c_nationkey AS nk, count(*) AS population FROM customer GROUP BY 1),
    ev AS (SELECT c_nationkey AS nk, year(o_orderdate) AS ano, count(*) AS events
           FROM orders JOIN customer ON o_custkey = c_custkey
           WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT n_name, CAST(ano AS INTEGER) AS ano, events, population,
           round(CAST(100000 AS DOUBLE) * events / nullif(population, 0), 2) AS rate
    FROM ev JOIN pop ON ev.nk = pop.nk JOIN nation ON n_nationkey = ev.nk""")
def rate_per_100k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per 100 000 inhabitants by place and year.

    Orders are counted per customer and year before the join: a customer with a
    third of all orders is then a handful of rows.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("ano")).agg(
        F.count(F.lit(1)).alias("n")
    )
    events = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    population = customer.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("population"))
    rates = rate_per(events, population, "n_nationkey", "ano", weight="n")
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return dimension_lookup(rates, names, "n_nationkey").select("n_name", "ano", "events", "population", "rate")


@query("""WITH c AS (
        SELECT c_custkey, c_mktsegment,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN concat('9', c_nationkey)
                                 WHEN 'MACHINERY' THEN CAST(1000000 + c_nationkey AS VARCHAR)
                                 ELSE CAST(c_nationkey AS VARCHAR) END AS cod FROM customer),
    padded AS (SELECT c_custkey, c_mktsegment,
               CASE WHEN length(cod) < 6 THEN lpad(cod, 6, '0') ELSE cod END AS cod FROM c),
    places AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS muncod, n_name, n_regionkey FROM nation
               UNION ALL
               SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0'), concat(n_name, ' II'), n_regionkey
               FROM nation WHERE n_regionkey = 3)
    SELECT c_custkey, c_mktsegment, cod, n_name, n_regionkey
    FROM padded LEFT JOIN places ON cod = muncod""")
def left_enrich_padded_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of several lengths; some match nothing, some match twice."""
    code = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("9"), F.col("c_nationkey").cast("string")))
        .when(F.col("c_mktsegment") == "MACHINERY", (F.col("c_nationkey") + 1000000).cast("string"))
        .otherwise(F.col("c_nationkey").cast("string"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", code.alias("cod"))
    nation = table(spark, sf_dir, "nation")
    text = F.col("n_nationkey").cast("string")
    places = nation.select(text.alias("MUNCOD"), "n_name", "n_regionkey")
    twice = nation.where("n_regionkey = 3").select(
        F.lpad(text, 4, "0").alias("MUNCOD"), F.concat("n_name", F.lit(" II")).alias("n_name"), "n_regionkey"
    )
    return left_enrich(customers, places.unionByName(twice), "cod", "MUNCOD")


FRAGMENTS = [("small", "r0"), ("ring", "r1"), ("red bolt", "r2"), ("bolt", "r3"), ("widget", "r4")]


@query("""SELECT p_partkey, p_name,
        CASE WHEN contains(p_name, 'small') THEN 'AFRICA' WHEN contains(p_name, 'ring') THEN 'AMERICA'
             WHEN contains(p_name, 'red bolt') THEN 'ASIA' WHEN contains(p_name, 'bolt') THEN 'EUROPE'
             WHEN contains(p_name, 'widget') THEN 'MIDDLE EAST'
             WHEN p_brand = 'Brand#1' THEN 'AMERICA' ELSE 'unmapped' END AS name
    FROM part""", name="first_substring_match")
def region_of_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First fragment contained in the name, then a fallback by brand, then a label."""
    regions = table(spark, sf_dir, "region").select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("name")
    )
    fallback = F.when(F.col("p_brand") == "Brand#1", "r1")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.coalesce(first_substring_match("p_name", FRAGMENTS), fallback).alias("id")
    )
    named = dimension_lookup(parts, regions, "id", strict=False)
    return named.select("p_partkey", "p_name", F.coalesce("name", F.lit("unmapped")).alias("name"))


@query("""SELECT p_partkey,
        CASE WHEN contains(p_name, 'red bolt') THEN 'r2' WHEN contains(p_name, 'widget') THEN 'r4'
             WHEN contains(p_name, 'small') THEN 'r0' WHEN contains(p_name, 'ring') THEN 'r1'
             WHEN contains(p_name, 'bolt') THEN 'r3' END AS id
    FROM part""")
def longest_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", first_substring_match("p_name", FRAGMENTS, longest=True).alias("id"))


_SQL_FRAGMENTS = """names AS (SELECT p_partkey, concat(p_name, '/', p_brand, '/', p_partkey) AS nome FROM part),
    dictionary AS (
        SELECT concat(substr(p_brand, 6), '/', p_partkey // 10) AS fragment, concat('d', p_partkey) AS target, (p_partkey * 7919) % 10007 AS priority FROM part
        UNION ALL SELECT CASE WHEN p_partkey % 50 = 7 THEN p_name ELSE concat(p_partkey % 97, 'e') END, concat('n', p_partkey), 10007 + p_partkey % 11 FROM part
        UNION ALL SELECT concat(p_partkey % 89, '/'), concat('s', p_partkey), 20000 FROM part WHERE p_partkey % 4 = 1)"""


def _sql_match(order: str) -> str:
    return f"""WITH {_SQL_FRAGMENTS},
    met AS (SELECT p_partkey, target, row_number() OVER (PARTITION BY p_partkey ORDER BY {order}) AS place
            FROM names JOIN dictionary ON contains(nome, fragment))
    SELECT n.p_partkey, target AS match FROM names n LEFT JOIN met m ON n.p_partkey = m.p_partkey AND place = 1"""


def _names_and_dictionary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names of parts, and a dictionary of two fragments and more for each part, some of them several times."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    text = lambda *parts: F.concat(*[p.cast("string") for p in parts])
    slash = F.lit("/")
    names = part.select("p_partkey", text(F.col("p_name"), slash, F.col("p_brand"), slash, key).alias("nome"))
    shown = F.when(key % 50 == 7, F.col("p_name")).otherwise(text(key % 97, F.lit("e")))
    number = lambda c: c.cast("bigint").alias("priority")
    entries = [
        part.select(text(F.substring("p_brand", 6, 99), slash, F.floor(key / 10)).alias("fragment"), text(F.lit("d"), key).alias("target"), number((key * 7919) % 10007)),
        part.select(shown.alias("fragment"), text(F.lit("n"), key).alias("target"), number(key % 11 + 10007)),
        part.where(key % 4 == 1).select(text(key % 89, slash).alias("fragment"), text(F.lit("s"), key).alias("target"), number(F.lit(20000))),
    ]
    return names, entries[0].unionByName(entries[1]).unionByName(entries[2])


@query(_sql_match("priority, fragment, target"))
def fragments_of_a_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first contained fragment by priority, from a dictionary as large as the names."""
    names, dictionary = _names_and_dictionary(spark, sf_dir)
    return fragment_matches(names, "nome", dictionary).select("p_partkey", "match")


@query(_sql_match("-length(fragment), priority, fragment, target"))
def longest_fragment_of_a_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, dictionary = _names_and_dictionary(spark, sf_dir)
    return fragment_matches(names, "nome", dictionary, longest=True).select("p_partkey", "match")


@query("""SELECT s_suppkey, s_name, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
       name="dimension_lookup")
def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    places = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return dimension_lookup(suppliers, places, "n_nationkey").drop("n_nationkey")


@query("""SELECT DISTINCT p_brand AS diretorio FROM part
    WHERE NOT (contains(p_name, 'small') OR contains(p_name, 'bolt') OR contains(p_name, 'widget'))""",
       name="unmapped_folders")
def brands_without_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = [(f, f) for f in ("small", "bolt", "widget")]
    named = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("diretorio"),
        F.coalesce(first_substring_match("p_name", known), F.lit(cat.UNMAPPED)).alias("nome_fonte"),
    )
    return unmapped_folders(named)


# ---- catalogues --------------------------------------------------------------

_SQL_LINE_FILES = """months AS (
    SELECT strftime(l_shipdate, '%Y%m') AS period, l_returnflag AS part, count(*) AS rows,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes, max(l_shipdate) AS mtime
    FROM lineitem GROUP BY 1, 2)"""


def _line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as the files of an inventory: one per month and return flag."""
    lines = table(spark, sf_dir, "lineitem").select(
        month_key_of("l_shipdate").alias("period"),
        F.col("l_returnflag").alias("part"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_shipdate",
    )
    return lines.groupBy("period", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("bytes"), F.max("l_shipdate").alias("mtime")
    )


@query(f"""WITH {_SQL_LINE_FILES},
    years AS (SELECT CAST(substr(period, 1, 4) AS INTEGER) AS ano, count(*) AS num_arquivos, max(period) AS p,
                     CAST(sum(rows) AS BIGINT) AS num_registros, max(mtime) AS mtime FROM months GROUP BY 1)
    SELECT ano, num_arquivos, concat(substr(p, 5, 2), '/', substr(p, 1, 4)) AS ultima_competencia, num_registros,
           CAST(sum(num_registros) OVER (ORDER BY ano) AS BIGINT) AS registros_acumulado,
           strftime(mtime - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ultima_atualizacao
    FROM years ORDER BY ano DESC""")
def yearly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.yearly_profile(_line_files(spark, sf_dir), "period", zone="UTC")


@query(f"""WITH {_SQL_LINE_FILES}
    SELECT count(*) AS total_arquivos, count(DISTINCT period) AS total_competencias,
           CAST(sum(rows) AS BIGINT) AS total_registros, CAST(sum(bytes) AS BIGINT) AS total_bytes,
           min(period) AS primeira_competencia, max(period) AS ultima_competencia,
           concat(substr(min(period), 1, 4), '-', substr(max(period), 1, 4)) AS anos_cobertos,
           strftime(max(mtime) - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ultima_atualizacao
    FROM months""")
def grand_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.grand_summary(_line_files(spark, sf_dir), "period", zone="UTC")


_GAPS = "substr(period, 1, 4) <> '1998' AND substr(period, 5, 2) NOT IN ('02', '11')"
_GAPS_SPARK = "substring(period, 1, 4) <> '1998' and substring(period, 5, 2) not in ('02', '11')"


@query(f"""WITH {SQL_LISTING},
    kept AS (SELECT period, count(*) AS n, sum(fingerprint) AS bytes FROM files WHERE {_GAPS} GROUP BY period),
    years AS (SELECT unnest(generate_series(min(CAST(substr(period, 1, 4) AS INTEGER)),
                                            max(CAST(substr(period, 1, 4) AS INTEGER)))) AS ano FROM kept),
    cells AS (SELECT ano, lpad(CAST(m AS VARCHAR), 2, '0') AS mes
              FROM years CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS m)),
    filled AS (SELECT c.ano, c.mes, k.n, k.bytes FROM cells c
               LEFT JOIN kept k ON k.period = concat(c.ano, c.mes)),
    per_year AS (SELECT CAST(ano AS INTEGER) AS ano, CAST(coalesce(sum(n), 0) AS BIGINT) AS arquivos,
                        count(n) AS meses, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes,
                        string_agg(CASE WHEN n IS NULL THEN mes END, ',' ORDER BY mes) AS missing
                 FROM filled GROUP BY ano)
    SELECT ano, arquivos, meses, bytes,
           CASE WHEN meses > 0 AND missing <> '' THEN concat('meses ', missing) ELSE '' END AS faltantes
    FROM per_year
    UNION ALL
    SELECT NULL, CAST(sum(arquivos) AS BIGINT), CAST(sum(meses) AS BIGINT), CAST(sum(bytes) AS BIGINT), ''
    FROM per_year""")
def coverage_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = listing(spark, sf_dir).where(_GAPS_SPARK).withColumnRenamed("fingerprint", "bytes")
    return cat.coverage_with_total(files, "period")


@query(f"""WITH {SQL_LISTING},
    kept AS (SELECT DISTINCT period FROM files WHERE {_GAPS}),
    cells AS (SELECT ano, lpad(CAST(m AS VARCHAR), 2, '0') AS mes
              FROM (SELECT DISTINCT substr(period, 1, 4) AS ano FROM kept)
              CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS m))
    SELECT CAST(ano AS INTEGER) AS ano, string_agg(mes, ',' ORDER BY mes) AS missing
    FROM cells WHERE concat(ano, mes) NOT IN (SELECT period FROM kept) GROUP BY ano""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.coverage_gaps(tagged_orders(spark, sf_dir).where(_GAPS_SPARK), "period")


@query(f"""WITH {SQL_LISTING}
    SELECT uf, count(*) AS n_files, CAST(substr(min(period), 1, 4) AS INTEGER) AS first_year,
           CAST(substr(max(period), 1, 4) AS INTEGER) AS last_year,
           min(period) AS first_period, max(period) AS last_period
    FROM files GROUP BY uf""")
def period_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.period_extent(listing(spark, sf_dir), "uf", "period")


@query(f"""WITH {SQL_LISTING}
    SELECT period, count(*) AS n_files, string_agg(key, ',' ORDER BY key) AS files FROM files GROUP BY period""")
def group_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.group_files(listing(spark, sf_dir), "period", "key")


_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(" UNION ALL ".join(f"SELECT '{t}.parquet' AS name, count(*) AS rows FROM {t}" for t in _TABLES))
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table, one file or a folder of files, from the footers; a table without rows counts zero."""
    return table_row_counts(spark, sf_dir)


def _small_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake with a monthly table of two versions, published tables (one revised, one without rows, one with an
    unfinished version), a text, and a folder that no source has and whose name needs care."""
    lake = scratch_path(spark, "lake")
    orders = tagged_orders(spark, sf_dir).select("o_orderkey", "cents", "uf", "period")
    months = orders.select("o_orderkey", "cents", F.col("period").alias("competencia"))
    write_months(months, f"{lake}/sia/producao_ambulatorial")
    recent = months.where("competencia >= '200001'")
    # Months that the second delivery names but has no rows for go.
    rebuild_partitions(recent.where("o_orderkey % 2 = 0"), month_list(recent, "competencia"), f"{lake}/sia/producao_ambulatorial")
    publish_table(orders, f"{lake}/cnes/leitos")
    publish_table(orders.where("uf = 'SP'"), f"{lake}/cnes/leitos")
    publish_table(orders.where("uf = 'RJ'"), f"{lake}/sih/aih_reduzida")
    unfinished = publish_table(orders, f"{lake}/sih/aih_reduzida")
    system, mark = hadoop_path(spark, f"{unfinished}/_SUCCESS")
    system.delete(mark, False)
    publish_table(orders.where("false"), f"{lake}/sim/declaracoes_de_obito_cid9")
    publish_text(orders.select(F.col("uf").alias("value")), f"{lake}/ibge/microdados_pns_2013.txt")
    publish_table(table(spark, sf_dir, "customer"), f"{lake}/outros dados 100%/notas")
    return lake


def _reports(spark: SparkSession, sf_dir: str) -> cat.LakeReports:
    return cat.lake_reports(
        spark, _small_lake(spark, sf_dir), "sia/producao_ambulatorial", registry.FILE_FRAGMENTS,
        registry.source_dimension(spark), registry.FOLDER_SOURCES,
    )


@query(f"""WITH {SQL_TAGGED}
    SELECT 'cnes' AS diretorio, 'cnes/leitos' AS tabela, 'CNES - Leitos' AS nome_fonte, count(*) AS num_registros FROM tagged WHERE uf = 'SP'
    UNION ALL SELECT 'sih', 'sih/aih_reduzida', 'SIH/SUS - AIH Reduzida', count(*) FROM tagged WHERE uf = 'RJ'
    UNION ALL SELECT 'sim', 'sim/declaracoes_de_obito_cid9', 'SIM - Declaração de Óbito, CID-9 (1979-1995)', 0
    UNION ALL SELECT 'ibge', 'ibge/microdados_pns_2013.txt', 'PNS/IBGE 2013 - Microdados Brutos', NULL
    UNION ALL SELECT 'outros dados 100%', 'outros dados 100%/notas', '(não mapeado no registro)', count(*) FROM customer""")
def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of a whole lake by table. Numbers of files, sizes and times belong to the files."""
    return _reports(spark, sf_dir).tables.select("diretorio", "tabela", "nome_fonte", "num_registros")


@query(f"""WITH {SQL_TAGGED},
    years AS (SELECT CAST(substr(period, 1, 4) AS INTEGER) AS ano, count(DISTINCT period) AS meses, max(period) AS p, count(*) AS num_registros
              FROM tagged WHERE period < '200001' OR o_orderkey % 2 = 0 GROUP BY 1)
    SELECT ano, concat(substr(p, 5, 2), '/', substr(p, 1, 4)) AS ultima_competencia, num_registros,
           CAST(sum(num_registros) OVER (ORDER BY ano) AS BIGINT) AS registros_acumulado, meses
    FROM years""")
def lake_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly table by year, from its files in the lake, with the months that it has."""
    reports = _reports(spark, sf_dir)
    profile = reports.profile.select("ano", "ultima_competencia", "num_registros", "registros_acumulado")
    return profile.join(reports.coverage.select("ano", "meses"), "ano")


@query(f"""WITH {SQL_TAGGED},
    coded AS (SELECT year(o_orderdate) AS ano, c_nationkey AS nk FROM orders JOIN customer ON o_custkey = c_custkey),
    ev AS (SELECT CAST(350000 + nk AS VARCHAR) AS codigo, ano, count(*) AS events FROM coded GROUP BY 1, 2),
    pop AS (SELECT CAST(350000 + c_nationkey AS VARCHAR) AS codigo, count(*) AS population FROM customer GROUP BY 1)
    SELECT ev.codigo, CAST(ev.ano AS INTEGER) AS ano, events, population, round(CAST(100000 AS DOUBLE) * events / population, 2) AS rate
    FROM ev LEFT JOIN pop ON ev.codigo = pop.codigo AND ev.ano <> 1998""")
def rate_per_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with seven digits or six, populations the other way round, and a year without populations."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 350000).cast("string").alias("six"), "c_nationkey")
    odd = F.col("c_nationkey") % 2 == 1
    seven = F.concat("six", F.lit("8"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("ano"))
    events = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(odd, seven).otherwise(F.col("six")).alias("codigo"), "ano"
    )
    people = customer.groupBy(F.when(odd, F.col("six")).otherwise(seven).alias("place")).agg(F.count(F.lit(1)).alias("population"))
    years = orders.select("ano").distinct().where("ano <> 1998")
    population = people.withColumn("ano", F.explode(F.lit([r["ano"] for r in years.collect()])))
    return municipality_rates(events, population, "codigo", "place", "ano")


@query("""WITH ev AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS events
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    people AS (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey <> 7 GROUP BY 1),
    pop AS (
        SELECT c_nationkey, y.ano, n + y.ano - 1997 AS population FROM people, (VALUES (1997), (2000)) y(ano) WHERE c_nationkey % 2 = 0
        UNION ALL SELECT c_nationkey, 1999, n + 2 FROM people WHERE c_nationkey % 2 = 1),
    near AS (
        SELECT ev.c_nationkey, ev.ano, pop.ano AS population_year, population,
               row_number() OVER (PARTITION BY ev.c_nationkey, ev.ano ORDER BY abs(pop.ano - ev.ano), pop.ano) AS n
        FROM ev JOIN pop ON ev.c_nationkey = pop.c_nationkey AND abs(pop.ano - ev.ano) <= 2)
    SELECT ev.c_nationkey, ev.ano, events, CAST(population AS BIGINT) AS population, CAST(population_year AS INTEGER) AS population_year,
           population_year <> ev.ano AS carried, round(CAST(100000 AS DOUBLE) * events / nullif(population, 0), 2) AS rate
    FROM ev LEFT JOIN near ON near.c_nationkey = ev.c_nationkey AND near.ano = ev.ano AND near.n = 1""")
def rate_carried_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all years where places have populations of one or two years, or of none; two years away at most."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    events = (
        table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("ano")).agg(F.count(F.lit(1)).alias("n"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    people = customer.where("c_nationkey <> 7").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    years = F.when(F.col("c_nationkey") % 2 == 0, F.array(F.lit(1997), F.lit(2000))).otherwise(F.array(F.lit(1999)))
    population = people.select("c_nationkey", "n", F.explode(years).alias("ano")).withColumn("population", F.col("n") + F.col("ano") - 1997)
    return rate_carried(events, population, "c_nationkey", "ano", reach=2, weight="n")
