"""Readers and writers: a table is written in a delivery format and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.periods import month_key_of
from lakeward.functions.text import file_name
from lakeward.operators.conform import tag_file
from lakeward.operators.names import classify_names, rule_table
from lakeward.operators.partitions import merge_partitions, read_months, read_rejects, write_months
from lakeward.plans import registry
from lakeward.plans.catalog import ORACLES, query
from lakeward.plans.deliveries import SQL_TAGGED, table, tagged_orders, write_dbf, write_ragged_lines
from lakeward.plans.ingest import consolidate_folder, ingest_merge, ingest_months, ingest_snapshot, ingest_text, ingest_years
from lakeward.session import scratch_path
from lakeward.sinks.tables import latest_version, publish_counted, publish_table, publish_text, read_published, write_csv
from lakeward.sources.dbf import LINEAGE, read_headers, scan_dbf
from lakeward.sources.dbf_format import dbf_schema, read_dbf
from lakeward.sources.delimited import (
    scan_csv_union_by_header,
    scan_csv_union_with_rejects,
    scan_delimited,
    scan_delimited_files,
    scan_delimited_with_rejects,
)
from lakeward.sources.files import scan_file_inventory
from lakeward.sources.json_arrays import POPULATION_COLUMNS, picked_rows, scan_answers, scan_header_first_json
from lakeward.sources.parquet import scan_calendar, scan_month_range, scan_months
from lakeward.sources.parquet import scan_parquet_union_by_name as read_parts
from lakeward.sources.rawtext import apply_layout, scan_raw_text
from lakeward.streaming.arrivals import stream_append_new_files
from lakeward.streaming.revisions import stream_revised_files

# ---- delimited text ----------------------------------------------------------

# Texts as one-line Latin-1 fields; documents of one source lose a field, of another gain one.


def _delivered_lines(spark: SparkSession, sf_dir: str) -> str:
    documents = table(spark, sf_dir, "documents")
    body = F.regexp_replace(F.regexp_replace("text", r'[\r\n;"\\\x01]+', " "), r"[^\x20-\xFF]", "?")
    code = F.lpad(F.col("doc_id").cast("string"), 8, "0")
    line = F.concat_ws(";", code, "lang", F.concat(F.lit("a"), body, F.lit("z")))
    ragged = (
        F.when(F.col("source") == "src3", F.concat_ws(";", code, "lang"))
        .when(F.col("source") == "src5", F.concat(line, F.lit(";extra")))
        .otherwise(line)
    )
    path = scratch_path(spark, "delimited")
    write_ragged_lines(documents.select(ragged), "CO_CNES;IDIOMA;NO_RAZÃO", path, "ISO-8859-1")
    return path


_SQL_BODY = (
    "concat('a', regexp_replace(regexp_replace(text, '[\\r\\n;\"\\\\\\x01]+', ' ', 'g'),"
    " '[^\\x{20}-\\x{FF}]', '?', 'g'), 'z')"
)


@query(f"""SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS CO_CNES, lang AS IDIOMA, {_SQL_BODY} AS "NO_RAZÃO"
    FROM documents WHERE source NOT IN ('src3', 'src5')""", name="scan_delimited")
def latin1_with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with too few or too many fields are dropped; zeros stay in front."""
    return scan_delimited(spark, _delivered_lines(spark, sf_dir))


@query("""SELECT CASE WHEN source = 'src3' THEN 'short' WHEN source = 'src5' THEN 'long' ELSE 'good' END AS kind,
        count(*) AS n FROM documents GROUP BY 1""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines are set aside, good lines are kept."""
    good, rejected = scan_delimited_with_rejects(spark, _delivered_lines(spark, sf_dir))
    bad = rejected.select(F.when(F.endswith("line", F.lit(";extra")), "long").otherwise("short").alias("kind"))
    every = good.select(F.lit("good").alias("kind")).unionByName(bad)
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey AS codigo, c_name AS nome, CAST(NULL AS VARCHAR) AS classe,
        CAST(c_nationkey AS VARCHAR) AS valor FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier
    UNION ALL SELECT p_partkey, p_name, p_brand, p_type FROM part""", name="scan_csv_union_by_header")
def budgets_with_other_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers differ in order and set; one name is a number here and a text there."""
    path = scratch_path(spark, "budget")
    customer, supplier, part = (table(spark, sf_dir, t) for t in ("customer", "supplier", "part"))
    write_csv(customer.selectExpr("c_custkey as codigo", "c_name as nome", "c_nationkey as valor"), f"{path}/a")
    write_csv(supplier.selectExpr("s_nationkey as valor", "s_name as nome", "s_suppkey as codigo"), f"{path}/b")
    write_csv(
        part.selectExpr("p_partkey as codigo", "p_name as nome", "p_brand as classe", "p_type as valor"), f"{path}/c"
    )
    rows = scan_csv_union_by_header(spark, path)
    return rows.select(F.col("codigo").cast("bigint").alias("codigo"), "nome", "classe", "valor")


@query("""SELECT CAST(o_orderkey AS BIGINT) AS codigo, o_orderpriority AS fase, CAST(round(o_totalprice * 100) AS BIGINT) AS valor
    FROM orders""")
def consolidate_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder into one CSV without its municipality column, read back."""
    landing, output = scratch_path(spark, "siops"), scratch_path(spark, "siops-out")
    orders = tagged_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("codigo"), F.col("uf").alias("municipio"), F.col("o_orderpriority").alias("fase"), F.col("cents").alias("valor")
    )
    write_csv(orders.where("municipio in ('SP', 'RJ')"), f"{landing}/one")
    write_csv(orders.where("municipio not in ('SP', 'RJ')").select("valor", "fase", "municipio", "codigo"), f"{landing}/two")
    rows, _ = consolidate_folder(spark, landing, drop="municipio")
    back = spark.read.option("header", True).csv(write_csv(rows, output))
    return back.select(
        F.col("codigo").cast("bigint").alias("codigo"), "fase", F.col("valor").cast("bigint").alias("valor")
    )


_SQL_NOTE = "concat(l_returnflag, ', \"', l_linestatus, '\"')"
_SQL_QUOTED = "concat('\"', l_returnflag, ', \"\"', l_linestatus, '\"\"\"')"


@query(f"""WITH lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(l_linenumber AS VARCHAR) AS n, l_linenumber % 7 AS kind, l_linestatus AS m,
                          {_SQL_NOTE} AS note, {_SQL_QUOTED} AS quoted FROM lineitem)
    SELECT 'row' AS outcome, k AS chave, n AS linha, CASE WHEN kind IN (2, 4) THEN m END AS modo, CASE WHEN kind IN (1, 5) THEN note END AS nota,
           NULL::VARCHAR AS texto FROM lines WHERE kind IN (1, 2, 4, 5)
    UNION ALL SELECT 'line', NULL, NULL, NULL, NULL, concat(k, ',', n, ',', quoted, ',extra') FROM lines WHERE kind = 3
    UNION ALL SELECT 'line', NULL, NULL, NULL, NULL, concat(m, ',', k) FROM lines WHERE kind = 6
    UNION ALL SELECT 'header', NULL, NULL, NULL, NULL, 'chave,modo,Chave'""")
def ragged_csv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two headers with quoted separators, lines that are too long or too short, and files whose header has a
    name twice: all good rows are united by name, and all others are set aside with their text."""
    path = scratch_path(spark, "ragged")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("k"), F.col("l_linenumber").cast("string").alias("n"), (F.col("l_linenumber") % 7).alias("kind"),
        F.col("l_linestatus").alias("m"), F.concat(F.lit('"'), "l_returnflag", F.lit(', ""'), "l_linestatus", F.lit('"""')).alias("quoted"),
    )
    noted = F.concat_ws(",", "k", "n", "quoted", F.when(F.col("kind") == 3, "extra"))
    moded = F.concat_ws(",", "m", "k", F.when(F.col("kind") != 6, F.col("n")))
    for name, header, kinds, line in (
        ("a", "chave,linha,nota", (1, 3, 5), noted), ("b", "modo,CHAVE,linha", (2, 4, 6), moded), ("c", "chave,modo,Chave", (0,), moded),
    ):
        write_ragged_lines(lines.where(F.col("kind").isin(*kinds)).select(line), header, f"{path}/{name}", "UTF-8")
    rows, aside = scan_csv_union_with_rejects(spark, path, infer=False)
    is_line = F.startswith("error", F.lit("malformed line: "))
    lost = aside.select(F.when(is_line, "line").otherwise("header").alias("outcome"), F.regexp_replace("error", "^[a-z ]+: ", "").alias("texto"))
    blank = [F.lit(None).cast("string").alias(c) for c in ("chave", "linha", "modo", "nota")]
    # There are as many files with a repeated name as the write had tasks.
    headers = lost.where("outcome = 'header'").distinct().unionByName(lost.where("outcome = 'line'"))
    good = rows.select(F.lit("row").alias("outcome"), "chave", "linha", "modo", "nota", F.lit(None).cast("string").alias("texto"))
    return good.unionByName(headers.select("outcome", *blank, "texto"))


@query("SELECT doc_id, lang, text FROM documents", name="write_csv")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, separators and line breaks inside fields survive."""
    path = write_csv(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), scratch_path(spark, "csv"))
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("lineSep", "\n")
        .schema("doc_id bigint, lang string, text string")
        .csv(path)
    )


@query("""SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cod_municipio, c_name AS nome FROM customer""")
def scan_delimited_bom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 with a byte-order mark in front of the first name; codes keep their zeros."""
    customer = table(spark, sf_dir, "customer")
    line = F.concat_ws(";", F.lpad(F.col("c_custkey").cast("string"), 7, "0"), "c_name")
    path = scratch_path(spark, "bom")
    write_ragged_lines(customer.select(line), "\ufeffcod_municipio;nome", path, "UTF-8")
    return scan_delimited(spark, path, encoding="UTF-8")


# ---- yearly JSON -------------------------------------------------------------

_SQL_PEOPLE = """people AS (
    SELECT year(o_orderdate) AS ano, c_nationkey AS nk, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def _answers(spark: SparkSession, sf_dir: str, labels: dict[str, str]) -> str:
    """One answer per year: labels first, then one element per place.

    Orders are counted per customer and year before they meet the places, and an
    answer has as many elements as there are places.
    """
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("ano")).agg(
        F.count(F.lit(1)).alias("n")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_place = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("ano", "c_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = per_place.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.col("c_nationkey").cast("string")
    # A place without a name lacks the key altogether.
    element = F.when(
        F.col("c_nationkey") == 7,
        F.create_map(F.lit("D1C"), code, F.lit("V"), F.col("n").cast("string")),
    ).otherwise(
        F.create_map(F.lit("D1C"), code, F.lit("D1N"), F.col("n_name"), F.lit("V"), F.col("n").cast("string"))
    )
    header = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    answers = rows.groupBy("ano").agg(
        F.to_json(F.concat(F.array(header), F.collect_list(element))).alias("value")
    )
    path = scratch_path(spark, "answers")
    answers.write.partitionBy("ano").text(path)
    return path


_FOLDER_YEAR = r"ano=([0-9]{4})/"


@query(f"""WITH {_SQL_PEOPLE}
    SELECT CAST(nk AS VARCHAR) AS COD_MUNICIPIO, CASE WHEN nk <> 7 THEN n_name END AS NOME_MUNICIPIO,
           CAST(ano AS INTEGER) AS ANO, CAST(n AS VARCHAR) AS POPULACAO_ESTIMADA
    FROM people JOIN nation ON n_nationkey = nk""")
def population_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _answers(spark, sf_dir, {"D1C": "Município (Código)", "D1N": "Município", "V": "Valor"})
    return picked_rows(scan_answers(spark, path, _FOLDER_YEAR), POPULATION_COLUMNS)


@query(f"""WITH {_SQL_PEOPLE}
    SELECT CAST(nk AS VARCHAR) AS MUNICIPIO_CODIGO, CASE WHEN nk <> 7 THEN n_name END AS REGIAO_DE_SAUDE,
           CAST(n AS VARCHAR) AS PRODUTO_INTERNO_BRUTO_MIL_R, CAST(ano AS INTEGER) AS ANO
    FROM people JOIN nation ON n_nationkey = nk""", name="header_first_json")
def columns_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names come from the labels in the first element."""
    labels = {"D1C": "Município (Código)", "D1N": "Região de Saúde", "V": "Produto Interno Bruto [Mil R$]"}
    return scan_header_first_json(spark, _answers(spark, sf_dir, labels), year_pattern=_FOLDER_YEAR)


# ---- dBASE, raw text, Parquet ------------------------------------------------

_FIELDS = [
    ("CHAVE", "N", 12), ("CLIENTE", "N", 10), ("VALOR", "N", 14), ("SITUACAO", "C", 1),
    ("URG", "C", 16), ("DATA", "D", 8), ("PRIMEIRO", "L", 1),
]


def _dbf_folder(spark: SparkSession, sf_dir: str) -> str:
    orders = tagged_orders(spark, sf_dir)
    first = F.substring("o_orderpriority", 1, 1)
    rows = orders.select(
        F.when(F.col("o_orderstatus") == "P", "*").otherwise(" ").alias("flag"),
        F.col("o_orderkey").cast("string").alias("CHAVE"),
        F.when(first != "2", F.col("o_custkey").cast("string")).alias("CLIENTE"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("VALOR"),
        F.col("o_orderstatus").alias("SITUACAO"),
        F.concat(F.lit("É "), F.substring("o_orderpriority", 3, 14)).alias("URG"),
        F.when(first == "3", F.lit("00000000")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("DATA"),
        F.when(first == "1", "T").when(first == "4", "?").otherwise("n").alias("PRIMEIRO"),
        F.regexp_replace("file", r"\.dbc$", ".dbf").alias("file"),
    )
    path = scratch_path(spark, "dbf")
    # One era has a column less and writes a name in small letters.
    old = [(name.lower() if name == "VALOR" else name, *more) for name, *more in _FIELDS if name != "CLIENTE"]
    write_dbf(rows.where("DATA < '19980101' and DATA <> '00000000'"), old, f"{path}/old")
    write_dbf(rows.where("DATA >= '19980101' or DATA = '00000000'"), _FIELDS, f"{path}/new")
    return path


@query("""WITH o AS (SELECT *, substr(o_orderpriority, 1, 1) AS k FROM orders WHERE o_orderstatus <> 'P')
    SELECT CAST(o_orderkey AS VARCHAR) AS CHAVE,
           CASE WHEN k <> '2' AND (year(o_orderdate) >= 1998 OR k = '3') THEN CAST(o_custkey AS VARCHAR) END AS CLIENTE,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS VALOR, o_orderstatus AS SITUACAO,
           concat('É ', substr(o_orderpriority, 3, 14)) AS URG,
           CASE WHEN k <> '3' THEN strftime(o_orderdate, '%Y-%m-%d') END AS DATA,
           CASE k WHEN '1' THEN 'True' WHEN '4' THEN NULL ELSE 'False' END AS PRIMEIRO, true AS tagged
    FROM o""", name="scan_dbf")
def dbf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two eras of dBASE files with deleted records, and with a name in other letters, read in small record ranges."""
    files = scan_file_inventory(spark, _dbf_folder(spark, sf_dir), glob="*.dbf")
    rows = scan_dbf(files, range_records=20_000).rows
    return rows.withColumn("tagged", F.col(LINEAGE).isNotNull()).drop(LINEAGE)


_SQL_DBF = ORACLES["scan_dbf"]


@query(_SQL_DBF, name="scan_dbf_format")
def dbf_as_a_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two eras through `spark.read.format("dbf")`, whose tasks read the headers of their own files."""
    rows = read_dbf(spark, _dbf_folder(spark, sf_dir), task_bytes=str(1 << 20))
    return rows.withColumn("tagged", F.col(LINEAGE).isNotNull()).drop(LINEAGE)


@query(f"""WITH {SQL_TAGGED}
    SELECT period AS competencia, upper(replace(file, '.dbc', '.dbf')) AS _ARQUIVO_ORIGEM, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2))::VARCHAR AS valor
    FROM tagged WHERE period BETWEEN '199706' AND '199803' AND uf IN ('SP', 'BA') GROUP BY 1, 2""")
def dbf_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of the dBASE files of some months and states; no other file is opened."""
    path = scratch_path(spark, "dbf-months")
    write_dbf(_dbf_orders(spark, sf_dir), _PRICE_FIELDS, path)
    headers = read_headers(scan_file_inventory(spark, path, glob="*.dbf"))
    rows = read_dbf(spark, path, dbf_schema(headers, ["VALOR"], months=True), period="^PA[A-Z]{2}([0-9]{2})([0-9]{2})")
    asked = rows.where(f"competencia between '199706' and '199803' and (startswith({LINEAGE}, 'PASP') or startswith({LINEAGE}, 'PABA'))")
    total = F.sum(F.col("VALOR").cast("decimal(18,2)")).cast("decimal(18,2)").cast("string")
    return asked.groupBy("competencia", LINEAGE).agg(F.count(F.lit(1)).alias("n"), total.alias("valor"))


@query(f"""WITH {SQL_TAGGED}
    SELECT CASE WHEN uf = 'RS' THEN 'rejected' ELSE 'accepted' END AS outcome, count(DISTINCT file) AS files,
           CAST(sum(CASE WHEN uf = 'RS' THEN 0 ELSE 1 END) AS BIGINT) AS records
    FROM tagged GROUP BY 1""")
def quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that end before their last record are set aside with their error."""
    orders = _dbf_orders(spark, sf_dir)
    path = scratch_path(spark, "dbf-bad")
    write_dbf(orders.where("uf = 'RS'"), _PRICE_FIELDS, f"{path}/bad", claim=1)
    write_dbf(orders.where("uf <> 'RS'"), _PRICE_FIELDS, f"{path}/good")
    scan = scan_dbf(scan_file_inventory(spark, path, glob="*.dbf"))
    kept = scan.accepted.select(F.lit("accepted").alias("outcome"), "records")
    bad = scan.rejected.where("error is not null").select(F.lit("rejected").alias("outcome"), F.lit(0).alias("records"))
    return kept.unionByName(bad).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("files"), F.sum("records").cast("bigint").alias("records")
    )


_PRICE_FIELDS = [("CHAVE", "N", 12), ("VALOR", "N", 14), ("SITUACAO", "C", 1)]


def _dbf_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_orders(spark, sf_dir).select(
        F.lit(" ").alias("flag"),
        F.col("o_orderkey").cast("string").alias("CHAVE"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("VALOR"),
        F.col("o_orderstatus").alias("SITUACAO"),
        F.regexp_replace("file", r"\.dbc$", ".dbf").alias("file"),
        "uf",
        "period",
    )


_SQL_TWO_DELIVERIES = f"""WITH {SQL_TAGGED}
    SELECT CAST(o_orderkey AS VARCHAR) AS CHAVE,
           CAST(CAST(CASE WHEN uf = 'MG' AND substr(period, 1, 4) = '2000' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1
                     ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS VARCHAR) AS VALOR,
           o_orderstatus AS SITUACAO, upper(file) AS _ARQUIVO_ORIGEM, period AS competencia
    FROM tagged"""


def _two_deliveries(spark: SparkSession, sf_dir: str, take) -> None:
    """First all states but one; then that state, and a year of another state
    again with other prices in wider records."""
    orders = _dbf_orders(spark, sf_dir)
    again = "uf = 'MG' and substring(period, 1, 4) = '2000'"
    first, second = scratch_path(spark, "delivery-1"), scratch_path(spark, "delivery-2")
    write_dbf(orders.where("uf <> 'SP'"), _PRICE_FIELDS, first)
    take(first)
    # A month is rebuilt from all its files, so the unchanged ones are there too.
    write_dbf(orders.where(f"not ({again})"), _PRICE_FIELDS, second)
    dearer = (F.col("VALOR").cast("decimal(18,2)") + 1).cast("decimal(18,2)").cast("string")
    wider = [(name, kind, width + 2) for name, kind, width in _PRICE_FIELDS]
    write_dbf(orders.where(again).withColumn("VALOR", dearer), wider, second)
    take(second)


@query(_SQL_TWO_DELIVERIES)
def ingest_months_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the monthly source, rebuilt month by month from its ledger."""
    lake = scratch_path(spark, "lake")
    rule = registry.get_source("sia_pa").rule
    _two_deliveries(spark, sf_dir, lambda landing: ingest_months(spark, landing, lake, "pa", rule))
    return read_months(spark, f"{lake}/pa/pa")


@query(_SQL_TWO_DELIVERIES)
def ingest_merge_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries merged file by file; unchanged files are not read again."""
    lake = scratch_path(spark, "lake")
    rule = registry.get_source("sia_pa").rule
    _two_deliveries(spark, sf_dir, lambda landing: ingest_merge(spark, landing, lake, "sia", "pa", rule))
    return read_months(spark, f"{lake}/sia/pa")


# ---- deliveries with broken files ----------------------------------------------

_BROKEN = "uf = 'SP' and substring(period, 1, 4) = '2000'"
_SQL_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
# All but the broken files are dearer in the second delivery.
_SQL_BROKEN = f"""CAST(o_orderkey AS VARCHAR) AS CHAVE,
           CAST(CAST(CASE WHEN uf = 'SP' AND substr(period, 1, 4) = '2000' THEN {_SQL_PRICE} ELSE {_SQL_PRICE} + 1 END
                     AS DECIMAL(18,2)) AS VARCHAR) AS VALOR,
           o_orderstatus AS SITUACAO, upper(file) AS _ARQUIVO_ORIGEM"""


def _dearer(orders: DataFrame) -> DataFrame:
    return orders.withColumn("VALOR", (F.col("VALOR").cast("decimal(18,2)") + 1).cast("decimal(18,2)").cast("string"))


def _broken_delivery(spark: SparkSession, sf_dir: str, take) -> None:
    """All files; then all again, dearer and wider, but for those of one state and year, which are broken."""
    orders = _dbf_orders(spark, sf_dir)
    first, second = scratch_path(spark, "whole"), scratch_path(spark, "broken")
    write_dbf(orders, _PRICE_FIELDS, first)
    take(first)
    wider = [(name, kind, width + 2) for name, kind, width in _PRICE_FIELDS]
    write_dbf(_dearer(orders.where(f"not ({_BROKEN})")), wider, second)
    write_dbf(_dearer(orders.where(_BROKEN)), wider, second, claim=3)
    take(second)


@query(f"""WITH {SQL_TAGGED} SELECT {_SQL_BROKEN}, period AS competencia FROM tagged""")
def months_with_broken_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months are rebuilt from the files that can be read; a broken file keeps its earlier rows."""
    lake, rule = scratch_path(spark, "lake"), registry.get_source("sia_pa").rule
    _broken_delivery(spark, sf_dir, lambda landing: ingest_months(spark, landing, lake, "pa", rule))
    return read_months(spark, f"{lake}/pa/pa")


@query(f"""WITH {SQL_TAGGED} SELECT {_SQL_BROKEN.replace("'2000'", "'2001'")} FROM tagged
    WHERE period = (SELECT max(period) FROM tagged)""")
def snapshot_with_broken_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot keeps the state whose revised file is broken."""
    lake, rule = scratch_path(spark, "lake"), registry.get_source("sia_pa").rule
    orders = _dbf_orders(spark, sf_dir).where("period >= '200101'")
    first, second = scratch_path(spark, "whole"), scratch_path(spark, "broken")
    write_dbf(orders, _PRICE_FIELDS, first)
    ingest_snapshot(spark, first, lake, "cnes", "pa", rule)
    wider = [(name, kind, width + 2) for name, kind, width in _PRICE_FIELDS]
    write_dbf(_dearer(orders.where("uf <> 'SP'")), wider, second)
    write_dbf(_dearer(orders.where("uf = 'SP'")), wider, second, claim=3)
    ingest_snapshot(spark, second, lake, "cnes", "pa", rule)
    return read_published(spark, f"{lake}/cnes/pa")


@query(f"""WITH {_SQL_PEOPLE}
    SELECT CAST(nk AS VARCHAR) AS COD_MUNICIPIO, CASE WHEN nk <> 7 THEN n_name END AS NOME_MUNICIPIO,
           CAST(ano AS INTEGER) AS ANO, CAST(CASE WHEN ano = 1998 THEN n ELSE n * 2 END AS VARCHAR) AS POPULACAO_ESTIMADA
    FROM people JOIN nation ON n_nationkey = nk""")
def years_with_broken_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the years that come again one is an error page: it keeps its earlier rows."""
    lake = scratch_path(spark, "lake")
    labels = {"D1C": "Município (Código)", "D1N": "Município", "V": "Valor"}
    answers = spark.read.text(_answers(spark, sf_dir, labels), wholetext=True)
    doubled = F.transform(
        F.from_json("value", "array<map<string,string>>"),
        lambda row, i: F.when(i == 0, row).otherwise(
            F.transform_values(row, lambda k, v: F.when(k == "V", (v.cast("bigint") * 2).cast("string")).otherwise(v))
        ),
    )
    page = F.when(F.col("ano") == 1998, F.lit("<html>Service unavailable</html>")).otherwise(F.to_json(doubled))
    for delivery in (answers, answers.withColumn("value", page)):
        landing = scratch_path(spark, "answers")
        # The year stands in the folder's name here, and ends the path as the file's name does elsewhere.
        delivery.select("value", F.concat(F.col("ano").cast("string"), F.lit(".json")).alias("nome")).write.partitionBy("nome").text(landing)
        ingest_years(spark, landing, lake, "ibge", "populacao_estimada", "*.txt", _NAMED_YEAR)
    return read_published(spark, f"{lake}/ibge/populacao_estimada")


_NAMED_YEAR = r"nome=([0-9]{4})\.json/"


@query(f"""WITH {SQL_TAGGED}
    SELECT CASE WHEN uf IN ('SP', 'RJ') THEN 'rejected' ELSE period END AS competencia, count(*) AS n FROM tagged GROUP BY 1""")
def rows_without_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is no month are set aside and counted, not lost."""
    orders = tagged_orders(spark, sf_dir)
    bad = F.when(F.col("uf") == "SP", F.concat(F.substring("period", 1, 4), F.lit("-"), F.substring("period", 5, 2)))
    key = F.when(F.col("uf").isin("SP", "RJ"), bad).otherwise(F.col("period"))
    target = scratch_path(spark, "no-period")
    merge_partitions(orders.select("o_orderkey", F.col("file").alias(LINEAGE), key.alias("competencia")), target)
    kept = read_months(spark, target).select("competencia")
    aside = read_rejects(spark, target).select(F.lit("rejected").alias("competencia"))
    return kept.unionByName(aside).groupBy("competencia").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {SQL_TAGGED}
    SELECT CAST(o_orderkey AS VARCHAR) AS CHAVE,
           CAST(CASE WHEN uf = 'BA' THEN 'X' ELSE o_orderstatus END AS VARCHAR) AS SITUACAO, upper(file) AS _ARQUIVO_ORIGEM
    FROM tagged""")
def same_size_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one state come again in the same size with another content."""
    lake, rule = scratch_path(spark, "lake"), registry.get_source("sia_pa").rule
    orders = _dbf_orders(spark, sf_dir)
    first, second = scratch_path(spark, "size-1"), scratch_path(spark, "size-2")
    write_dbf(orders, _PRICE_FIELDS, first)
    again = F.when(F.col("uf") == "BA", "X").otherwise(F.col("SITUACAO"))
    write_dbf(orders.withColumn("SITUACAO", again), _PRICE_FIELDS, second)
    for landing in (first, second):
        ingest_merge(spark, landing, lake, "sia", "pa", rule, by_content=True)
    return read_months(spark, f"{lake}/sia/pa").select("CHAVE", "SITUACAO", LINEAGE)


@query("""SELECT CAST(doc_id AS VARCHAR) AS codigo, lang AS idioma, source AS origem FROM documents""")
def two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with their columns in another order: each is read by its own header."""
    path = scratch_path(spark, "headers")
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("codigo"), "lang", "source")
    even = (F.col("codigo").cast("bigint") % 2) == 0
    write_ragged_lines(documents.where(even).select(F.concat_ws(";", "codigo", "lang", "source")), "codigo;idioma;origem", f"{path}/a", "ISO-8859-1")
    write_ragged_lines(documents.where(~even).select(F.concat_ws(";", "source", "codigo", "lang")), "origem;codigo;idioma", f"{path}/b", "ISO-8859-1")
    return scan_delimited(spark, path)


@query("""SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'rejected' ELSE 'read' END AS outcome, count(*) AS n
    FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1""")
def quarantine_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too many are set aside with their error, and so is a file in another encoding."""
    path = scratch_path(spark, "csv-bad")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    line = F.concat_ws(";", "c_custkey", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("x;y")).otherwise(F.lit("x")))
    write_ragged_lines(customer.where("c_mktsegment <> 'MACHINERY'").select(line), "codigo;nome", f"{path}/good", "UTF-8")
    write_ragged_lines(customer.where("c_mktsegment = 'MACHINERY'").select(line), "c\xf3digo;nome", f"{path}/bad", "ISO-8859-1")
    rows, aside = scan_delimited_files(spark, scan_file_inventory(spark, path), encoding="UTF-8")
    lines = aside.where(F.startswith("error", F.lit("malformed line"))).select(F.lit("rejected").alias("outcome"))
    every = rows.select(F.lit("read").alias("outcome")).unionByName(lines)
    return every.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS chave, CAST(o_custkey AS VARCHAR) AS cliente, o_orderstatus AS situacao,
        strftime(o_orderdate, '%Y%m%d') AS data FROM orders""")
def raw_text_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-position lines, published as they are and cut by a layout."""
    orders = table(spark, sf_dir, "orders")
    line = F.concat(
        F.lpad(F.col("o_orderkey").cast("string"), 12, " "),
        F.lpad(F.col("o_custkey").cast("string"), 10, " "),
        F.col("o_orderstatus"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.lit("  "),
    )
    path = publish_text(orders.select(line.alias("value")), scratch_path(spark, "microdata"))
    layout = [("chave", 1, 12), ("cliente", 13, 10), ("situacao", 23, 1), ("data", 24, 8)]
    cut = apply_layout(scan_raw_text(spark, path), layout)
    return cut.select(*[F.trim(c).alias(c) for c in cut.columns])


@query("""SELECT unnest([1, 2, 3]) AS delivery, unnest([true, false, true]) AS changed,
        unnest([(SELECT count(*) FROM orders), (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0)]) AS lines""")
def raw_text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text is published when its size changed, not when it comes again as it was."""
    lake = scratch_path(spark, "lake")
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"), "o_orderkey")
    whole = publish_text(lines, scratch_path(spark, "text"))
    fewer = publish_text(lines.where("o_orderkey % 3 <> 0"), scratch_path(spark, "text"))
    rows = []
    for number, landing in enumerate((whole, whole, fewer), 1):
        outcome = ingest_text(spark, landing, lake, "ibge", "microdados.txt")
        published = scan_raw_text(spark, latest_version(spark, outcome.target))
        counted = published.agg(F.count(F.lit(1)).alias("lines"))
        rows.append(counted.select(F.lit(number).alias("delivery"), F.lit(outcome.changed).alias("changed"), "lines"))
    return reduce(DataFrame.unionByName, rows)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS chave, o_orderstatus AS situacao, NULL::VARCHAR AS linha FROM orders
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), NULL, CAST(l_linenumber AS VARCHAR) FROM lineitem""")
def scan_parquet_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with other columns in another order, united by name."""
    path = scratch_path(spark, "parts")
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    orders.selectExpr("cast(o_orderkey as string) chave", "o_orderstatus situacao").write.parquet(f"{path}/a")
    lines.selectExpr("cast(l_linenumber as string) linha", "cast(l_orderkey as string) chave").write.parquet(f"{path}/b")
    return read_parts(spark, [f"{path}/a", f"{path}/b"])


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS chave, CAST(l_linenumber AS VARCHAR) AS linha,
        CASE WHEN year(l_shipdate) < 1998 THEN l_returnflag END AS retorno,
        CASE WHEN year(l_shipdate) >= 1998 THEN l_linestatus END AS situacao,
        strftime(l_shipdate, '%Y%m') AS competencia
    FROM lineitem WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199707' AND '199806'""", name="scan_month_range")
def months_of_two_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window over months whose columns differ between two eras."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("chave"),
        F.col("l_linenumber").cast("string").alias("linha"),
        "l_returnflag",
        "l_linestatus",
        month_key_of("l_shipdate").alias("competencia"),
    )
    target = scratch_path(spark, "eras")
    old = lines.where("competencia < '199801'").withColumnRenamed("l_returnflag", "retorno").drop("l_linestatus")
    new = lines.where("competencia >= '199801'").withColumnRenamed("l_linestatus", "situacao").drop("l_returnflag")
    write_months(old, target)
    write_months(new, target)
    rows = scan_month_range(spark, target, start="199707", end="199806")
    return rows.select("chave", "linha", "retorno", "situacao", "competencia")


def _line_months(spark: SparkSession, sf_dir: str) -> str:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", month_key_of("l_shipdate").alias("competencia"))
    target = scratch_path(spark, "line-months")
    write_months(lines, target)
    return target


def _busy_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with their orders: those that have more urgent ones than the month's number in the year."""
    urgent = F.count(F.when(F.startswith("o_orderpriority", F.lit("1")), 1))
    by_month = table(spark, sf_dir, "orders").groupBy(month_key_of("o_orderdate").alias("competencia"))
    months = by_month.agg(F.count(F.lit(1)).alias("n_orders"), urgent.alias("urgent"))
    return months.where("urgent > cast(substring(competencia, 5, 2) as int)").select("competencia", "n_orders")


_SQL_BUSY = """busy AS (
    SELECT strftime(o_orderdate, '%Y%m') AS competencia, count(*) AS n_orders FROM orders GROUP BY 1
    HAVING count(*) FILTER (starts_with(o_orderpriority, '1')) > CAST(substr(strftime(max(o_orderdate), '%Y%m'), 5, 2) AS INTEGER))"""


@query(f"""WITH {_SQL_BUSY}
    SELECT b.competencia, n_orders, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem JOIN busy b ON strftime(l_shipdate, '%Y%m') = b.competencia GROUP BY 1, 2""")
def months_of_a_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the months that another table gives; only these folders are opened."""
    rows = scan_calendar(spark, _line_months(spark, sf_dir), _busy_months(spark, sf_dir))
    return rows.groupBy("competencia", "n_orders").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query("""SELECT strftime(l_shipdate, '%Y%m') AS competencia, count(*) AS n_lines FROM lineitem
    WHERE strftime(l_shipdate, '%Y%m') BETWEEN '199611' AND '199702' OR strftime(l_shipdate, '%Y%m') LIKE '%12' GROUP BY 1""")
def months_by_a_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain filter on the month of the whole table."""
    rows = scan_months(spark, _line_months(spark, sf_dir))
    asked = F.col("competencia").between("199611", "199702") | F.endswith("competencia", F.lit("12"))
    return rows.where(asked).groupBy("competencia").agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"""WITH {SQL_TAGGED}
    SELECT o_orderkey, cents + 1 AS cents FROM tagged""")
def publish_over_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is read, changed and replaced; readers take the last whole version."""
    path = scratch_path(spark, "published")
    publish_table(tagged_orders(spark, sf_dir).select("o_orderkey", "cents"), path)
    publish_table(read_published(spark, path).withColumn("cents", F.col("cents") + 1), path)
    return read_published(spark, path)


@query("""SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, (SELECT count(*) FROM orders) AS written
    FROM orders GROUP BY o_orderstatus""")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while they are written, beside counts of what was written."""
    path = scratch_path(spark, "counted")
    written = publish_counted(table(spark, sf_dir, "orders"), path)
    counts = read_published(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("written", F.lit(written).cast("bigint"))


@query(f"""WITH {SQL_TAGGED}
    SELECT CAST(uf AS VARCHAR) AS uf, count(*) AS n, true AS one_file_name FROM tagged GROUP BY uf""")
def tag_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row carries the name of the file it was read from."""
    path = scratch_path(spark, "lineage")
    tagged_orders(spark, sf_dir).select("o_orderkey", "uf").write.partitionBy("uf").parquet(path)
    rows = tag_file(spark.read.parquet(path))
    is_file = F.col(LINEAGE).rlike(r"^part-.*\.parquet$")
    return rows.groupBy(F.col("uf").cast("string").alias("uf")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(is_file).alias("one_file_name")
    )


# ---- stream ------------------------------------------------------------------


@query("""SELECT event_id, strftime(ts, '%Y%m%d') AS competencia, user_id FROM events""",
       name="stream_append_new_files")
def events_as_they_arrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files of two folders with the same names, taken in several micro-batches, each replacing the days it touches."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "arrived")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    folder = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    events.withColumn("pasta", folder).write.partitionBy("pasta").parquet(landing)
    stream_append_new_files(
        spark,
        landing,
        events.schema,
        target,
        scratch_path(spark, "stream-state"),
        period=lambda df: df.withColumn("competencia", F.date_format("ts", "yyyyMMdd")),
        max_files=2,
    )
    return read_months(spark, target).select("event_id", "competencia", "user_id")


def _published_name(path: str) -> Column:
    return F.regexp_replace(F.upper(file_name(path)), r"\.DBF$", ".DBC")


@query(_SQL_TWO_DELIVERIES, name="stream_revised_files")
def files_written_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder of dBASE files taken as a stream: new files come, and others are written again in place, in the same
    size and with other prices."""
    landing, target, state = (scratch_path(spark, name) for name in ("revised", "revised-lake", "revised-state"))
    rules = rule_table(spark, [registry.get_source("sia_pa").rule])

    def read(files: DataFrame) -> DataFrame:
        known = classify_names(files, rules, name=LINEAGE).withColumn("competencia", F.col("period"))
        return scan_dbf(known, carry=(LINEAGE, "competencia"), order_by="competencia").rows

    def arrive() -> None:
        stream_revised_files(spark, landing, target, state, read, suffix=".dbf", lineage=_published_name)

    orders = _dbf_orders(spark, sf_dir)
    again = "uf = 'MG' and substring(period, 1, 4) = '2000'"
    write_dbf(orders.where("uf <> 'SP'"), _PRICE_FIELDS, landing)
    arrive()
    arrive()  # nothing new
    write_dbf(orders.where("uf = 'SP'"), _PRICE_FIELDS, landing)
    write_dbf(_dearer(orders.where(again)), _PRICE_FIELDS, landing)
    arrive()
    return read_months(spark, target)
