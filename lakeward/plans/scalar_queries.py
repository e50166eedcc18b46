"""Names, labels, typed fields, sets and conforming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions import fields, report, text
from lakeward.functions.periods import full_year, month_key_of, month_label, pivot_year, year_span
from lakeward.operators.conform import align_to, clean_column_names, conform, exclude_columns, union_by_name
from lakeward.operators.ledger import dedup_case_insensitive
from lakeward.operators.names import (
    classify_names,
    matches_name,
    missing_names,
    route_by_prefix,
    rule_table,
    select_named,
    unclassified,
    valid_state,
    year_bounds,
)
from lakeward.plans import registry
from lakeward.plans.catalog import query
from lakeward.plans.deliveries import SQL_STATE, SQL_TAGGED, state, table, tagged_orders

# ---- file names --------------------------------------------------------------

# Names with a colliding pair of prefixes, part letters and off-pattern endings.
_SQL_NAMES = f"""{SQL_TAGGED},
names AS (SELECT DISTINCT concat(
    CASE o_orderstatus WHEN 'F' THEN 'AB' WHEN 'O' THEN 'ABO' ELSE 'pa' END, uf, substr(period, 3, 4),
    CASE WHEN uf = 'MG' THEN 'a' WHEN uf = 'RS' THEN '_x' ELSE '' END, '.dbc') AS name FROM tagged)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tagged_orders(spark, sf_dir)
    status = F.col("o_orderstatus")
    prefix = F.when(status == "F", "AB").when(status == "O", "ABO").otherwise("pa")
    part = F.when(F.col("uf") == "MG", "a").when(F.col("uf") == "RS", "_x").otherwise("")
    name = F.concat(prefix, "uf", F.substring("period", 3, 4), part, F.lit(".dbc"))
    return orders.select(name.alias("name")).distinct()


@query(f"""WITH {_SQL_NAMES},
    read AS (SELECT name, regexp_extract(upper(name), '^(ABO|AB|PA)([A-Z]{{2}})([0-9]{{4}})[A-Z]?\\.DBC$', 1) AS prefix,
                    regexp_extract(upper(name), '^(ABO|AB|PA)([A-Z]{{2}})([0-9]{{4}})[A-Z]?\\.DBC$', 2) AS place,
                    regexp_extract(upper(name), '^(ABO|AB|PA)([A-Z]{{2}})([0-9]{{4}})[A-Z]?\\.DBC$', 3) AS aamm
             FROM names),
    hits AS (SELECT name, CASE prefix WHEN 'AB' THEN 'sia_ab' WHEN 'ABO' THEN 'sia_abo' ELSE 'sia_pa' END AS source,
                    place, CAST(substr(aamm, 1, 2) AS INTEGER) AS aa, substr(aamm, 3, 2) AS mm
             FROM read WHERE prefix <> '')
    SELECT name, source, place,
           CAST(CASE WHEN aa >= CASE source WHEN 'sia_pa' THEN 94 ELSE 90 END THEN 1900 + aa ELSE 2000 + aa END AS INTEGER) AS year,
           concat(CASE WHEN aa >= CASE source WHEN 'sia_pa' THEN 94 ELSE 90 END THEN 1900 + aa ELSE 2000 + aa END, mm) AS period
    FROM hits""")
def match_name_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_names(_names(spark, sf_dir), rule_table(spark, registry.name_rules()))


@query(f"""WITH {_SQL_NAMES}
    SELECT name FROM names WHERE NOT regexp_matches(upper(name), '^(ABO|AB|PA)[A-Z]{{2}}[0-9]{{4}}[A-Z]?\\.DBC$')""")
def unmatched_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _names(spark, sf_dir)
    return unclassified(names, classify_names(names, rule_table(spark, registry.name_rules())))


@query(f"""WITH {_SQL_NAMES}
    SELECT name, regexp_matches(upper(name), '^AB[A-Z]{{2}}[0-9]{{4}}[A-Z]?\\.DBC$') AS is_ab,
           upper(name) LIKE 'AB%' AS starts_ab FROM names""")
def char_class_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select(
        "name",
        matches_name("name", "AB", "uf", "month").alias("is_ab"),
        text.starts_with_any(F.upper("name"), ["AB"]).alias("starts_ab"),
    )


# Two-digit years of the deaths from 1979 on, in four kinds of files; the maternal ones begin in 1996.
_SQL_ERAS = """WITH parts AS (SELECT DISTINCT (o_orderkey * 7 + year(o_orderdate)) % 42 + 1979 AS ano FROM orders),
    kinds AS (SELECT unnest(['DOEXT', 'DOFET', 'DOINF', 'DOMAT']) AS kind),
    names AS (SELECT concat(kind, lpad(CAST(ano % 100 AS VARCHAR), 2, '0'), '.DBC') AS name, kind, ano
              FROM parts CROSS JOIN kinds WHERE kind <> 'DOMAT' OR ano >= 1996)"""


@query(f"""{_SQL_ERAS}
    SELECT name, CASE kind WHEN 'DOMAT' THEN 'sim_domat' ELSE
             concat('sim_', CASE kind WHEN 'DOEXT' THEN 'causas_externas' WHEN 'DOFET' THEN 'dofet' ELSE 'doinf' END,
                    CASE WHEN ano <= 1995 THEN '_cid9' ELSE '_cid10' END) END AS source,
           CAST(ano AS INTEGER) AS year FROM names""",
       name="year_bounds")
def eras_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each name belongs to one era; maternal files of earlier years to none."""
    orders = table(spark, sf_dir, "orders")
    year = (F.col("o_orderkey") * 7 + F.year("o_orderdate")) % 42 + 1979
    kinds = F.explode(F.array(*map(F.lit, ("DOEXT", "DOFET", "DOINF", "DOMAT"))))
    years = orders.select(year.alias("ano")).distinct().select("ano", kinds.alias("kind"))
    name = F.concat("kind", F.lpad((F.col("ano") % 100).cast("string"), 2, "0"), F.lit(".DBC"))
    rules = rule_table(spark, registry.name_rules())
    return classify_names(years.select(name.alias("name")), rules).select("name", "source", "year")


@query("""WITH y AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%y') AS INTEGER) AS aa FROM orders),
    f AS (SELECT o_orderkey, CASE WHEN aa >= 96 THEN 1900 + aa ELSE 2000 + aa END AS p96, 1900 + aa AS p19 FROM y)
    SELECT o_orderkey, CAST(p96 AS INTEGER) AS pivoted, CAST(p19 AS INTEGER) AS always_19,
           p96 BETWEEN 1997 AND 2000 AS closed, p96 >= 1999 AS open_above FROM f""")
def pivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yy").alias("aa"))
    year = pivot_year("aa", 96)
    return orders.select(
        "o_orderkey",
        year.alias("pivoted"),
        full_year("aa", None).alias("always_19"),
        year_bounds(year, 1997, 2000).alias("closed"),
        year_bounds(year, 1999, None).alias("open_above"),
    )


@query(f"""WITH places AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'BR' WHEN o_orderstatus = 'O' AND {SQL_STATE} = 'RS' THEN 'EX'
                                ELSE {SQL_STATE} END AS uf, year(o_orderdate) AS ano FROM orders)
    SELECT uf AS place, CAST(ano AS INTEGER) AS year, count(*) AS births FROM places
    WHERE uf NOT IN ('BR', 'EX') GROUP BY 1, 2""")
def valid_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Births by state; the national roll-up would count them twice."""
    status = F.col("o_orderstatus")
    place = F.when(status == "F", "BR").when((status == "O") & (state() == "RS"), "EX").otherwise(state())
    births = table(spark, sf_dir, "orders").select(place.alias("place"), F.year("o_orderdate").alias("year"))
    return births.where(valid_state("place")).groupBy("place", "year").agg(F.count(F.lit(1)).alias("births"))


@query("""WITH n AS (SELECT DISTINCT p_name FROM part),
    copies AS (SELECT p_name AS name FROM n UNION ALL SELECT upper(p_name) FROM n
               UNION ALL SELECT concat(upper(substr(p_name, 1, 1)), substr(p_name, 2)) FROM part)
    SELECT name FROM (SELECT name, row_number() OVER (PARTITION BY upper(name) ORDER BY name) AS r FROM copies)
    WHERE r = 1""",
       name="dedup_case_insensitive")
def one_name_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    plain = parts.select(F.col("p_name").alias("name"))
    capital = F.concat(F.upper(F.substring("name", 1, 1)), F.expr("substring(name, 2)"))
    copies = plain.union(plain.select(F.upper("name"))).union(plain.select(capital))
    return dedup_case_insensitive(copies, "name")


@query("""SELECT n_name, n_regionkey FROM nation WHERE n_name IN ('NATION_3', 'NATION_17', 'NATION_24')""",
       name="select_named")
def chosen_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    return select_named(nation, "n_name", ["NATION_3", "NATION_17", "NATION_24", "NATION_99"])


@query("""SELECT x.p_name FROM (VALUES ('small ring'), ('no such part'), ('red widget'), ('hot air')) x(p_name)
    WHERE x.p_name NOT IN (SELECT p_name FROM part)""", name="missing_names")
def names_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["small ring", "no such part", "red widget", "hot air"]
    return missing_names(table(spark, sf_dir, "part"), "p_name", wanted)


@query("""SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN 'monthly' ELSE 'main' END AS dataset FROM documents""",
       name="route_by_prefix")
def datasets_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly, main = route_by_prefix(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "src1")
    return monthly.select("doc_id", F.lit("monthly").alias("dataset")).unionByName(
        main.select("doc_id", F.lit("main").alias("dataset"))
    )


@query("""SELECT page_id, split_part(url, '/', -1) AS file_name, split_part(url, '/', 1) AS top,
        coalesce(nullif(regexp_extract(url, '([0-9]+)\\?', 1), ''), url) AS digits
    FROM pages""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        text.file_name("url").alias("file_name"),
        text.top_folder("url").alias("top"),
        F.coalesce(text.regex_group("url", r"([0-9]+)\?"), F.col("url")).alias("digits"),
    )


@query(f"""WITH {_SQL_NAMES}
    SELECT name, coalesce(nullif(regexp_extract(name, '([0-9]+)\\.\\w+$', 1), ''), name) AS period_key FROM names""")
def period_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("name", text.period_digits("name").alias("period_key"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period, strftime(o_orderdate, '%m/%Y') AS label,
        concat(year(o_orderdate), '-', '2001') AS span FROM orders""")
def format_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tagged_orders(spark, sf_dir)
    return orders.select(
        "o_orderkey", "period", month_label("period").alias("label"), year_span("period", F.lit("200112")).alias("span")
    )


# ---- cells -------------------------------------------------------------------

_SQL_BLANKS = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN chr(9) || ' ' WHEN '2' THEN 'None'
    WHEN '3' THEN ' nan' || chr(160) WHEN '4' THEN 'NaT' ELSE '  keep ' || o_orderkey || ' ' END"""


@query(f"""WITH raw AS (SELECT o_orderkey, {_SQL_BLANKS} AS note,
        CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           CASE WHEN regexp_replace(note, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g') NOT IN ('', 'None', 'nan', 'NaT') THEN note END AS note,
           nullif(status, '') AS status,
           concat('ORD', CASE WHEN o_orderkey IS NULL THEN '' ELSE '' END) AS _ARQUIVO_ORIGEM
    FROM raw""")
def conform_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    note = (
        F.when(digit == "1", F.lit("\t "))
        .when(digit == "2", F.lit("None"))
        .when(digit == "3", F.lit(" nan\u00a0"))
        .when(digit == "4", F.lit("NaT"))
        .otherwise(F.concat(F.lit("  keep "), F.col("o_orderkey").cast("string"), F.lit(" ")))
    )
    status = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus"))
    raw = table(spark, sf_dir, "orders").select("o_orderkey", note.alias(" note\x00"), status.alias("status "))
    return conform(raw, lineage=F.lit("ORD"))


@query("""WITH raw AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS v,
        substr(o_orderpriority, 1, 1) AS k, o_orderstatus AS s FROM orders)
    SELECT o_orderkey,
        CASE WHEN s = 'P' AND k IN ('1', '2') THEN NULL WHEN s = 'P' AND k = '3' THEN 'abc' ELSE v END AS number_text,
        CASE WHEN s <> 'P' OR k IN ('4', '5') THEN CAST(v AS DOUBLE) END AS number_value
    FROM raw""")
def tolerant_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices behind quotes, no-break spaces, decimal commas and padding; and no numbers at all."""
    value = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    kind = F.substring("o_orderpriority", 1, 1)
    plain = (
        F.when(kind == "1", F.concat(F.lit('"'), value))
        .when(kind == "2", F.concat(F.lit("'"), value, F.lit("'\u00a0")))
        .when(kind == "3", F.concat(F.lit("\u00a0"), value, F.lit("\u00a0")))
        .when(kind == "4", F.regexp_replace(value, r"\.", ","))
        .otherwise(F.concat(F.lit("***"), value))
    )
    none = F.when(kind == "1", F.lit("  ")).when(kind == "2", F.lit("****")).when(kind == "3", F.lit(" abc "))
    dirty = F.when((F.col("o_orderstatus") == "P") & kind.isin("1", "2", "3"), none).otherwise(plain)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", dirty.alias("dirty"))
    return rows.select(
        "o_orderkey",
        fields.tolerant_number("dirty").alias("number_text"),
        fields.to_double("dirty").alias("number_value"),
    )


@query("""WITH raw AS (SELECT o_orderkey, o_orderdate, substr(o_orderpriority, 1, 1) AS k, o_orderstatus AS s FROM orders)
    SELECT o_orderkey,
        CASE WHEN k IN ('1', '2') THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
        CASE s WHEN 'F' THEN CASE k WHEN '1' THEN true WHEN '2' THEN true WHEN '3' THEN true WHEN '4' THEN true END
               WHEN 'O' THEN CASE k WHEN '1' THEN false WHEN '2' THEN false WHEN '3' THEN false WHEN '4' THEN false END END AS flag,
        CASE WHEN k <> '3' THEN o_orderkey END AS whole
    FROM raw""")
def typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, status = F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")
    day = (
        F.when(kind == "1", F.lit("00000000"))
        .when(kind == "2", F.lit("19990231"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    letters = F.translate(kind, "12345", "TtYy?"), F.translate(kind, "12345", "NnFf?")
    flag = F.when(status == "F", letters[0]).when(status == "O", letters[1]).otherwise(" ")
    whole = F.when(kind == "3", F.concat(F.col("o_orderkey").cast("string"), F.lit(".5"))).otherwise(
        F.concat(F.lit("  "), F.col("o_orderkey").cast("string"))
    )
    raw = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("d"), flag.alias("l"), whole.alias("n"))
    return raw.select(
        "o_orderkey",
        fields.to_date("d").alias("day"),
        fields.to_logical("l").alias("flag"),
        fields.to_long("n").alias("whole"),
    )


_SQL_LABEL = "trim(regexp_replace(translate(upper(replace({0}, 'ß', 'SS')), 'ÁÃÂÉÊÍÓÕÔÚÇ', 'AAAEEIOOOUC'), '[^A-Z0-9]+', '_', 'g'), '_')"


@query(f"SELECT doc_id, {_SQL_LABEL.format('text')} AS label FROM documents")
def normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_label("text").alias("label"))


@query("""SELECT s_suppkey, CASE WHEN length(code) < 6 THEN lpad(code, 6, '0') ELSE code END AS code
    FROM (SELECT s_suppkey, CASE WHEN s_nationkey > 12 THEN concat('12345', s_suppkey) ELSE CAST(s_suppkey AS VARCHAR) END AS code FROM supplier)""")
def zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    code = F.when(F.col("s_nationkey") > 12, F.concat(F.lit("12345"), key)).otherwise(key)
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.zero_fill(code).alias("code"))


@query("""SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time FROM events""")
def tz_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", report.local_time("ts", "UTC").alias("local_time"))


@query("""WITH b AS (SELECT l_shipdate, CAST(sum(CAST(l_partkey AS BIGINT) * l_partkey * l_linenumber) AS BIGINT) AS n
              FROM lineitem GROUP BY l_shipdate)
    SELECT l_shipdate, n,
        CASE WHEN n < 1024 THEN format('{:,.1f} B', CAST(n AS DOUBLE)) WHEN n < 1048576 THEN format('{:,.1f} KiB', n / 1024.0::DOUBLE)
             WHEN n < 1073741824 THEN format('{:,.1f} MiB', n / 1048576.0::DOUBLE)
             WHEN n < 1099511627776 THEN format('{:,.1f} GiB', n / 1073741824.0::DOUBLE)
             ELSE format('{:,.1f} TiB', n / 1099511627776.0::DOUBLE) END AS size,
        format('{:.2f} GiB', n / 1073741824.0::DOUBLE) AS gib, format('{:,}', n) AS grouped
    FROM b""")
def byte_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    total = F.sum(F.col("l_partkey") * F.col("l_partkey") * F.col("l_linenumber"))
    return lines.groupBy("l_shipdate").agg(total.alias("n")).select(
        "l_shipdate",
        "n",
        report.byte_size("n").alias("size"),
        report.gibibytes("n").alias("gib"),
        report.thousands("n").alias("grouped"),
    )


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k,
        CAST(count(json_extract_string(props, '$.absent')) AS BIGINT) AS absent
    FROM events GROUP BY event_type""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,string>")
    events = table(spark, sf_dir, "events").select("event_type", props.alias("p"))
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.try_element_at("p", F.lit("k")).cast("bigint")).alias("k"),
        F.count(F.try_element_at("p", F.lit("absent"))).alias("absent"),
    )


# ---- sets --------------------------------------------------------------------


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus AS status, o_orderpriority AS amount,
           CAST(NULL AS VARCHAR) AS lineno FROM orders
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), NULL, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),
           CAST(l_linenumber AS VARCHAR) FROM lineitem""")
def union_by_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns differ in set, order, case and type."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("amount")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("AMOUNT"),
        F.col("l_linenumber").alias("lineno"),
        F.col("l_orderkey").alias("ORDERKEY"),
    )
    return union_by_name(orders, lines)


@query("""SELECT s_name AS name, s_nationkey AS place, CAST(NULL AS VARCHAR) AS segment, s_acctbal AS extra FROM supplier""")
def align_to_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("extra"), F.col("s_nationkey").alias("PLACE"), F.col("s_name").alias("name")
    )
    return align_to(suppliers, reference)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier", name="exclude_columns")
def without_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_columns(table(spark, sf_dir, "supplier"), "s_nationkey")


@query("SELECT r_regionkey AS cod, r_name AS nome FROM region", name="clean_column_names")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_column_names(table(spark, sf_dir, "region").toDF("cod\x00", " nome "))


_SQL_CELLS = ", ".join(
    f"'v' || CAST({c} AS VARCHAR)"
    for c in ("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "strftime(o_orderdate, '%Y%m')")
)


@query(f"""WITH rows AS (SELECT strftime(o_orderdate, '%Y%m') AS period, md5(concat_ws(chr(31), {_SQL_CELLS})) AS h FROM orders)
    SELECT period, count(*) AS n_rows,
           concat(CAST(sum(CAST(('0x' || substr(h, 1, 16)) AS UBIGINT)) AS VARCHAR), '-',
                  CAST(sum(CAST(('0x' || substr(h, 17, 16)) AS UBIGINT)) AS VARCHAR)) AS digest
    FROM rows GROUP BY 1""")
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-free digest of all columns per month."""
    orders = table(spark, sf_dir, "orders").withColumn("period", month_key_of("o_orderdate"))
    return report.fingerprint(orders, "period")
