"""Merges, snapshots, rebuilt months, ledgers and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.periods import month_key_of
from lakeward.operators import ledger as led
from lakeward.operators.merge import merge_by_key, not_in, prefer_final, replace_snapshot
from lakeward.operators.partitions import (
    Layout,
    merge_partitions,
    month_list,
    read_months,
    rebuild_partitions,
    rebuild_with_ledger,
    write_by_year,
    write_months,
)
from lakeward.operators.periods import distinct_periods, recent_or_unknown, time_window, top_n_periods
from lakeward.plans.catalog import query
from lakeward.plans.deliveries import (
    SQL_LEDGER,
    SQL_LISTING,
    SQL_TAGGED,
    listing,
    old_ledger,
    table,
    tagged_orders,
)
from lakeward.session import scratch_path, settled
from lakeward.sinks.tables import publish_table, read_ledger, read_published, write_ledger
from lakeward.sources.parquet import scan_months

MONEY = "decimal(18,2)"


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table: some rows have lost their source."""
    orders = tagged_orders(spark, sf_dir)
    lost = (F.col("o_orderstatus") == "P") & (F.col("uf") == "RS")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast(MONEY).cast("string").alias("price"),
        F.when(~lost, F.col("file")).alias("_ARQUIVO_ORIGEM"),
    )


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """São Paulo comes again, in capitals, dearer and with a new column; Minas
    sends further part files."""
    orders = tagged_orders(spark, sf_dir).where(F.col("uf").isin("SP", "MG"))
    again = F.col("uf") == "SP"
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        "o_orderstatus",
        (F.col("o_totalprice").cast(MONEY) + F.lit(1).cast(MONEY)).cast(MONEY).cast("string").alias("price"),
        F.when(again, "S").alias("revisado"),
        F.when(again, F.upper("file")).otherwise(F.regexp_replace("file", r"\.dbc$", "a.dbc")).alias("_ARQUIVO_ORIGEM"),
    )


_SQL_SIDES = f"""{SQL_TAGGED},
existing AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
           CASE WHEN NOT (o_orderstatus = 'P' AND uf = 'RS') THEN file END AS origem
    FROM tagged),
delivered AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
           CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)) AS VARCHAR) AS price,
           CASE WHEN uf = 'SP' THEN 'S' END AS revisado,
           CASE WHEN uf = 'SP' THEN upper(file) ELSE replace(file, '.dbc', 'a.dbc') END AS origem
    FROM tagged WHERE uf IN ('SP', 'MG'))"""

_SQL_MERGED = f"""WITH {_SQL_SIDES}
    SELECT o_orderkey, o_orderstatus, price, CAST(NULL AS VARCHAR) AS revisado, origem AS _ARQUIVO_ORIGEM
    FROM existing
    WHERE origem IS NOT NULL AND upper(origem) NOT IN (SELECT upper(origem) FROM delivered)
    UNION ALL
    SELECT o_orderkey, o_orderstatus, price, revisado, origem FROM delivered"""


@query(_SQL_MERGED)
def merge_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_by_key(_existing(spark, sf_dir), _delivered(spark, sf_dir))


@query(f"""WITH {_SQL_SIDES}
    SELECT o_orderkey, o_orderstatus, price, origem AS _ARQUIVO_ORIGEM FROM existing
    WHERE origem IS NOT NULL AND upper(origem) NOT IN (SELECT upper(origem) FROM delivered)""")
def not_in_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_in(_existing(spark, sf_dir), _delivered(spark, sf_dir), "_ARQUIVO_ORIGEM")


@query(f"""WITH {_SQL_SIDES}
    SELECT o_orderkey, o_orderstatus, price, origem AS _ARQUIVO_ORIGEM FROM existing
    WHERE origem IS NOT NULL
      AND upper(origem) NOT IN (SELECT upper(file) FROM tagged WHERE uf = 'BA' AND substr(period, 1, 4) = '1999')""")
def anti_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery whose files hold no rows still replaces the old rows."""
    files = listing(spark, sf_dir).where("uf = 'BA' and substring(period, 1, 4) = '1999'")
    empty = _delivered(spark, sf_dir).where("false").select("o_orderkey", "o_orderstatus", "price", "_ARQUIVO_ORIGEM")
    return merge_by_key(
        _existing(spark, sf_dir), empty, delivered_keys=files.select(F.col("key").alias("_ARQUIVO_ORIGEM"))
    )


@query(f"""WITH {SQL_TAGGED},
    old AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ANO, cents FROM tagged),
    fresh AS (SELECT o_orderkey, ANO, cents + 100 AS cents FROM old WHERE ANO IN (1997, 2000))
    SELECT o_orderkey, ANO, cents FROM old WHERE ANO NOT IN (SELECT ANO FROM fresh)
    UNION ALL SELECT o_orderkey, ANO, cents FROM fresh""")
def merge_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = tagged_orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("ANO"), "cents")
    fresh = old.where(F.col("ANO").isin(1997, 2000)).withColumn("cents", F.col("cents") + 100)
    return merge_by_key(old, fresh, "ANO", as_text=False)


@query(f"""WITH {SQL_TAGGED},
    flagged AS (SELECT o_orderkey, file, cents, o_orderstatus = 'F' AS final FROM tagged
                WHERE o_orderstatus <> 'F' OR uf IN ('RJ', 'BA'))
    SELECT o_orderkey, file, cents, final FROM flagged
    WHERE final OR upper(file) NOT IN (SELECT upper(file) FROM flagged WHERE final)""")
def final_over_preliminary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged_orders(spark, sf_dir).where("o_orderstatus <> 'F' or uf in ('RJ', 'BA')")
    rows = rows.select("o_orderkey", "file", "cents", (F.col("o_orderstatus") == "F").alias("final"))
    return prefer_final(rows, "file", "final")


@query(f"""WITH {SQL_TAGGED},
    latest AS (SELECT o_orderstatus, max(period) AS period FROM tagged GROUP BY o_orderstatus)
    SELECT o_orderkey, t.o_orderstatus, t.period, cents
    FROM tagged t JOIN latest l ON t.o_orderstatus = l.o_orderstatus AND t.period = l.period""",
    name="replace_snapshot")
def replace_snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "period", "cents")
    target = scratch_path(spark, "snapshot")
    publish_table(rows.where("period <= '200012'"), target)
    publish_table(replace_snapshot(rows, "period", "o_orderstatus"), target)
    return read_published(spark, target)


@query(f"""WITH {SQL_TAGGED}
    SELECT o_orderkey, period, cents FROM tagged WHERE period = (SELECT max(period) FROM tagged)""")
def latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged_orders(spark, sf_dir).select("o_orderkey", "period", "cents")
    return replace_snapshot(rows, "period")


_SQL_AFFECTED = f"""{SQL_LEDGER},
    changed AS (
        SELECT DISTINCT period FROM files f LEFT JOIN ledger l ON upper(f.key) = upper(l.key)
        WHERE l.key IS NULL OR l.fingerprint IS DISTINCT FROM f.fingerprint)"""


@query(f"""WITH {_SQL_AFFECTED},
    listed AS (SELECT * FROM files WHERE uf <> 'SP')
    SELECT DISTINCT f.period FROM listed f LEFT JOIN ledger l ON upper(f.key) = upper(l.key)
    WHERE l.key IS NULL OR l.fingerprint <> f.fingerprint
    UNION
    SELECT period FROM (SELECT DISTINCT period FROM listed ORDER BY period DESC LIMIT 2)""")
def affected_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = listing(spark, sf_dir)
    return led.affected_periods(files.where("uf <> 'SP'"), old_ledger(files), "period", margin=2)


@query(f"""WITH {_SQL_AFFECTED},
    months AS (
        SELECT DISTINCT f.period FROM files f LEFT JOIN ledger l ON upper(f.key) = upper(l.key)
        WHERE uf <> 'SP' AND (l.key IS NULL OR l.fingerprint <> f.fingerprint))
    SELECT o_orderkey, period AS competencia,
           CASE WHEN period IN (SELECT period FROM months) THEN cents + 5 ELSE cents END AS cents
    FROM tagged
    WHERE NOT (period = '199803')""",
    name="rebuild_partitions")
def rebuild_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the changed months are written anew; one of them has become empty."""
    orders = tagged_orders(spark, sf_dir).select("o_orderkey", F.col("period").alias("competencia"), "cents")
    target = scratch_path(spark, "months")
    write_months(orders, target)
    files = listing(spark, sf_dir).where("uf <> 'SP'")
    months = month_list(led.affected_periods(files, old_ledger(files), "period"), "period")
    revised = orders.where("competencia <> '199803'").withColumn("cents", F.col("cents") + 5)
    rebuild_partitions(revised, months, target)
    return read_months(spark, target)


@query(f"""WITH {SQL_LISTING},
    done AS (SELECT * FROM files WHERE period BETWEEN '199609' AND '199812'),
    months AS (
        SELECT period, sum(o_orderkey) AS order_keys, sum(cents) AS cents FROM tagged
        WHERE period BETWEEN '199609' AND '199812' GROUP BY period)
    SELECT upper(key) AS key, d.fingerprint, d.period AS competencia, CAST(m.order_keys AS BIGINT) AS order_keys, CAST(m.cents AS BIGINT) AS cents
    FROM done d JOIN months m ON d.period = m.period""")
def rebuild_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a backfill of four batches cut by the bytes of their files, each file with the sums of its rebuilt month."""
    orders = tagged_orders(spark, sf_dir).select("o_orderkey", F.col("period").alias("competencia"), "cents")
    files = settled(listing(spark, sf_dir).withColumnRenamed("period", "competencia").withColumn("bytes", F.col("rows") * 100), "files")
    months = month_list(files.where("competencia between '199609' and '199812'"), "competencia")
    target, ledger = scratch_path(spark, "backfill"), scratch_path(spark, "backfill-ledger")

    size = files.where(F.col("competencia").isin(months)).agg(F.sum("bytes")).first()[0]
    rebuild_with_ledger(lambda part: (orders.where(F.col("competencia").isin(part)), None), files, months, target, ledger, batch_bytes=-(-size // 4))
    sums = read_months(spark, target).groupBy("competencia").agg(F.sum("o_orderkey").alias("order_keys"), F.sum("cents").alias("cents"))
    named = files.select(F.upper("key").alias("key"), "competencia")
    return read_ledger(spark, ledger).join(named, "key").join(sums, "competencia").select("key", "fingerprint", "competencia", "order_keys", "cents")


@query(f"""WITH {SQL_TAGGED}
    SELECT o_custkey, period AS competencia, count(*) AS orders, CAST(sum(cents) AS BIGINT) AS cents
    FROM tagged WHERE o_custkey BETWEEN 20 AND 60 AND period BETWEEN '199701' AND '199806' GROUP BY o_custkey, period""")
def months_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few customers in some months of a table whose months lie in the order of the customers, after a merge by source."""
    orders = tagged_orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", F.col("period").alias("competencia"), "cents", F.col("file").alias("_ARQUIVO_ORIGEM"), "uf"
    )
    target, layout = scratch_path(spark, "ordered-months"), Layout(("o_custkey",), blooms=("o_orderkey",))
    write_months(orders.where("uf <> 'MG' or competencia <> '199712'").drop("uf"), target, layout=layout)
    merge_partitions(orders.where("uf = 'MG' and competencia = '199712'").drop("uf"), target, layout=layout)
    asked = scan_months(spark, target).where("o_custkey between 20 and 60 and competencia between '199701' and '199806'")
    return asked.groupBy("o_custkey", "competencia").agg(F.count(F.lit(1)).alias("orders"), F.sum("cents").alias("cents"))


@query(f"""WITH {SQL_TAGGED}
    SELECT o_orderkey, period AS competencia,
           CASE WHEN uf = 'RJ' AND substr(period, 1, 4) = '2000' THEN cents + 7 ELSE cents END AS cents,
           file AS _ARQUIVO_ORIGEM
    FROM tagged
    UNION ALL
    SELECT o_orderkey, period, cents + 7, replace(file, '.dbc', 'b.dbc') FROM tagged
    WHERE uf = 'BA' AND period = '200106'""")
def merge_by_source_in_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge by source into a month-partitioned table, touching only its months."""
    orders = tagged_orders(spark, sf_dir).select(
        "o_orderkey", F.col("period").alias("competencia"), "cents", F.col("file").alias("_ARQUIVO_ORIGEM"), "uf"
    )
    target = scratch_path(spark, "merge-months")
    write_months(orders.drop("uf"), target)
    again = orders.where("uf = 'RJ' and substring(competencia, 1, 4) = '2000'")
    further = orders.where("uf = 'BA' and competencia = '200106'").withColumn(
        "_ARQUIVO_ORIGEM", F.regexp_replace("_ARQUIVO_ORIGEM", r"\.dbc$", "b.dbc")
    )
    delivered = again.unionByName(further).withColumn("cents", F.col("cents") + 7).drop("uf")
    merge_partitions(delivered, target)
    return read_months(spark, target)


@query("""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS competencia, l_extendedprice
    FROM lineitem WHERE year(l_shipdate) = 1997""")
def layout_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months below year folders; reading one year opens that folder only."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", month_key_of("l_shipdate").alias("competencia")
    )
    target = scratch_path(spark, "by-year")
    write_by_year(lines, target)
    return spark.read.parquet(target).where("ano = '1997'").select(
        "l_orderkey", "l_linenumber", F.col("competencia").cast("string").alias("competencia"), "l_extendedprice"
    )


def _backfill(spark: SparkSession, sf_dir: str, **window: str) -> DataFrame:
    lines = time_window(table(spark, sf_dir, "lineitem"), "l_shipdate", **window)
    return lines.groupBy(month_key_of("l_shipdate").alias("competencia")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


def _sql_backfill(condition: str) -> str:
    return f"""SELECT strftime(l_shipdate, '%Y%m') AS competencia, count(*) AS n_lines,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem WHERE {condition} GROUP BY 1"""


@query(_sql_backfill("year(l_shipdate) = 1999"))
def backfill_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfill(spark, sf_dir, year="1999")


@query(_sql_backfill("strftime(l_shipdate, '%Y%m') = '200012'"))
def backfill_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfill(spark, sf_dir, month="200012")


@query(_sql_backfill("strftime(l_shipdate, '%Y%m') BETWEEN '199611' AND '199802'"))
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfill(spark, sf_dir, start="199611", end="199802")


def _order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders now, and a copy in which some prices differ, some orders are
    missing and some have since been deleted."""
    orders = tagged_orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("cents").alias("fingerprint"), "uf", "o_orderstatus"
    )
    current = orders.where("uf <> 'RS' or o_orderstatus <> 'O'")
    known = orders.where("uf <> 'BA' or o_orderstatus <> 'F'").withColumn(
        "fingerprint", F.when(F.col("uf") == "MG", F.col("fingerprint") + 1).otherwise(F.col("fingerprint"))
    )
    return current.select("key", "fingerprint"), known.select("key", "fingerprint")


_SQL_ORDER_SIDES = f"""{SQL_TAGGED},
    cur AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, cents AS fp FROM tagged
            WHERE uf <> 'RS' OR o_orderstatus <> 'O'),
    old AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN uf = 'MG' THEN cents + 1 ELSE cents END AS fp
            FROM tagged WHERE uf <> 'BA' OR o_orderstatus <> 'F')"""


@query(f"""WITH {_SQL_ORDER_SIDES}
    SELECT cur.key, CASE WHEN old.key IS NULL THEN 'new' ELSE 'changed' END AS status
    FROM cur LEFT JOIN old ON cur.key = old.key WHERE cur.fp IS DISTINCT FROM old.fp""")
def revision_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.revision_diff(*_order_sides(spark, sf_dir))


@query(f"""WITH {_SQL_ORDER_SIDES}
    SELECT coalesce(cur.key, old.key) AS key,
           CASE WHEN cur.key IS NULL THEN 'orphan' WHEN cur.fp = old.fp THEN 'reuse' ELSE 'download' END AS action
    FROM cur FULL JOIN old ON cur.key = old.key""")
def snapshot_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.snapshot_sync(*_order_sides(spark, sf_dir))


@query(f"""WITH {_SQL_ORDER_SIDES}
    SELECT count(*) > 0 AS any_changed FROM cur LEFT JOIN old ON cur.key = old.key
    WHERE cur.fp IS DISTINCT FROM old.fp""")
def any_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return led.any_changed(*_order_sides(spark, sf_dir))


@query(f"""WITH {SQL_LEDGER}
    SELECT key, uf, period, rows, fingerprint FROM files
    WHERE period IN (SELECT DISTINCT period FROM files ORDER BY period DESC LIMIT 2)
       OR upper(key) NOT IN (SELECT upper(key) FROM ledger)""", name="recent_or_unknown")
def recent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = listing(spark, sf_dir).drop("mtime")
    return recent_or_unknown(files, old_ledger(files), "key", "period", n=2)


@query(f"""WITH {SQL_LISTING} SELECT DISTINCT period FROM files ORDER BY period DESC LIMIT 5""")
def top_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n_periods(tagged_orders(spark, sf_dir), "period", 5)


@query(f"""WITH {SQL_TAGGED} SELECT DISTINCT period FROM tagged""")
def all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_periods(tagged_orders(spark, sf_dir), "period").orderBy("period")


_SQL_DELIVERY = "delivery AS (SELECT key, fingerprint + 9 AS fingerprint FROM files WHERE uf IN ('SP', 'RJ'))"


@query(f"""WITH {SQL_LEDGER}, {_SQL_DELIVERY}
    SELECT upper(key) AS key, fingerprint FROM delivery
    UNION ALL
    SELECT upper(key), fingerprint FROM ledger WHERE upper(key) NOT IN (SELECT upper(key) FROM delivery)""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as it is read back after its write."""
    files = listing(spark, sf_dir)
    fresh = files.where("uf in ('SP', 'RJ')").select("key", (F.col("fingerprint") + 9).alias("fingerprint"))
    target = scratch_path(spark, "ledger")
    write_ledger(old_ledger(files), target)
    write_ledger(led.ledger_upsert(read_ledger(spark, target), fresh), target)
    return read_ledger(spark, target)


@query(f"""WITH {SQL_LEDGER}, {_SQL_DELIVERY}
    SELECT upper(key) AS key, fingerprint FROM delivery
    UNION ALL
    SELECT upper(key), fingerprint FROM ledger
    WHERE NOT starts_with(upper(key), 'OLDPA') AND upper(key) NOT IN (SELECT upper(key) FROM delivery)""")
def ledger_replace_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = listing(spark, sf_dir)
    fresh = files.where("uf in ('SP', 'RJ')").select("key", (F.col("fingerprint") + 9).alias("fingerprint"))
    return led.ledger_replace_prefix(old_ledger(files), "oldpa", fresh)


@query(f"""WITH {SQL_TAGGED},
    expected AS (SELECT DISTINCT period FROM tagged WHERE uf <> 'RS'),
    present AS (SELECT DISTINCT period FROM tagged WHERE uf = 'RS' AND substr(period, 5, 2) NOT IN ('02', '07'))
    SELECT period FROM expected EXCEPT SELECT period FROM present""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tagged_orders(spark, sf_dir)
    expected = distinct_periods(orders.where("uf <> 'RS'"), "period")
    present = distinct_periods(orders.where("uf = 'RS' and substring(period, 5, 2) not in ('02', '07')"), "period")
    return expected.subtract(present)


@query(f"""WITH {SQL_TAGGED}
    SELECT period FROM tagged WHERE uf = 'SP' AND substr(period, 5, 2) = '01'
    UNION
    SELECT period FROM (SELECT DISTINCT period FROM tagged ORDER BY period DESC LIMIT 3)""")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tagged_orders(spark, sf_dir)
    januaries = distinct_periods(orders.where("uf = 'SP' and substring(period, 5, 2) = '01'"), "period")
    return januaries.union(top_n_periods(orders, "period", 3)).distinct()
