"""Differences of large snapshots by sums of hashes, and the audit of a merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.digests import audit, digests_after, source_digests, total_of, tree_diff
from lakeward.operators.merge import merge_by_key
from lakeward.plans.catalog import query
from lakeward.plans.deliveries import SQL_TAGGED, tagged_orders
from lakeward.session import scratch_path, settled
from lakeward.sinks.tables import publish_table, read_published


@query(f"""WITH {SQL_TAGGED},
    known AS (SELECT o_orderkey, cents FROM tagged WHERE period <> '199904'),
    current AS (
        SELECT o_orderkey, CASE WHEN period IN ('199703', '200002') AND uf = 'MG' THEN cents + 1 ELSE cents END AS cents
        FROM tagged WHERE NOT (period = '199805' AND uf = 'SP'))
    SELECT CAST(coalesce(c.o_orderkey, k.o_orderkey) AS VARCHAR) AS key,
           CASE WHEN k.o_orderkey IS NULL THEN 'new' WHEN c.o_orderkey IS NULL THEN 'gone' ELSE 'changed' END AS status
    FROM current c FULL JOIN known k ON c.o_orderkey = k.o_orderkey
    WHERE c.cents IS DISTINCT FROM k.cents""")
def snapshot_tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of all orders: two months revised in one state, one month new, a state gone from another."""
    rows = tagged_orders(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("key"), "cents", "uf", "period")
    revised = F.col("period").isin("199703", "200002") & (F.col("uf") == "MG")
    current = rows.where(~((F.col("period") == "199805") & (F.col("uf") == "SP"))).withColumn(
        "cents", F.when(revised, F.col("cents") + 1).otherwise(F.col("cents"))
    )
    known = rows.where("period <> '199904'")
    return tree_diff(current, known, "period", fingerprint="cents")


_SQL_MERGED_TWICE = f"""{SQL_TAGGED},
merged AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
           CAST(CASE WHEN uf = 'SP' THEN cents + 100 WHEN uf = 'RJ' THEN cents + 7 ELSE cents END AS VARCHAR) AS cents,
           CASE WHEN uf = 'RJ' THEN 'S' END AS revisado, upper(file) AS file
    FROM tagged WHERE NOT (uf = 'BA' AND substr(period, 1, 4) = '1999')),
hashed AS (
    SELECT file, md5(concat_ws(chr(31), 'cents=' || cents, 'o_orderkey=' || o_orderkey, 'o_orderstatus=' || o_orderstatus, 'revisado=' || revisado)) AS h
    FROM merged),
sums AS (
    SELECT file, CAST(count(*) AS BIGINT) AS n,
           sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)::HUGEINT) AS high, sum(CAST('0x' || substr(h, 17, 16) AS UBIGINT)::HUGEINT) AS low
    FROM hashed GROUP BY file)"""


@query(f"""WITH {_SQL_MERGED_TWICE}
    SELECT file AS _ARQUIVO_ORIGEM, n AS kept_rows, n AS found_rows, 'same' AS status, CAST(high AS VARCHAR) AS high, CAST(low AS VARCHAR) AS low FROM sums
    UNION ALL
    SELECT 'TOTAL', CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT), 'same', CAST(sum(high) AS VARCHAR), CAST(sum(low) AS VARCHAR) FROM sums""")
def source_digest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries into a published table, the second with a new column and with files that hold no rows any more:
    the digests carried along are those of the table as it is read at the end."""
    orders = tagged_orders(spark, sf_dir)
    rows = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", "cents", "uf", "period", F.col("file").alias("_ARQUIVO_ORIGEM"))
    target = scratch_path(spark, "audited")

    def of(state: str, more: int) -> DataFrame:
        return rows.where(F.col("uf") == state).withColumn("cents", F.col("cents") + more).drop("uf", "period")

    first = rows.drop("uf", "period")
    second = of("SP", 100).withColumn("_ARQUIVO_ORIGEM", F.lower("_ARQUIVO_ORIGEM"))
    third = of("RJ", 7).withColumn("revisado", F.lit("S"))
    emptied = rows.where("uf = 'BA' and substring(period, 1, 4) = '1999'").select("_ARQUIVO_ORIGEM")
    read_well = third.select("_ARQUIVO_ORIGEM").unionByName(emptied).distinct()

    publish_table(first, target)
    digests = settled(source_digests(first), "digests")
    for delivered, keys in ((second, None), (third, read_well)):
        publish_table(merge_by_key(read_published(spark, target), delivered, delivered_keys=keys), target)
        digests = settled(digests_after(digests, delivered, delivered_keys=keys), "digests")
    found = audit(read_published(spark, target), digests)
    each = found.join(digests.select("_ARQUIVO_ORIGEM", "high", "low"), "_ARQUIVO_ORIGEM", "left")
    whole = total_of(source_digests(read_published(spark, target))).select(F.col("n_rows").alias("found_rows"), F.col("high").alias("_high"), F.col("low").alias("_low"))
    agree = (F.col("n_rows") == F.col("found_rows")) & (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    total = total_of(digests).join(whole, agree, "left").select(
        F.lit("TOTAL").alias("_ARQUIVO_ORIGEM"), F.col("n_rows").alias("kept_rows"), F.coalesce("found_rows", F.lit(0)).alias("found_rows"),
        F.when(F.col("found_rows").isNull(), "differs").otherwise("same").alias("status"), "high", "low",
    )
    return each.unionByName(total).withColumn("high", F.col("high").cast("string")).withColumn("low", F.col("low").cast("string"))
