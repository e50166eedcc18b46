from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeward.operators import digests
from lakeward.operators.ledger import snapshot_sync
from lakeward.operators.merge import merge_by_key
from tests.conftest import rows_of

ROWS = "key string, fingerprint long, month string"


def diff(spark, current, known, **more):
    return rows_of(digests.tree_diff(spark.createDataFrame(current, ROWS), spark.createDataFrame(known, ROWS), "month", **more))


def test_differences_of_small_tables(spark):
    known = [("a", 1, "m1"), ("b", 2, "m1"), ("c", 3, "m2"), ("d", None, "m2"), ("e", 5, None), (None, 9, "m1"), ("f", 6, "m3"), ("f", 6, "m3")]
    current = [("A", 1, "m1"), ("b", 7, "m1"), ("d", 4, "m2"), ("e", 5, "m9"), ("g", 8, None), ("f", 6, "m3")]
    assert diff(spark, current, known) == [("B", "changed"), ("C", "gone"), ("D", "changed"), ("G", "new")]
    assert diff(spark, known, known) == []
    assert diff(spark, [], known[:1]) == [("A", "gone")]
    assert diff(spark, known[:1], []) == [("A", "new")]
    assert diff(spark, [], []) == []


@pytest.mark.parametrize("leaves", [1, 7, 1024])
def test_as_the_comparison_of_all_keys(spark, leaves):
    n = spark.range(4000)
    known = n.select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 3).alias("fingerprint"), (F.col("id") % 5).cast("string").alias("month"))
    current = known.where("fingerprint % 31 <> 0").withColumn("fingerprint", F.when(F.col("month") == "2", F.col("fingerprint") + 1).otherwise(F.col("fingerprint")))
    current = current.union(spark.createDataFrame([("k9999", 1, "7")], ROWS))
    got = {(k, s) for k, s in rows_of(digests.tree_diff(current, known, "month", leaves=leaves))}
    want = {(r["key"], r["action"]) for r in snapshot_sync(current, known).collect() if r["action"] != "reuse"}
    assert {k for k, s in got if s == "gone"} == {k for k, a in want if a == "orphan"}
    assert {k for k, s in got if s != "gone"} == {k for k, a in want if a == "download"}


def test_only_leaves_that_differ_are_compared_row_by_row(spark):
    known = spark.range(200_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("fingerprint"), (F.col("id") % 20).cast("string").alias("month"))
    # One row in a hundred: a fifth of one month.
    changed = (F.col("month") == "3") & (F.col("fingerprint") % 100 < 20)
    current = known.withColumn("fingerprint", F.when(changed, -F.col("fingerprint")).otherwise(F.col("fingerprint")))
    assert digests.rows_to_compare(current, known, "month").count() <= 2 * 10_000
    one = known.withColumn("fingerprint", F.when(F.col("key") == "k77", F.lit(-1)).otherwise(F.col("fingerprint")))
    rows = digests.rows_to_compare(one, known, "month")
    assert 2 <= rows.count() < 100
    assert rows_of(digests.tree_diff(one, known, "month")) == [("K77", "changed")]


def test_digests_follow_merges_and_show_what_is_wrong(spark):
    first = spark.createDataFrame([("1", "x", "f1"), ("2", "y", "f1"), ("2", "y", "f1"), ("3", None, "f2"), ("4", "z", "f3"), ("5", "lost", None)], "id string, v string, _ARQUIVO_ORIGEM string")
    second = spark.createDataFrame([("6", "w", "new", "F2")], "id string, v string, more string, _ARQUIVO_ORIGEM string")
    keys = spark.createDataFrame([("f2",), ("f3",)], "_ARQUIVO_ORIGEM string")
    table = merge_by_key(first, second, delivered_keys=keys)
    kept = digests.digests_after(digests.source_digests(first), second, delivered_keys=keys)
    assert rows_of(digests.audit(table, kept)) == [("F1", 3, 3, "same"), ("F2", 1, 1, "same")]
    assert rows_of(digests.total_of(kept)) == rows_of(digests.total_of(digests.source_digests(table)))
    bad = table.where("id <> '1'").withColumn("v", F.when(F.col("id") == "6", "other").otherwise(F.col("v")))
    assert rows_of(digests.audit(bad, kept)) == [("F1", 3, 2, "differs"), ("F2", 1, 1, "differs")]
    assert rows_of(digests.audit(table.where("id <> '6'"), kept))[1] == ("F2", 1, 0, "lost")
    assert rows_of(digests.audit(first, kept))[-1] == (None, 0, 1, "unknown")
    assert digests.audit(table.where("false"), kept.where("false")).collect() == []
    assert tuple(digests.total_of(kept.where("false")).first()) == (0, 0, 0)
