"""Plans: what is pushed down, broadcast, shuffled or split."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakeward.operators import sizing
from lakeward.operators.ledger import dedup_case_insensitive, revision_diff
from lakeward.operators.merge import merge_by_key, not_in
from lakeward.operators.partitions import read_months, write_months
from lakeward.operators.periods import latest_period, period_window
from lakeward.plans.catalog import QUERIES
from lakeward.plans import queries  # noqa: F401 - fills the registry
from tests.conftest import SF_DIR, plan_of, rows_of


@contextmanager
def session_settings(spark, settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_no_python_on_the_data_path(spark):
    reads_python = {
        "scan_dbf", "quarantine_files", "ingest_months_twice", "ingest_merge_twice", "months_with_broken_file",
        "snapshot_with_broken_file", "same_size_revision", "quarantine_csv",
    }
    for name, query in QUERIES.items():
        if name in reads_python:
            continue
        plan = formatted(query(spark, SF_DIR)) if name not in _WRITERS else ""
        assert "Python" not in plan and "MapInArrow" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin Cross" not in plan, name


_WRITERS = {
    "rebuild_partitions", "rebuild_in_batches", "merge_by_source_in_months", "layout_by_year", "stream_append_new_files",
    "scan_csv_union_by_header", "consolidate_by_folder", "rows_without_period",
}


def test_window_reaches_the_scan(spark):
    plan = formatted(QUERIES["backfill_range"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_quantity:double,l_shipdate" in plan


def test_window_prunes_month_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    write_months(spark.createDataFrame([(f"2020{m:02d}", m) for m in range(1, 13)], "competencia string, v int"), path)
    rows = period_window(read_months(spark, path), start="202003", end="202004")
    assert "PartitionFilters: [isnotnull(competencia" in formatted(rows)
    assert rows.count() == 2


def test_replaced_keys_are_broadcast(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumn("k", F.col("o_orderpriority"))
    merged = not_in(orders, orders.where("o_orderpriority = '5-LOW'"), "k")
    plan = formatted(merged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def test_beyond_the_bound_hot_keys_are_split_off(spark, monkeypatch):
    # The side is past the bound, its rows for the hot keys are not.
    monkeypatch.setattr(sizing, "settled_with_size", lambda df: (df, 10**12))
    # Two sources hold most rows, others have lost their source.
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") < 20_000, "HOT")
        .when(F.col("id") < 40_000, "hot2")
        .when(F.col("id") < 50_000, F.concat(F.lit("K"), (F.col("id") % 50).cast("string")))
        .alias("k"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )
    gone = spark.createDataFrame([("k7",), ("HOT2",), ("x",)], "k string")
    with session_settings(spark, NO_BROADCAST):
        kept = not_in(rows, gone, "k")
        plan = plan_of(kept).split("== Physical Plan ==")[1]
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert kept.count() == 20_000 + 9_800
        assert kept.where("k = 'HOT'").count() == 20_000


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_split_join_equals_the_plain_one(spark, how):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [(None, i) for i in range(20)] + [("b", 1), ("c", 2), ("d", 3)], "k string, v int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), ("q", "w")], "rk string, t string")
    plain = rows_of(left.join(right, F.col("k") == F.col("rk"), how))
    for limit in (-1, 0, 10**9):  # the hot rows are copied, or broadcast, or all are
        assert rows_of(sizing.join_small(left, right, F.col("k"), "rk", how, limit)) == plain
    assert sizing._hot_keys(left.select("k")) == ["a"]


def test_diff_and_dedup_merge_before_their_shuffle(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    sides = orders.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_custkey").alias("fingerprint"))
    plan = formatted(revision_diff(sides, sides))
    assert plan.count("Exchange (") <= 2 and "Join" not in plan.split("(1)")[0]
    assert "partial_max" in plan
    names = orders.select(F.col("o_orderpriority").alias("name"))
    assert "partial_min" in formatted(dedup_case_insensitive(names, "name"))
    assert "Window" not in formatted(latest_period(orders, "o_orderdate", "o_orderstatus"))


def test_rate_counts_before_it_joins(spark):
    plan = formatted(QUERIES["rate_per_100k"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate" in plan
    assert "partial_count(1)" in plan


def test_hot_month_is_split_over_files(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    with session_settings(spark, settings):
        rows = spark.range(0, 40_000, 1, 8).select(
            F.when(F.col("id") < 30_000, "202001").otherwise("202002").alias("competencia"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        path = str(tmp_path / "t")
        write_months(rows, path)
        files = read_months(spark, path).inputFiles()
        assert sum("202001" in f for f in files) > 1
        assert read_months(spark, path).count() == 40_000


def test_merge_through_the_shuffle_gives_the_same(spark, monkeypatch):
    old = spark.createDataFrame([("A", "1"), ("b", "2"), (None, "3")], "_ARQUIVO_ORIGEM string, v string")
    new = spark.createDataFrame([("B", "9")], "_ARQUIVO_ORIGEM string, v string")
    small = rows_of(merge_by_key(old, new))
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    assert rows_of(merge_by_key(old, new)) == small == [("A", "1"), ("B", "9")]


def jobs_of(spark, run) -> int:
    group = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_queries_take_few_jobs(spark):
    count = lambda name: jobs_of(spark, lambda: QUERIES[name](spark, SF_DIR).collect())
    assert count("merge_by_source") <= 6
    # Two ingestions, the fixtures of both and the read; every shuffle of a small table is a job.
    assert count("ingest_months_twice") < 60


def test_a_rebuild_reads_its_source_once(spark):
    from lakeward.operators import partitions

    read = []
    real = partitions.rebuild_partitions
    partitions.rebuild_partitions = lambda rows, *rest, **more: (read.append(rows), real(rows, *rest, **more))[1]
    try:
        QUERIES["rebuild_in_batches"](spark, SF_DIR).collect()
    finally:
        partitions.rebuild_partitions = real
    assert len(read) == 1
