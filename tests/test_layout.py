"""Rows of a month lie in the order of their places, in bounded row groups."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeward.operators.partitions import Layout, merge_partitions, read_months, rebuild_partitions, write_months
from lakeward.sinks.tables import publish_table
from tests.conftest import rows_of

GROUP = 200


def groups(folder, month="202401", column="place"):
    """(rows, smallest, largest) of the row groups of the newest version of a month."""
    newest = max(Path(folder).rglob(f"competencia={month}"), key=lambda p: int(p.parent.name.split("=")[1]))
    found = []
    for file in newest.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for i in range(meta.num_row_groups):
            g = meta.row_group(i)
            found.append((g.num_rows, g.column(at).statistics.min, g.column(at).statistics.max))
    return found


@pytest.fixture
def rows(spark):
    """A third of the rows of the first month are of one place; every file has all places."""
    place = F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.hash("id"), F.lit(1000)))
    return spark.range(24_000).select(
        "id", place.cast("int").alias("place"), F.when(F.col("id") < 18_000, "202401").otherwise("202402").alias("competencia"),
        F.concat(F.lit("f"), (F.col("id") % 7).cast("string"), F.when(F.col("id") < 18_000, "a").otherwise("b")).alias("_ARQUIVO_ORIGEM"),
    )


def test_one_place_is_in_a_fraction_of_the_row_groups(spark, rows, tmp_path):
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "ordered")
    write_months(rows, plain, layout=Layout(row_group_rows=GROUP))
    write_months(rows, ordered, layout=Layout(("place",), GROUP))
    assert rows_of(read_months(spark, ordered)) == rows_of(read_months(spark, plain))

    def share(path, place):
        found = groups(path)
        assert max(n for n, _, _ in found) <= GROUP
        return sum(low <= place <= high for _, low, high in found) / len(found)

    assert share(plain, 123) > 0.9
    assert share(ordered, 123) < 0.05
    # The place of a third of the rows has a third of the groups, and not all in one file.
    assert 0.3 < share(ordered, 500) < 0.4


def test_a_hot_place_is_several_ranges(spark, rows, tmp_path):
    spread = Layout(("place",)).spread(rows.where("place = 500"), "competencia", False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 0.4 * sum(sizes)


def test_the_order_is_kept_by_rebuilds_and_merges(spark, rows, tmp_path):
    path, layout = str(tmp_path / "t"), Layout(("place",), GROUP, blooms=("id",))
    write_months(rows, path)
    rebuild_partitions(rows.where("competencia = '202401'"), ["202401"], path, layout=layout)
    again = rows.where("_ARQUIVO_ORIGEM = 'f3a'").withColumn("place", F.col("place") + 1)
    merge_partitions(again, path, layout=layout)
    assert sum(low <= 123 <= high for _, low, high in groups(path)) <= 3
    want = rows.where("_ARQUIVO_ORIGEM <> 'f3a'").unionByName(again)
    assert rows_of(read_months(spark, path).select(rows.columns)) == rows_of(want)


def test_nulls_empty_tables_and_rejects(spark, rows, tmp_path):
    path, layout = str(tmp_path / "t"), Layout(("place",), GROUP)
    assert write_months(rows.where("false"), path, layout=layout).rows == 0
    odd = rows.limit(50).withColumn("place", F.lit(None).cast("int")).unionByName(rows.limit(3).withColumn("competencia", F.lit("none")))
    done = write_months(odd, path, layout=layout)
    assert (done.rows, done.rejected) == (50, 3)


def test_published_tables_have_bounded_row_groups(spark, tmp_path):
    folder = publish_table(spark.range(5_000).coalesce(1), str(tmp_path / "t"), row_group_rows=1_000)
    (file,) = Path(folder).glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [1_000] * 5
