"""Two runs that write one table, and tables that no reader could read."""

from __future__ import annotations

import pytest

from lakeward.operators import partitions
from lakeward.operators.ledger import ledger_upsert
from lakeward.operators.partitions import ConcurrentWrite, merge_partitions, read_months, read_rejects, write_months
from lakeward.sinks import tables
from lakeward.sinks.tables import claim, publish_after, publish_table, read_ledger, read_published, update_ledger, update_published
from tests.conftest import rows_of


def months(spark, *rows):
    return spark.createDataFrame(list(rows), "n int, _ARQUIVO_ORIGEM string, competencia string")


@pytest.fixture
def meanwhile(monkeypatch):
    """Run something between the moment a run has written its data and the one it publishes its list."""

    def arrange(other):
        real, todo = partitions._publish_list, [other]

        def late(*args):
            if todo:
                todo.pop()()
            real(*args)

        monkeypatch.setattr(partitions, "_publish_list", late)

    return arrange


def test_two_writers_of_different_months_both_stay(spark, tmp_path, meanwhile):
    path = str(tmp_path / "t")
    write_months(months(spark, (1, "a", "202401")), path)
    meanwhile(lambda: write_months(months(spark, (3, "c", "202403"), (9, "c", "no month")), path))
    write_months(months(spark, (2, "b", "202402"), (8, "b", "none")), path)
    assert rows_of(read_months(spark, path)) == [(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202403")]
    assert rows_of(read_rejects(spark, path).select("n")) == [(8,), (9,)]
    assert partitions.drop_unlisted(spark, path) == 0


def test_a_month_that_another_run_wrote_meanwhile_is_not_lost(spark, tmp_path, meanwhile):
    path = str(tmp_path / "t")
    write_months(months(spark, (1, "a", "202401")), path)
    meanwhile(lambda: merge_partitions(months(spark, (2, "b", "202401")), path))
    with pytest.raises(ConcurrentWrite, match="202401"):
        merge_partitions(months(spark, (3, "c", "202401")), path)
    merge_partitions(months(spark, (3, "c", "202401")), path)
    assert rows_of(read_months(spark, path).select("n")) == [(1,), (2,), (3,)]


def test_a_type_clash_fails_before_the_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    write_months(months(spark, (1, "a", "202401")), path)
    text = months(spark, (2, "b", "202402")).withColumn("n", partitions.F.lit("x"))
    for write in (lambda: write_months(text, path), lambda: merge_partitions(text, path)):
        with pytest.raises(TypeError, match="column n is int and string|column n is string and int"):
            write()
        assert rows_of(read_months(spark, path)) == [(1, "a", "202401")]
    # The only month may change its type.
    write_months(text.withColumn("competencia", partitions.F.lit("202401")), path)
    assert [r["n"] for r in read_months(spark, path).collect()] == ["x"]


def test_two_ledgers_at_once(spark, tmp_path):
    path = str(tmp_path / "l")
    row = lambda key: spark.createDataFrame([(key, 1)], "key string, fingerprint bigint")
    update_ledger(spark, path, lambda now: ledger_upsert(now, row("A")))
    todo = ["B"]

    def change(now):
        if todo:
            update_ledger(spark, path, lambda n: ledger_upsert(n, row(todo.pop())))
        return ledger_upsert(now, row("C"))

    update_ledger(spark, path, change)
    assert rows_of(read_ledger(spark, path)) == [("A", 1), ("B", 1), ("C", 1)]


def test_a_claim_of_a_run_that_died_is_taken_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    one, two = (spark.createDataFrame([(n,)], "n int") for n in (1, 2))
    update_published(spark, path, lambda now: one)
    assert claim(spark, tables._claim_of(path, 2)) and not claim(spark, tables._claim_of(path, 2))
    assert not publish_after(two, path, 1)  # begun by another run, which may still come
    monkeypatch.setattr(tables, "GIVEN_UP", -1)
    assert publish_after(two, path, 1)
    assert rows_of(read_published(spark, path)) == [(2,)]
    assert not publish_after(one, path, 1)  # it is there
    publish_table(one, path)
    assert tables.drop_old_versions(spark, path, 1) == 2
    assert rows_of(read_published(spark, path)) == [(1,)]
