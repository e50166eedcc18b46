"""Merges, ledgers and rebuilt months: properties and edge cases."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeward.operators import ledger as led
from lakeward.operators.merge import merge_by_key
from lakeward.operators.partitions import (
    drop_unlisted,
    merge_partitions,
    month_folders,
    read_months,
    read_rejects,
    rebuild_partitions,
    rebuild_with_ledger,
    write_by_year,
    write_months,
)
from lakeward.operators.periods import recent_or_unknown, top_n_periods
from lakeward.sinks.tables import drop_old_versions, publish_table, read_ledger, read_published, version_path, versions, write_ledger
from tests.conftest import rows_of

KEY = "_ARQUIVO_ORIGEM"
quick = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
tables = st.lists(st.tuples(st.sampled_from(["A.dbc", "a.DBC", "B.dbc", "C.dbc", None]), st.integers(0, 9)), max_size=12)
ledgers = st.dictionaries(st.sampled_from(["A", "b", "C", "pre1", "PRE2", "d"]), st.integers(0, 3), max_size=6)


def sources(spark, rows):
    return spark.createDataFrame([(k, str(v)) for k, v in rows], f"{KEY} string, v string")


@quick
@given(old=tables, new=tables)
def test_merge_is_delete_then_insert(spark, old, new):
    got = rows_of(merge_by_key(sources(spark, old), sources(spark, new)))
    gone = {k.upper() for k, _ in new if k}
    want = [(k, str(v)) for k, v in old if k and k.upper() not in gone] + [(k, str(v)) for k, v in new]
    assert got == sorted(want, key=repr)


def test_merge_laws(spark):
    old = sources(spark, [("A.dbc", 1), ("B.dbc", 2), ("B.dbc", 2)])
    new = sources(spark, [("b.dbc", 7)])
    none = sources(spark, [])
    assert rows_of(merge_by_key(old, none)) == rows_of(old)
    assert rows_of(merge_by_key(None, new)) == rows_of(new)
    once = merge_by_key(old, new)
    assert rows_of(merge_by_key(once, new)) == rows_of(once)
    other = sources(spark, [("C.dbc", 3)])
    assert rows_of(merge_by_key(old, other)) == rows_of(old.union(other))


def test_merge_keeps_failed_and_empties_delivered_units(spark):
    old = sources(spark, [("FAILED.dbc", 1), ("EMPTY.dbc", 2), ("OK.dbc", 3)])
    new = sources(spark, [("OK.dbc", 9)])
    keys = spark.createDataFrame([("OK.dbc",), ("EMPTY.dbc",)], f"{KEY} string")
    assert rows_of(merge_by_key(old, new, delivered_keys=keys)) == [("FAILED.dbc", "1"), ("OK.dbc", "9")]


def ledger_frame(spark, entries):
    return spark.createDataFrame(list(entries.items()), "key string, fingerprint bigint")


def upper(entries):
    return {k.upper(): v for k, v in entries.items()}


@quick
@given(now=ledgers, before=ledgers)
def test_diff_against_python(spark, now, before):
    current, known = ledger_frame(spark, now), ledger_frame(spark, before)
    a, b = upper(now), upper(before)
    diff = dict(tuple(r) for r in led.revision_diff(current, known).collect())
    assert diff == {k: "changed" if k in b else "new" for k in a if a[k] != b.get(k)}
    actions = dict(tuple(r) for r in led.snapshot_sync(current, known).collect())
    want = {k: "reuse" if a[k] == b.get(k) else "download" for k in a} | {k: "orphan" for k in b if k not in a}
    assert actions == want
    assert led.any_changed(current, known).first()[0] == bool(diff)
    joined = dict(tuple(r) for r in led.ledger_upsert(known, current).collect())
    assert joined == b | a
    swapped = dict(tuple(r) for r in led.ledger_replace_prefix(known, "Pre", current).collect())
    assert swapped == {k: v for k, v in b.items() if not k.startswith("PRE")} | a
    after = led.ledger_upsert(known, current)
    assert not led.any_changed(current, after).first()[0]


def test_null_fingerprint_counts_as_a_value(spark):
    current = spark.createDataFrame([("a", None), ("b", 1)], "key string, fingerprint bigint")
    known = spark.createDataFrame([("A", None), ("B", None)], "key string, fingerprint bigint")
    assert rows_of(led.revision_diff(current, known)) == [("B", "changed")]


def test_affected_months_and_margin(spark):
    files = spark.createDataFrame(
        [("PA1", "202001", 1), ("PA2", "202002", 2), ("PA3", "202003", 3), ("PA4", "202004", 4)],
        "key string, period string, fingerprint bigint",
    )
    known = spark.createDataFrame([("pa1", 1), ("PA2", 99), ("PA4", 4)], "key string, fingerprint bigint")
    assert rows_of(led.affected_periods(files, known, "period")) == [("202002",), ("202003",)]
    assert rows_of(led.affected_periods(files, known, "period", margin=1)) == [("202002",), ("202003",), ("202004",)]
    assert top_n_periods(files, "period", 0).count() == 0
    recent = recent_or_unknown(files, known, "key", "period", n=1)
    assert {r["key"] for r in recent.collect()} == {"PA3", "PA4"}


def test_dedup_keeps_the_first(spark):
    names = spark.createDataFrame([("X.dbc", 2), ("X.DBC", 1), ("y.dbc", 3), ("y.dbc", 3)], "name string, n int")
    assert rows_of(led.dedup_case_insensitive(names, "name")) == [("X.DBC", 1), ("y.dbc", 3)]
    assert rows_of(led.dedup_case_insensitive(names, "name", "n")) == [("X.DBC", 1), ("y.dbc", 3)]


def months(spark, rows):
    return spark.createDataFrame(rows, f"competencia string, {KEY} string, v string")


def digests(path):
    return {
        str(p.relative_to(path)): hashlib.md5(p.read_bytes()).hexdigest()
        for p in Path(path).rglob("*.parquet")
    }


def test_rebuild_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    write_months(months(spark, [("202001", "a", "1"), ("202002", "b", "2"), ("202003", "c", "3")]), path)
    before = digests(path)
    rebuild_partitions(months(spark, [("202002", "b", "20"), ("202001", "a", "99")]), ["202002", "202003"], path)
    after = digests(path)
    untouched = {k for k in before if "202001" in k}
    assert untouched and all(after[k] == before[k] for k in untouched)
    assert {(r["competencia"], r["v"]) for r in read_months(spark, path).collect()} == {("202001", "1"), ("202002", "20")}


def test_merge_partitions_by_source(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_partitions(months(spark, [("202001", "A1", "1"), ("202001", "A2", "2"), ("202002", "B1", "3")]), path)
    before = digests(path)
    delivered = months(spark, [("202001", "a1", "10"), ("202003", "C1", "4")])
    merge_partitions(delivered, path)
    merge_partitions(delivered, path)
    got = {(r["competencia"], r[KEY], r["v"]) for r in read_months(spark, path).collect()}
    assert got == {("202001", "a1", "10"), ("202001", "A2", "2"), ("202002", "B1", "3"), ("202003", "C1", "4")}
    assert all(digests(path)[k] == v for k, v in before.items() if "202002" in k)
    # A file that came without rows takes its old rows away, and with them its month.
    files = spark.createDataFrame([("C1", "202003")], f"{KEY} string, competencia string")
    merge_partitions(delivered.where("false"), path, delivered_files=files)
    assert "202003" not in {r["competencia"] for r in read_months(spark, path).collect()}


def test_a_merge_that_stops_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    from lakeward.operators import partitions

    path = str(tmp_path / "t")
    merge_partitions(months(spark, [("202001", "A1", "1"), ("202001", "A2", "2"), ("202002", "B1", "3")]), path)
    planned = read_months(spark, path)
    before = rows_of(planned)

    def dies(*args):
        raise RuntimeError("lost")

    real = partitions._publish_list
    monkeypatch.setattr(partitions, "_publish_list", dies)
    with pytest.raises(RuntimeError):
        merge_partitions(months(spark, [("202001", "A1", "10"), ("202003", "C1", "4")]), path)
    monkeypatch.setattr(partitions, "_publish_list", real)
    assert rows_of(read_months(spark, path)) == before and month_folders(spark, path) == ["202001", "202002"]
    merge_partitions(months(spark, [("202003", "C1", "4")]), path)
    assert rows_of(read_months(spark, path)) == sorted([*before, ("C1", "4", "202003")])
    # A reader that planned before sees the state of that time; what no list names can go afterwards.
    assert rows_of(planned) == before
    assert drop_unlisted(spark, path) == 2
    assert rows_of(read_months(spark, path)) == sorted([*before, ("C1", "4", "202003")])


def test_rows_without_a_period_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "t")
    written = merge_partitions(months(spark, [("202401", "A", "1"), (None, "B", "2"), ("2024-02", "C", "3")]), path)
    assert (written.rows, written.rejected) == (1, 2)
    written = merge_partitions(months(spark, [("202401", "a", "4"), ("x", "D", "5")]), path)
    assert (written.rows, written.rejected) == (1, 1)
    assert rows_of(read_months(spark, path)) == [("a", "4", "202401")]
    assert rows_of(read_rejects(spark, path).select("v", "competencia")) == [("2", None), ("3", "2024-02"), ("5", "x")]
    again = rebuild_partitions(months(spark, [("202401", "a", "6"), ("", "E", "7")]), ["202401"], path)
    assert (again.rows, again.rejected) == (1, 1)
    assert merge_partitions(months(spark, [(None, "F", "8")]), path).rejected == 1
    assert read_rejects(spark, str(tmp_path / "none")) is None


def test_eras_with_other_types_fail(spark, tmp_path):
    path = str(tmp_path / "t")
    write_months(months(spark, [("202001", "a", "1")]), path)
    # A list of months that nobody could read as one table is not published.
    with pytest.raises(TypeError):
        write_months(months(spark, [("202002", "a", "1")]).withColumn("v", F.col("v").cast("int")), path)
    assert read_months(spark, path).dtypes[1] == ("v", "string") and month_folders(spark, path) == ["202001"]


def test_ledger_follows_the_data(spark, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    keys = [f"2020{m:02d}" for m in range(1, 6)]
    rows = months(spark, [(k, k, "x") for k in keys])
    files = spark.createDataFrame([(f"f{k}", 1, 10, k) for k in keys], "key string, fingerprint bigint, bytes bigint, competencia string")
    from lakeward.operators import partitions

    assert partitions.month_batches(files, keys, "competencia", 20) == [keys[:2], keys[2:4], keys[4:]]
    assert partitions.month_batches(files, keys, "competencia", 5) == [[k] for k in keys]
    assert partitions.month_batches(files, keys, "competencia") == [keys]
    real = partitions.rebuild_partitions
    seen = []

    def stops(read, part, *rest, **more):
        if seen:
            raise RuntimeError("stopped")
        seen.append(part)
        return real(read, part, *rest, **more)

    rows_of_batch = lambda part: (rows, files.where(F.col("competencia").isin(part)))
    monkeypatch.setattr(partitions, "rebuild_partitions", stops)
    with pytest.raises(RuntimeError):
        rebuild_with_ledger(rows_of_batch, files, keys, path, ledger, batch_bytes=20)
    assert {r["key"] for r in read_ledger(spark, ledger).collect()} == {"F202001", "F202002"}
    monkeypatch.setattr(partitions, "rebuild_partitions", real)
    left = led.affected_periods(files, read_ledger(spark, ledger), "competencia")
    assert {r[0] for r in left.collect()} == set(keys[2:])
    rebuild_with_ledger(rows_of_batch, files, keys[2:], path, ledger, batch_bytes=20)
    assert read_ledger(spark, ledger).count() == 5 and read_months(spark, path).count() == 5


def test_year_layout(spark, tmp_path):
    path = str(tmp_path / "y")
    write_by_year(months(spark, [("201912", "a", "1"), ("202001", "b", "2")]), path)
    assert (Path(path) / "ano=2019" / "competencia=201912").is_dir()


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert read_published(spark, path) is None
    publish_table(spark.range(3).toDF("v"), path)
    publish_table(read_published(spark, path).withColumn("v", F.col("v") + 1), path)
    assert rows_of(read_published(spark, path)) == [(1,), (2,), (3,)]
    # A version whose job never finished is not read, and its number is not used again.
    unfinished = Path(version_path(path, 3))
    unfinished.mkdir()
    assert rows_of(read_published(spark, path)) == [(1,), (2,), (3,)]
    publish_table(spark.range(1).toDF("v"), path)
    assert versions(spark, path) == [1, 2, 4]
    assert drop_old_versions(spark, path, keep=1) == 2 and versions(spark, path) == [4]


def test_ledger_round_trip(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert read_ledger(spark, path).count() == 0
    write_ledger(ledger_frame(spark, {"A": 1, "B": 2}), path)
    assert rows_of(read_ledger(spark, path)) == [("A", 1), ("B", 2)]
