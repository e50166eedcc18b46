"""Ingest one source from its landing folder into the lake.

Landing folders hold the delivered files; the lake holds ``<folder>/<table>``
with the ledger of each table in it. Data is always written before the ledger, only
files that were read well enter it, and the earlier rows of a file that could
not be read stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.conform import union_by_name
from lakeward.operators.enrich import left_enrich
from lakeward.operators.ledger import (
    affected_periods,
    dedup_case_insensitive,
    ledger_record,
    ledger_replace_prefix,
    ledger_upsert,
    revision_diff,
)
from lakeward.operators.merge import merge_by_key
from lakeward.operators.names import NameRule, classify_names, rule_table
from lakeward.operators.catalogue import lake_tables
from lakeward.operators.partitions import BATCH_BYTES, drop_unlisted, merge_partitions, month_list, read_months, rebuild_with_ledger
from lakeward.operators.periods import check_window, latest_period, period_window
from lakeward.operators.sizing import join_small
from lakeward.plans import registry
from lakeward.session import settled, settled_observed
from lakeward.sinks.tables import (
    drop_old_versions,
    publish_counted,
    publish_text,
    read_ledger,
    read_published,
    update_ledger,
    write_csv,
)
from lakeward.sources.dbf import LINEAGE, read_headers, scan_dbf
from lakeward.sources.delimited import scan_csv_union_with_rejects, scan_delimited_files
from lakeward.sources.files import content_hashes, plain_path, scan_file_inventory
from lakeward.sources.json_arrays import YEAR_PATTERN, labelled_rows, population_rows, read_well, scan_answers, set_aside
from lakeward.sources.rawtext import scan_raw_text


@dataclass
class Outcome:
    """What a run wrote, how many rows, what was set aside (path, name, bytes, error), and how many
    rows because their key is no period."""

    changed: bool
    target: str
    rows: int | None = None
    rejected: DataFrame | None = None
    without_period: int = 0


def table_path(lake: str, folder: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{folder}/{table}"


def ledger_path(lake: str, folder: str, table: str) -> str:
    """Each table has a ledger of its own, so runs of different sources do not meet in one."""
    return f"{table_path(lake, folder, table)}/_ledger"


def delivered_files(spark: SparkSession, landing: str, rules: list[NameRule], by_content: bool = False) -> DataFrame:
    """Recognised dBASE files of a folder, one per name ignoring case, with the
    lineage and the period (month or year) that their rows will carry.

    Names follow the delivery pattern with either extension: the compressed
    form and the table inside it share one name. A file is told from its earlier
    self by its size, or `by_content`, which reads every byte but sees a revision of equal size.
    """
    files = scan_file_inventory(spark, landing, glob="*.[dD][bB][fF]")
    named = files.withColumn("key", F.regexp_replace(F.upper("name"), r"\.DBF$", ".DBC"))
    # Of a final and a preliminary file with one name, the final one counts.
    ranked = named.withColumn("preliminary", F.contains(F.upper("path"), F.lit("/PRELIM/")))
    unique = dedup_case_insensitive(ranked, "key", "preliminary", "path").drop("preliminary")
    known = classify_names(unique, rule_table(spark, rules), name="key")
    found = known.select(
        "*",
        F.col("bytes").alias("fingerprint"),
        F.col("key").alias(LINEAGE),
        F.coalesce("period", F.col("year").cast("string")).alias("competencia"),
    )
    if not by_content:
        return found
    hashes = content_hashes(spark, landing, glob="*.[dD][bB][fF]").select("path", F.xxhash64("md5").alias("fingerprint"))
    return found.drop("fingerprint").join(hashes, "path")


def _read_well(files: DataFrame, accepted: DataFrame) -> DataFrame:
    return files.join(accepted.select("path"), "path", "left_semi")


def _kept_rows(existing: DataFrame | None, files: DataFrame, rejected: DataFrame) -> DataFrame | None:
    """Earlier rows of the files that could not be read this time."""
    if existing is None:
        return None
    lost = files.join(rejected.select("path"), "path", "left_semi").select(F.upper(LINEAGE).alias("_lost")).distinct()
    return join_small(existing, lost, F.upper(LINEAGE), "_lost", "left_semi")


def ingest_merge(
    spark: SparkSession, landing: str, lake: str, folder: str, table: str, rule: NameRule,
    files: DataFrame | None = None, by_content: bool = False,
) -> Outcome:
    """New and changed files replace their own earlier rows; all others stay.

    The table is partitioned by the month or year of the file name, so that a
    delivery rewrites the periods it touches and not the whole series. `files` are the delivered files, where
    they are known already.
    """
    files = delivered_files(spark, landing, [rule], by_content) if files is None else files
    where = ledger_path(lake, folder, table)
    ledger = read_ledger(spark, where)
    todo = settled(files.join(revision_diff(files, ledger), "key", "left_semi"), "todo")
    target = table_path(lake, folder, table)
    if todo.isEmpty():
        return Outcome(False, target)
    scan = scan_dbf(todo, carry=(LINEAGE, "competencia"), order_by="competencia")
    done = settled(_read_well(todo, scan.accepted), "done")
    written = merge_partitions(scan.rows, target, delivered_files=done, clustered=True)
    update_ledger(spark, where, lambda now: ledger_record(now, todo, done))
    return Outcome(True, target, written.rows, scan.rejected, written.rejected)


def ingest_snapshot(spark: SparkSession, landing: str, lake: str, folder: str, table: str, rule: NameRule) -> Outcome:
    """All files of the latest month, whenever one of them is new or changed.

    A file of that month that cannot be read keeps the rows that the last version has of it; where
    none can be read the last version stays.
    """
    files = settled(latest_period(delivered_files(spark, landing, [rule]), "period"), "snapshot")
    where = ledger_path(lake, folder, table)
    ledger = read_ledger(spark, where)
    target = table_path(lake, folder, table)
    if revision_diff(files, ledger).isEmpty():
        return Outcome(False, target)
    scan = scan_dbf(files)
    done = settled(_read_well(files, scan.accepted).select("key", "fingerprint"), "done")
    if done.isEmpty():
        return Outcome(False, target, rejected=scan.rejected)
    kept = _kept_rows(read_published(spark, target), files, scan.rejected)
    rows = scan.rows if kept is None else union_by_name(kept, scan.rows, as_text=False)
    n_rows = publish_counted(rows, target)
    update_ledger(spark, where, lambda now: ledger_replace_prefix(now, rule.prefix, done))
    return Outcome(True, target, n_rows, scan.rejected)


def ingest_months(
    spark: SparkSession,
    landing: str,
    lake: str,
    table: str,
    rule: NameRule,
    margin: int = 0,
    batch_bytes: int = BATCH_BYTES,
    by_content: bool = False,
    **window: str,
) -> Outcome:
    """Rebuild the months with news (and a margin of recent ones), or of a window.

    A window is a backfill: it ignores ledger and margin. All headers are read at once; months go in batches of
    about `batch_bytes` of files, each of which is one job, then a ledger write. A file
    that cannot be read keeps its earlier rows.
    """
    check_window(**window)
    files, seen = settled_observed(delivered_files(spark, landing, [rule], by_content), "files", bytes=F.sum("bytes"))
    where = ledger_path(lake, table, table)
    target = table_path(lake, table, table)
    if window:
        months = month_list(period_window(files, **window), "competencia")
    else:
        ledger = read_ledger(spark, where)
        changed = month_list(affected_periods(files, ledger, "competencia"), "competencia")
        more = margin and changed
        months = month_list(affected_periods(files, ledger, "competencia", margin), "competencia") if more else changed
    if not months:
        return Outcome(False, target)
    asked = files.where(F.col("competencia").isin(months))
    headers = read_headers(asked)

    def rows_of(part: list[str]) -> tuple[DataFrame, DataFrame | None]:
        todo = asked.where(F.col("competencia").isin(part))
        scan = scan_dbf(todo, carry=(LINEAGE, "competencia"), order_by="competencia", headers=headers)
        if not headers.n_rejected:
            return scan.rows, None
        kept = _kept_rows(read_months(spark, target, months=part), todo, scan.rejected)
        rows = scan.rows if kept is None else union_by_name(scan.rows, kept, as_text=False)
        return rows, _read_well(todo, scan.accepted)

    written = rebuild_with_ledger(
        rows_of, asked, months, target, where, batch_bytes=batch_bytes, clustered=True, total_bytes=seen["bytes"] or 0
    )
    return Outcome(True, target, written.rows, headers.rejected, written.rejected)


def _all_files(spark: SparkSession, landing: str, glob: str) -> DataFrame:
    files = scan_file_inventory(spark, landing, glob=glob).withColumn("key", F.upper("name"))
    return settled(files.withColumn("fingerprint", F.col("bytes")), "listing")


def _paths(files: DataFrame) -> list[str]:
    """Paths for a reader that takes a list: yearly answers and single files."""
    return [row["path"] for row in files.select("path").orderBy("path").collect()]


def ingest_years(
    spark: SparkSession, landing: str, lake: str, folder: str, table: str, glob: str, year: str = YEAR_PATTERN
) -> Outcome:
    """Yearly answers replace their own year; an answer that tells nothing about its year is set aside.

    `year` is the pattern of the year in a path.
    """
    where = ledger_path(lake, folder, table)
    ledger = read_ledger(spark, where)
    files = _all_files(spark, landing, glob)
    todo = files.join(revision_diff(files, ledger), "key", "left_semi")
    target = table_path(lake, folder, table)
    paths = _paths(todo)
    if not paths:
        return Outcome(False, target)
    answers = settled(scan_answers(spark, paths, year), "answers")
    good, rejected = read_well(answers), set_aside(answers)
    if good.isEmpty():
        return Outcome(False, target, rejected=rejected)
    rows = population_rows(good) if table == "populacao_estimada" else labelled_rows(good)
    # A year that came without rows still replaces its old rows.
    existing = read_published(spark, target)
    merged = merge_by_key(existing, rows, "ANO", delivered_keys=good.select("ANO"), as_text=False)
    n_rows = publish_counted(merged, target)
    bad = rejected.select(plain_path(F.col("path")).alias("path"))
    same = F.regexp_replace("path", "^file:/+", "file:/")
    done = todo.withColumn("path", same).join(bad.withColumn("path", same), "path", "left_anti")
    update_ledger(spark, where, lambda now: ledger_record(now, todo, done))
    return Outcome(True, target, n_rows, rejected)


def _whole(
    spark: SparkSession, landing: str, lake: str, folder: str, table: str, encoding: str, finish=lambda rows: rows
) -> Outcome:
    """All current files of a folder, read again when one of them changed.

    Malformed lines are set aside. A file that cannot be read at all leaves table and ledger as they are.
    """
    where = ledger_path(lake, folder, table)
    ledger = read_ledger(spark, where)
    files = _all_files(spark, landing, "*.csv")
    target = table_path(lake, folder, table)
    if revision_diff(files, ledger).isEmpty():
        return Outcome(False, target)
    rows, aside = scan_delimited_files(spark, files, encoding=encoding)
    rejected = settled(aside, "rejected")
    unread = rejected.where(~F.startswith("error", F.lit("malformed line")))
    if rows is None or not unread.isEmpty():
        return Outcome(False, target, rejected=rejected)
    n_rows = publish_counted(finish(rows), target)
    update_ledger(spark, where, lambda now: ledger_upsert(now, files))
    return Outcome(True, target, n_rows, rejected)


def ingest_delimited(spark: SparkSession, landing: str, lake: str, folder: str, table: str) -> Outcome:
    """The establishments, whole."""
    return _whole(spark, landing, lake, folder, table, "ISO-8859-1")


def ingest_macro_regions(spark: SparkSession, landing: str, places: DataFrame, lake: str) -> Outcome:
    """Municipalities with their region and the coordinates of `places` (MUNCOD, ...)."""
    return _whole(
        spark, landing, lake, "geo", "macroregiao_de_saude", "UTF-8",
        lambda regions: left_enrich(regions, places, "cod_municipio", "MUNCOD"),
    )


def ingest_text(spark: SparkSession, path: str, lake: str, folder: str, table: str) -> Outcome:
    """Raw microdata, one file or a folder of parts, published again when their size changed."""
    where = ledger_path(lake, folder, table)
    ledger = read_ledger(spark, where)
    size = scan_file_inventory(spark, path).agg(F.sum("bytes").alias("fingerprint")).where("fingerprint is not null")
    files = size.select(F.lit(table.upper()).alias("key"), "fingerprint")
    target = table_path(lake, folder, table)
    if revision_diff(files, ledger).isEmpty():
        return Outcome(False, target)
    publish_text(scan_raw_text(spark, path), target)
    update_ledger(spark, where, lambda now: ledger_upsert(now, files))
    return Outcome(True, target)


# Landing folder, output and whether the municipality column goes.
BUDGET_FOLDERS = [
    ("csv_siops_subfuncao", "raw_siops_exec_saude.csv", True),
    ("csv_siops_rreo", "raw_siops_exec_rreo.csv", True),
    ("csv_siops_indicador", "raw_siops_indicadores.csv", False),
]


def consolidate_folder(spark: SparkSession, landing: str, drop: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One table of all CSV files of a folder, without one column if asked, and the files set aside."""
    rows, rejected = scan_csv_union_with_rejects(spark, landing)
    return (rows.drop(drop) if drop else rows), rejected


def ingest_budget(spark: SparkSession, landing: str, output: str) -> list[Outcome]:
    """Each folder as one CSV table, from the files that can be read; the target is the version written."""
    outcomes = []
    for folder, name, without_place in BUDGET_FOLDERS:
        rows, rejected = consolidate_folder(spark, f"{landing}/{folder}", "municipio" if without_place else None)
        outcomes.append(Outcome(True, write_csv(rows, f"{output}/{name}"), rejected=rejected))
    return outcomes


def ingest_diseases(spark: SparkSession, landing: str, lake: str, folder: str) -> list[Outcome]:
    """One table per disease, from one listing; diseases without a file are left alone."""
    rules = registry.disease_rules()
    files = settled(delivered_files(spark, landing, rules), "files")
    present = {row[0] for row in files.select("source").distinct().collect()}
    return [
        ingest_merge(spark, landing, lake, folder, rule.source, rule, files.where(F.col("source") == rule.source))
        if rule.source in present
        else Outcome(False, table_path(lake, folder, rule.source))
        for rule in rules
    ]


def tidy_lake(spark: SparkSession, lake: str, keep: int = 2) -> int:
    """Delete what no reader needs any more: versions but the `keep` latest, and months that no list names.

    For times without readers. Returns how many folders went.
    """
    gone = 0
    for path in lake_tables(spark, lake):
        for versioned in (path, f"{path}/_ledger", f"{path}/_months", f"{path}/_spans"):
            gone += drop_old_versions(spark, versioned, keep)
        gone += drop_unlisted(spark, path)
    return gone


def ingest(spark: SparkSession, source_id: str, landing: str, lake: str, **options) -> list[Outcome]:
    """Ingest one registered source; diseases give one outcome per table."""
    source = registry.get_source(source_id)
    where = (spark, landing, lake, source.pasta, source.table)
    if source_id == "sinan":
        return ingest_diseases(spark, landing, lake, source.pasta)
    if source.way == registry.MERGE:
        return [ingest_merge(*where, source.rule, **options)]
    if source.way == registry.SNAPSHOT:
        return [ingest_snapshot(*where, source.rule)]
    if source.way == registry.MONTHS:
        return [ingest_months(spark, landing, lake, source.table, source.rule, **options)]
    if source.way == registry.YEARS:
        glob = "populacao_*.json" if source_id == "ibge_populacao" else "pib_*.json"
        return [ingest_years(*where, glob)]
    if source.way == registry.TEXT:
        return [ingest_text(*where)]
    if source_id == "macroregiao":
        return [ingest_macro_regions(spark, landing, options["places"], lake)]
    return [ingest_delimited(*where)]
