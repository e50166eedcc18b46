"""Reports over files and months: counts, totals, coverage and gaps."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeward.functions.periods import month_key, month_label, year_of_key, year_span
from lakeward.functions.report import local_time
from lakeward.functions.text import top_folder
from lakeward.operators.enrich import UNMAPPED, first_substring_match
from lakeward.operators.partitions import current_months
from lakeward.operators.periods import calendar
from lakeward.session import settled, small_table
from lakeward.sinks.tables import hadoop_path, latest_version
from lakeward.sources.files import scan_file_inventory, scan_row_counts


# Names of one period in one text: state and part letter bound well-formed ones far below this.
MOST_NAMES = 100_000


def group_files(inventory: DataFrame, period: str, name: str = "name") -> DataFrame:
    """Files of each period in one sorted, comma-separated text.

    Case copies and repeated names count once in the text. A period of more than MOST_NAMES
    rows is no month of files, and fails before its names are gathered.
    """
    sizes = inventory.groupBy(period).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if sizes and sizes > MOST_NAMES:
        raise ValueError(f"a period has {sizes} files")
    return inventory.groupBy(period).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.array_join(F.sort_array(F.collect_set(name)), ",").alias("files"),
    )


def _months(inventory: DataFrame, period: str) -> DataFrame:
    """One row per month: files, rows, bytes, latest change. Small, and all that
    the yearly reports need."""
    return inventory.where(F.col(period).isNotNull()).groupBy(period).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("bytes").cast("bigint").alias("bytes"),
        F.max("mtime").alias("mtime"),
    )


def yearly_profile(inventory: DataFrame, period: str, zone: str | None = None) -> DataFrame:
    """Per year, latest first: files, latest month, rows, running total, latest change.

    The window has no partition, but sees one row per year only.
    """
    years = _months(inventory, period).groupBy(year_of_key(period).alias("ano")).agg(
        F.sum("files").cast("bigint").alias("num_arquivos"),
        month_label(F.max(period)).alias("ultima_competencia"),
        F.sum("rows").cast("bigint").alias("num_registros"),
        F.max("mtime").alias("mtime"),
    )
    so_far = Window.orderBy("ano").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return years.select(
        "ano",
        "num_arquivos",
        "ultima_competencia",
        "num_registros",
        F.sum("num_registros").over(so_far).cast("bigint").alias("registros_acumulado"),
        local_time("mtime", zone).alias("ultima_atualizacao"),
    ).orderBy(F.desc("ano"))


def grand_summary(inventory: DataFrame, period: str, zone: str | None = None) -> DataFrame:
    months = _months(inventory, period)
    first, last = F.min(period), F.max(period)
    return months.agg(
        F.sum("files").cast("bigint").alias("total_arquivos"),
        F.count(F.lit(1)).alias("total_competencias"),
        F.sum("rows").cast("bigint").alias("total_registros"),
        F.sum("bytes").cast("bigint").alias("total_bytes"),
        first.alias("primeira_competencia"),
        last.alias("ultima_competencia"),
        year_span(first, last).alias("anos_cobertos"),
        local_time(F.max("mtime"), zone).alias("ultima_atualizacao"),
    )


def _missing_text() -> Column:
    return F.array_join(F.sort_array(F.collect_list("mes_faltante")), ",")


def coverage_with_total(inventory: DataFrame, period: str) -> DataFrame:
    """Files, months, bytes and missing months of every year from first to last,
    years without any shown as zero, and a total row with a null year."""
    months = _months(inventory, period)
    grid = calendar(months, period)
    key = month_key("ano", "mes")
    cells = grid.join(months, key == F.col(period), "left")
    years = cells.rollup("ano").agg(
        F.coalesce(F.sum("files"), F.lit(0)).cast("bigint").alias("arquivos"),
        F.count("files").alias("meses"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(F.col("files").isNull(), F.format_string("%02d", "mes")))), ","
        ).alias("missing"),
    )
    partial = F.col("ano").isNotNull() & (F.col("meses") > 0) & (F.col("missing") != "")
    return years.select(
        "ano",
        "arquivos",
        "meses",
        "bytes",
        F.when(partial, F.concat(F.lit("meses "), F.col("missing"))).otherwise("").alias("faltantes"),
    ).orderBy(F.col("ano").asc_nulls_last())


def coverage_gaps(df: DataFrame, period: str) -> DataFrame:
    """Months 01-12 missing inside years that have something: (ano, missing)."""
    present = df.where(F.col(period).isNotNull()).select(period).distinct()
    years = present.select(year_of_key(period).alias("ano")).distinct()
    expected = years.select(
        "ano", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes")
    ).withColumn("expected", month_key("ano", "mes"))
    absent = expected.join(present, F.col("expected") == F.col(period), "left_anti")
    return absent.withColumn("mes_faltante", F.format_string("%02d", "mes")).groupBy("ano").agg(
        _missing_text().alias("missing")
    )


def period_extent(inventory: DataFrame, group: str, period: str) -> DataFrame:
    """Per group: files, first and last year, first and last month."""
    per_month = inventory.where(F.col(period).isNotNull()).groupBy(group, period).agg(
        F.count(F.lit(1)).alias("n")
    )
    first, last = F.min(period), F.max(period)
    return per_month.groupBy(group).agg(
        F.sum("n").cast("bigint").alias("n_files"),
        year_of_key(first).alias("first_year"),
        year_of_key(last).alias("last_year"),
        first.alias("first_period"),
        last.alias("last_period"),
    )


def lake_tables(spark: SparkSession, lake: str) -> list[str]:
    """Paths of the tables of a lake: the folders below its folders."""
    system, root = hadoop_path(spark, lake)
    folders = [f.getPath() for f in system.listStatus(root) if f.isDirectory()] if system.exists(root) else []
    return [t.getPath().toString() for f in folders for t in system.listStatus(f) if t.isDirectory()]


def lake_folders(spark: SparkSession, lake: str) -> DataFrame:
    """(tabela, path, competencia) of the folders that hold the current state of each table of a lake.

    A table is a folder below the lake's folders: its latest committed version, or the months that its
    list names. Older versions, unfinished ones and ledgers are left out. One row per table and
    month, which the registry and the calendar bound.
    """
    rows = []
    for path in lake_tables(spark, lake):
        table = "/".join(path.rsplit("/", 2)[1:])
        for month, where in current_months(spark, path).items():
            rows.append({"tabela": table, "path": where, "competencia": month})
        latest = latest_version(spark, path)
        if latest:
            rows.append({"tabela": table, "path": latest, "competencia": None})
    return small_table(spark, rows, pa.schema([(c, pa.string()) for c in ("tabela", "path", "competencia")]))


def lake_inventory(spark: SparkSession, lake: str) -> DataFrame:
    """One row per current data file of a lake: tabela, competencia, path, name, bytes, mtime and rows (null for text)."""
    folders = [(r["tabela"], r["path"], r["competencia"]) for r in lake_folders(spark, lake).collect()]
    paths = [path for _, path, _ in folders]
    known = small_table(
        spark, [{"folder": p.split(":", 1)[-1].replace("//", "/"), "tabela": t, "competencia": m} for t, p, m in folders],
        pa.schema([(c, pa.string()) for c in ("folder", "tabela", "competencia")]),
    )
    if not paths:
        return small_table(spark, [], pa.schema([(c, pa.string()) for c in ("tabela", "competencia", "path", "name")])).select(
            "*", F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("mtime"), F.lit(0).cast("bigint").alias("rows")
        )
    files = with_rows(spark, scan_file_inventory(spark, paths), paths)
    inner = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:", ""), "^/+", "/")
    placed = files.withColumn("folder", F.regexp_replace(inner, "/[^/]*$", ""))
    return placed.join(F.broadcast(known), "folder").drop("folder")


def with_rows(spark: SparkSession, files: DataFrame, paths: str | list[str]) -> DataFrame:
    """An inventory with the rows of its Parquet files, from their footers; null for other files.

    A count that belongs to no listed file is an error, not a zero elsewhere.
    """
    tables = files.where(F.endswith("name", F.lit(".parquet")))
    # Without any Parquet file there is no footer to take a schema from.
    if tables.isEmpty():
        return files.withColumn("rows", F.lit(None).cast("bigint"))
    counts = scan_row_counts(spark, paths).withColumnRenamed("path", "_counted")
    both = files.join(counts, F.col("path") == F.col("_counted"), "full")
    strange = F.raise_error(F.concat(F.lit("rows of a file that is not listed: "), F.col("_counted")))
    rows = F.when(F.endswith("name", F.lit(".parquet")), F.coalesce("rows", F.lit(0))).cast("bigint")
    return both.withColumn("rows", F.when(F.col("path").isNull(), strange.cast("bigint")).otherwise(rows)).drop("_counted")


def _described(
    files: DataFrame, fragments: list[tuple[str, str]], sources: DataFrame, folder_sources: dict[str, str] | None
) -> DataFrame:
    """Files (arquivo, diretorio, ...) with the name and description of their source."""
    fallback = F.lit(None).cast("string")
    for folder, source in (folder_sources or {}).items():
        fallback = F.when(F.col("diretorio") == folder, F.lit(source)).otherwise(fallback)
    known = files.withColumn("id", F.coalesce(first_substring_match("arquivo", fragments), fallback))
    return known.join(sources, "id", "left").select(
        "arquivo",
        "diretorio",
        F.coalesce("nome", F.lit(UNMAPPED)).alias("nome_fonte"),
        F.coalesce("descricao", F.lit(UNMAPPED)).alias("descricao"),
        F.col("bytes").alias("tamanho_bytes"),
        F.col("rows").alias("num_registros"),
        local_time("mtime").alias("ultima_atualizacao"),
        *[c for c in ("tabela", "competencia") if c in files.columns],
    )


def file_catalogue(
    spark: SparkSession,
    root: str,
    fragments: list[tuple[str, str]],
    sources: DataFrame,
    folder_sources: dict[str, str] | None = None,
    leave_out: tuple[str, ...] = (),
) -> DataFrame:
    """One row per file below `root`, with its source, size, rows and time.

    `fragments` map parts of a file path to a source id, first match first;
    `folder_sources` map a folder to the id used where nothing matched. `sources`
    has id, nome and descricao. Text files have no row count.
    """
    base = root.rstrip("/") + "/"
    files = with_rows(spark, scan_file_inventory(spark, root), root)
    relative = F.regexp_replace(F.substring_index("path", base, -1), "^/+", "")
    files = files.withColumn("arquivo", relative).withColumn("diretorio", top_folder("arquivo"))
    for prefix in leave_out:
        files = files.where(~F.startswith("arquivo", F.lit(prefix)))
    return _described(files, fragments, sources, folder_sources).orderBy("arquivo")


@dataclass
class LakeReports:
    """The files of the lake's tables, the same by table, and three reports on the monthly table."""

    files: DataFrame
    tables: DataFrame
    profile: DataFrame
    summary: DataFrame
    coverage: DataFrame


def lake_reports(
    spark: SparkSession,
    lake: str,
    monthly: str,
    fragments: list[tuple[str, str]],
    sources: DataFrame,
    folder_sources: dict[str, str] | None = None,
) -> LakeReports:
    """All published reports of a lake, from one listing of its current files.

    The table `monthly` (folder/table) is too long for the file catalogue and has reports by year of its own.
    """
    files = settled(lake_inventory(spark, lake), "inventory")
    others = files.where(F.col("tabela") != monthly)
    named = others.withColumn("arquivo", F.concat("tabela", F.lit("/"), "name")).withColumn("diretorio", top_folder("tabela"))
    catalogue = settled(_described(named, fragments, sources, folder_sources), "catalogue")
    months = files.where(F.col("tabela") == monthly)
    return LakeReports(
        catalogue.drop("tabela", "competencia").orderBy("arquivo"),
        table_catalogue(catalogue),
        yearly_profile(months, "competencia"),
        grand_summary(months, "competencia"),
        coverage_with_total(months, "competencia"),
    )


def table_catalogue(catalogue: DataFrame) -> DataFrame:
    """The files of current tables by table: files, bytes and rows; rows are null for text."""
    return (
        catalogue.groupBy("tabela", "diretorio", "nome_fonte", "descricao")
        .agg(
            F.count(F.lit(1)).alias("num_arquivos"),
            F.sum("tamanho_bytes").cast("bigint").alias("tamanho_bytes"),
            F.sum("num_registros").cast("bigint").alias("num_registros"),
            F.max("ultima_atualizacao").alias("ultima_atualizacao"),
        )
        .orderBy("tabela")
    )
