"""Deliveries derived from the given tables: names, listings, ledgers and files.

The queries use orders as the monthly event records: the priority stands for
the state and the order date for the month, which gives every order a delivery
file such as ``PASP9703.dbc``. Each derivation has a column form and an SQL form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeward.functions.periods import month_key_of
from lakeward.sources.files import arrow_path
from lakeward.sources.parquet import scan_parquet

STATE_OF_PRIORITY = {"1": "SP", "2": "RJ", "3": "MG", "4": "BA", "5": "RS"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet")


def state() -> Column:
    first = F.substring("o_orderpriority", 1, 1)
    found = F
    for digit, code in STATE_OF_PRIORITY.items():
        found = found.when(first == digit, code)
    return found


SQL_STATE = (
    "CASE substr(o_orderpriority, 1, 1) "
    + " ".join(f"WHEN '{d}' THEN '{c}'" for d, c in STATE_OF_PRIORITY.items())
    + " END"
)
SQL_PERIOD = "strftime(o_orderdate, '%Y%m')"


def tagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with state, month key, delivery file and price in cents."""
    orders = table(spark, sf_dir, "orders")
    period = month_key_of("o_orderdate")
    return orders.select(
        "*",
        state().alias("uf"),
        period.alias("period"),
        F.concat(F.lit("PA"), state(), F.substring(period, 3, 4), F.lit(".dbc")).alias("file"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


SQL_TAGGED = f"""tagged AS (
    SELECT *, {SQL_STATE} AS uf, {SQL_PERIOD} AS period,
           concat('PA', {SQL_STATE}, strftime(o_orderdate, '%y%m'), '.dbc') AS file,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivery file; the summed cents stand for its size."""
    return (
        tagged_orders(spark, sf_dir)
        .groupBy(F.col("file").alias("key"), "uf", "period")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("cents").alias("fingerprint"),
            F.max("o_orderdate").alias("mtime"),
        )
    )


SQL_LISTING = f"""{SQL_TAGGED},
files AS (
    SELECT file AS key, uf, period, count(*) AS rows,
           CAST(sum(cents) AS BIGINT) AS fingerprint, max(o_orderdate) AS mtime
    FROM tagged GROUP BY file, uf, period)"""


def old_ledger(files: DataFrame) -> DataFrame:
    """A ledger behind the listing: one state unknown, every March of another
    size, one state in lower case, and keys that are no longer delivered."""
    march = F.substring("period", 5, 2) == "03"
    behind = files.where("uf <> 'SP'").select(
        F.when(F.col("uf") == "RJ", F.lower("key")).otherwise(F.col("key")).alias("key"),
        F.when(march, F.col("fingerprint") + 1).otherwise(F.col("fingerprint")).alias("fingerprint"),
    )
    gone = files.where("uf = 'MG'").select(F.concat(F.lit("OLD"), "key").alias("key"), "fingerprint")
    return behind.unionByName(gone)


SQL_LEDGER = f"""{SQL_LISTING},
ledger AS (
    SELECT CASE WHEN uf = 'RJ' THEN lower(key) ELSE key END AS key,
           CASE WHEN substr(period, 5, 2) = '03' THEN fingerprint + 1 ELSE fingerprint END AS fingerprint
    FROM files WHERE uf <> 'SP'
    UNION ALL
    SELECT concat('OLD', key), fingerprint FROM files WHERE uf = 'MG')"""


def write_ragged_lines(lines: DataFrame, header: str, path: str, encoding: str) -> None:
    """Write a text column as files that all start with `header`, without quoting."""
    (
        lines.toDF(header)
        .write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .option("encoding", encoding)
        .csv(path)
    )


def write_dbf(df: DataFrame, fields: list[tuple[str, str, int]], path: str, claim: int = 0) -> None:
    """Write rows as dBASE files, one per value of ``file``.

    `df` has a column ``flag`` (blank, or ``*`` for a deleted record), ``file`` and text
    columns; `fields` lists (name, type, width). Numbers are right-aligned. Files whose header should name
    `claim` records more than they hold look as if their transfer had broken off.
    """
    cells = [
        (F.lpad if kind == "N" else F.rpad)(F.coalesce(F.col(column), F.lit("")), width, " ")
        for column, kind, width in fields
    ]
    # The header comes first and names the number of records; the window brings them together.
    n = F.count(F.lit(1)).over(Window.partitionBy("file"))
    records = df.select("file", F.concat(F.col("flag"), *cells).alias("record")).withColumn("n", n)

    def write(batches):
        import struct

        import pyarrow as pa
        import pyarrow.compute as pc

        width = 1 + sum(w for _, _, w in fields)
        descriptors = b"".join(
            column.encode("latin-1").ljust(11, b"\x00") + kind.encode() + bytes(4) + bytes([w, 0]) + bytes(14)
            for column, kind, w in fields
        )
        system, folder = arrow_path(path)
        system.create_dir(folder, recursive=True)
        current, out, total = None, None, 0

        def close():
            if out is not None:
                out.write(b"\x1a")
                out.close()

        for batch in batches:
            total += batch.num_rows
            runs = pc.run_end_encode(batch.column("file"))
            first = 0
            for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if file != current:
                    close()
                    current = file
                    out = system.open_output_stream(f"{folder}/{file}")
                    held = batch.column("n")[first].as_py() + claim
                    out.write(struct.pack("<BBBBIHH20x", 3, 124, 1, 1, held, 33 + len(descriptors), width))
                    out.write(descriptors + b"\r")
                out.write("".join(batch.column("record").slice(first, end - first).to_pylist()).encode("latin-1"))
                first = end
        close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    records.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
