"""Delimited text in one scan, whatever the headers of its files, with nothing lost on the way.

Lines are read as text beside the path of their file. The few distinct headers travel with the scan as one small table; each
line's fields are counted against its own file's header before a cell is placed, so a line that is too long or too
short, and a file whose header repeats a name, reach the rejects with path and line.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators.sizing import join_small
from lakeward.session import settled, settled_observed, small_table
from lakeward.sources.files import plain_path, scan_first_lines

# Why something is set aside; the line or the header follows.
MALFORMED, REPEATED = "malformed line: ", "repeated name in header: "
# The reader's column for a line that it could not take whole.
_WHOLE = "_whole"
_NOTHING = "path string, name string, bytes bigint, error string"


@dataclass
class HeadedScan:
    """Rows by the names of their files' headers (None if no file has one), and what was set aside:
    (path, name, bytes, error), a row per line or file."""

    rows: DataFrame | None
    aside: DataFrame


def _names(header: str, sep: str, quote: str) -> list[str]:
    """The names of a header line; a name that is missing is its place."""
    cells = next(csv.reader([header], delimiter=sep, quotechar=quote), [])
    return [cell or f"_c{i}" for i, cell in enumerate(cells)]


def split_fields(line: Column, sep: str, quote: str = '"') -> Column:
    """The fields of a line, quotes still on; a separator between quotes is no separator.

    A quote counts only where a field begins with it, as in the usual dialect: a quote inside a bare field is text.
    Joined by the separator the fields are the line again, unless a quote is not closed.
    """
    s, q = (f"\\x{ord(c):02x}" for c in (sep, quote))
    # Each field with its separator in front, so that an empty one is a match like the others.
    quoted = rf"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?=$|{s})"
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{s}(?:({quoted})|([^{s}]*))"), F.lit(0))
    with_quotes = F.transform(found, lambda f: F.substring(f, 2, 1 << 30))
    return F.when(F.contains(line, F.lit(quote)), with_quotes).otherwise(F.split(line, s))


def unquoted(field: Column, quote: str = '"') -> Column:
    """A field without its quotes, doubled quotes inside as one."""
    inner = F.replace(field.substr(F.lit(2), F.length(field) - 2), F.lit(quote * 2), F.lit(quote))
    return F.when((F.length(field) > 1) & F.startswith(field, F.lit(quote)) & F.endswith(field, F.lit(quote)), inner).otherwise(field)


def scan_headed(
    spark: SparkSession, files: DataFrame, sep: str = ",", encoding: str = "UTF-8", quote: str = '"', ignore_case: bool = True
) -> HeadedScan:
    """Text rows of an inventory (path, name, bytes), united by the names in each file's header.

    One job reads the first lines, one plan reads all files, however many headers there are. The driver sees the distinct headers and, for the
    reader, the paths of the listing. Names are compared ignoring case if asked, and shown as they first appear. A blank cell is null. A
    line with another number of fields than its file's header, or with a quote that is not closed, is set aside. So is a file whose header has a name twice,
    with that header, as its cells could not be told apart, and a file that cannot be read, with its error.
    Files without any line hold nothing. Fields do not span lines.
    """
    known = scan_first_lines(files, encoding).join(files.select("path", "name", "bytes"), "path")
    heads, seen = settled_observed(known, "headers", unread=F.count("error"))
    headed = heads.where("error is null and line <> ''")
    found = headed.groupBy("line").agg(F.min("path").alias("path")).collect()
    fold = (lambda name: name.upper()) if ignore_case else (lambda name: name)
    names = {row["line"]: _names(row["line"], sep, quote) for row in sorted(found, key=lambda row: row["path"])}
    clashing = {line for line, own in names.items() if len(set(map(fold, own))) < len(own)}
    shown: dict[str, str] = {}
    for line, own in names.items():
        if line not in clashing:
            for name in own:
                shown.setdefault(fold(name), name)
    place = {name: i for i, name in enumerate(shown)}
    table = small_table(
        spark,
        [{"line": line, "_width": len(own), "_at": ",".join(str(place[fold(n)]) for n in own)} for line, own in names.items() if line not in clashing],
        pa.schema([("line", pa.string()), ("_width", pa.int32()), ("_at", pa.string())]),
    )
    aside = heads.where("error is not null").select("path", "name", "bytes", "error") if seen["unread"] else spark.createDataFrame([], _NOTHING)
    if clashing:
        repeated = headed.where(F.col("line").isin(sorted(clashing)))
        aside = aside.unionByName(repeated.select("path", "name", "bytes", F.concat(F.lit(REPEATED), "line").alias("error")))
    if not shown:
        return HeadedScan(None, settled(aside, "aside"))
    # For each file that can be cut: how many names it has, and which of the shown ones they are.
    good = settled(headed.join(F.broadcast(table), "line").select(F.col("path").alias("_of"), "_width", "_at"), "headed")

    # Lines as they are: a separator that no text has, or else the whole line in the column for what is malformed. The
    # reader leaves the first line of each file out.
    reader = spark.read.option("header", True).option("sep", "\x01").option("quote", "").option("encoding", encoding)
    reader = reader.option("columnPruning", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _WHOLE)
    text = reader.schema(f"value string, {_WHOLE} string").csv([row["_of"] for row in good.select("_of").collect()])
    lines = text.select(F.coalesce(_WHOLE, "value").alias("line"), plain_path(F.col("_metadata.file_path")).alias("_path"))
    met = join_small(lines.where("line is not null"), good, F.col("_path"), "_of", "inner")
    cut = met.withColumn("_fields", split_fields(F.col("line"), sep, quote))
    # A field that begins with a quote that nothing closes would make the line mean something else.
    open_quote = F.exists("_fields", lambda f: F.startswith(f, F.lit(quote)) & ~(F.endswith(f, F.lit(quote)) & (F.length(f) > 1)))
    whole = (F.size("_fields") == F.col("_width")) & ~open_quote
    # Good cells and bad lines leave one written table, so the files are read once.
    at = F.transform(F.split("_at", ","), lambda a: a.cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.lit(len(shown) - 1)), lambda i: F.nullif(unquoted(F.get("_fields", F.array_position("_at", i).cast("int") - 1), quote), F.lit("")))
    split = cut.withColumn("_at", at).select("_path", F.when(whole, cells).alias("cells"), F.when(~whole, F.col("line")).alias("bad"))
    placed, count = settled_observed(split, "cells", bad=F.count("bad"))
    rows = placed.where("bad is null").select(*[F.get("cells", i).alias(name) for i, name in enumerate(shown.values())])
    if count["bad"]:
        malformed = placed.where("bad is not null").select(
            F.col("_path").alias("path"), F.element_at(F.split("_path", "/"), -1).alias("name"),
            F.octet_length("bad").cast("bigint").alias("bytes"), F.concat(F.lit(MALFORMED), "bad").alias("error"),
        )
        aside = aside.unionByName(malformed)
    return HeadedScan(rows, settled(aside, "aside"))

