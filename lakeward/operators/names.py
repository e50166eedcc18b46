"""Recognise source files by name: prefix, place and period.

A delivery name is a run of letters (prefix, then perhaps a state or ``BR``),
digits of a year or of year and month, and perhaps a part letter. Rules are a
small table joined on the exact prefix, so ``AB`` never takes the files of
``ABO``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.functions.periods import full_year, month_key
from lakeward.functions.text import as_column, regex_group
from lakeward.session import small_table

# Codes of the federal units.
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]

RULE_TYPE = pa.schema(
    [(name, pa.string()) for name in ("source", "prefix", "place", "digits")]
    + [(name, pa.int32()) for name in ("pivot", "first_year", "last_year")]
)


@dataclass(frozen=True)
class NameRule:
    """How the files of one source are named.

    place: ``uf`` any two letters, ``state`` a federal unit, ``br`` the country, ``none``.
    digits: ``month`` AAMM, ``year2`` AA, ``year4`` AAAA, ``year`` AA or AAAA.
    pivot: first two-digit year of the nineteen hundreds; None for always.
    """

    source: str
    prefix: str
    place: str
    digits: str
    pivot: int | None = 90
    first_year: int | None = None
    last_year: int | None = None


def rule_table(spark: SparkSession, rules: Sequence[NameRule]) -> DataFrame:
    return small_table(spark, [asdict(rule) for rule in rules], RULE_TYPE)


def name_pattern(prefix: str, place: str, digits: str) -> str:
    """Anchored pattern of an upper-case name."""
    places = {"uf": "[A-Z]{2}", "state": f"({'|'.join(STATES)})", "br": "BR", "none": ""}
    counts = {
        "month": "[0-9]{2}(0[1-9]|1[0-2])[A-Z]?",
        "year2": "[0-9]{2}",
        "year4": "[0-9]{4}",
        "year": "([0-9]{2}|[0-9]{4})",
    }
    return rf"^{prefix}{places[place]}{counts[digits]}\.DBC$"


def matches_name(name: Column | str, prefix: str, place: str, digits: str) -> Column:
    return F.upper(as_column(name)).rlike(name_pattern(prefix, place, digits))


def valid_state(code: Column | str) -> Column:
    """One of the federal units; leaves out national roll-ups, which count twice."""
    return as_column(code).isin(STATES)


def year_bounds(year: Column, first: Column | int | None, last: Column | int | None) -> Column:
    """Year within the bounds that are given; both may be open."""
    first = first if isinstance(first, Column) else F.lit(first).cast("int")
    last = last if isinstance(last, Column) else F.lit(last).cast("int")
    return (first.isNull() | (year >= first)) & (last.isNull() | (year <= last))


def classify_names(inventory: DataFrame, rules: DataFrame, name: str = "name") -> DataFrame:
    """Inventory rows with the source, place, year and month key their names tell.

    Names that no rule accepts are left out; see ``unclassified``.
    """
    upper = F.upper(name)
    digits, place, part = F.col("_digits"), F.col("_as.place"), F.col("_part")
    parsed = inventory.select(
        "*",
        regex_group(upper, r"^([A-Z]+)[0-9]").alias("_letters"),
        regex_group(upper, r"^[A-Z]+([0-9]+)[A-Z]?\.DBC$").alias("_digits"),
        F.regexp_extract(upper, r"([A-Z]?)\.DBC$", 1).alias("_part"),
    )
    # Every way to read the letters and the digits; the rules then join by equality.
    length = F.length("_letters")
    prefix, tail = F.substring("_letters", F.lit(1), length - 2), F.substring("_letters", length - 1, F.lit(2))

    def reading(kind: str, before: Column, after: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), before.alias("prefix"), after.alias("place"))

    letters = F.array_compact(
        F.array(
            reading("none", F.col("_letters"), F.lit("")),
            reading("uf", prefix, tail),
            F.when(tail == "BR", reading("br", prefix, tail)),
            F.when(valid_state(tail), reading("state", prefix, tail)),
        )
    )
    n, whole = F.length(digits), part == ""
    shapes = F.array_compact(
        F.array(
            F.when(whole & (n == 2), "year2"),
            F.when(whole & (n == 4), "year4"),
            F.when(whole & n.isin(2, 4), "year"),
            F.when((n == 4) & F.substring(digits, 3, 2).between("01", "12"), "month"),
        )
    )
    readings = parsed.withColumn("_as", F.explode(letters)).withColumn("_shape", F.explode(shapes))
    rule = F.broadcast(rules.select(F.struct("*").alias("_rule")))  # a hundred rows of code
    same_name = (F.col("_as.prefix") == F.col("_rule.prefix")) & (F.col("_as.kind") == F.col("_rule.place"))
    hit = readings.join(rule, same_name & (F.col("_shape") == F.col("_rule.digits")))

    monthly = F.col("_shape") == "month"
    year = full_year(F.when(monthly, F.substring(digits, 1, 2)).otherwise(digits), F.col("_rule.pivot"))
    found = hit.select(
        *inventory.columns,
        F.col("_rule.source").alias("source"),
        place.alias("place"),
        year.alias("year"),
        F.when(monthly, month_key(year, F.substring(digits, 3, 2))).alias("period"),
        "_rule",
    )
    inside = year_bounds(F.col("year"), F.col("_rule.first_year"), F.col("_rule.last_year"))
    return found.where(inside).drop("_rule")


def unclassified(inventory: DataFrame, classified: DataFrame, name: str = "name") -> DataFrame:
    """Inventory rows that no rule accepted."""
    return inventory.join(classified.select(name).distinct(), name, "left_anti")


def select_named(df: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    """Rows with one of the wanted names."""
    return df.where(F.col(name).isin(wanted))


def missing_names(df: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    """Wanted names that do not occur."""
    asked = small_table(
        df.sparkSession, [{name: w} for w in dict.fromkeys(wanted)], pa.schema([(name, pa.string())])
    )
    present = select_named(df, name, wanted).select(name).distinct()
    return asked.join(present, name, "left_anti")


def route_by_prefix(df: DataFrame, key: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key starts with the prefix, all other rows)."""
    inside = F.coalesce(F.startswith(key, F.lit(prefix)), F.lit(False))
    return df.where(inside), df.where(~inside)
