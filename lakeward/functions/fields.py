"""Typed views of text fields: numbers, dates and logicals that never fail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.functions.text import as_column, strip_space

_NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_DAY = r"\A(?!0000)[0-9]{8}\z"

# Logical letters. Capital Y counts as true, beside y, T and t.
TRUE_LETTERS = ["T", "t", "Y", "y"]
FALSE_LETTERS = ["N", "n", "F", "f"]


def is_plain_number(value: Column | str) -> Column:
    return as_column(value).rlike(_NUMBER)


def tolerant_number(value: Column | str) -> Column:
    """Number as text: as it stands, else without quotes and no-break spaces,
    else the raw trimmed text; null where nothing is left.

    Asterisk padding is no digit, and a decimal comma reads as a point.
    """
    value = as_column(value)
    raw = strip_space(value)
    bare = F.regexp_replace(F.btrim(raw, F.lit("*\x00")), ",", ".")
    clean = strip_space(F.regexp_replace(bare, "[\"'\u00a0]", ""))
    return (
        # Nearly every value is a plain number, and one match settles it.
        F.when(value.rlike(_NUMBER), value)
        .when(bare.rlike(_NUMBER), bare)
        .when(clean.rlike(_NUMBER), clean)
        .when(bare == "", F.lit(None))
        .otherwise(F.nullif(raw, F.lit("")))
    )


def to_double(value: Column | str) -> Column:
    """Double of a numeric text, null (never NaN) for anything else."""
    text = tolerant_number(value)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_long(value: Column | str) -> Column:
    """Whole number of a text without a decimal point, else null."""
    text = tolerant_number(value)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def to_date(value: Column | str) -> Column:
    """Date of ``YYYYMMDD`` text; zero dates and impossible days are null."""
    value = as_column(value)
    text = F.when(value.rlike(_DAY), value).otherwise(strip_space(value))
    parts = [F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)]
    return F.when(text.rlike(_DAY), F.concat_ws("-", *parts).try_cast("date"))


def to_logical(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value.isin(TRUE_LETTERS), True).when(value.isin(FALSE_LETTERS), False)
