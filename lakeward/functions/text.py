"""Text expressions for dirty source fields, labels, codes and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trimmed texts that mean "no value", beside the empty text.
BLANK_MARKERS = ["None", "nan", "NaT"]

# Accented capitals that become plain letters. Other accented
# letters are not mapped and end up as a separator in normalised labels.
ACCENTED = "ÁÃÂÉÊÍÓÕÔÚÇ"
PLAIN = "AAAEEIOOOUC"

# Unicode white space (no-break space included) plus the ASCII separators.
_SPACE = r"[\s\x1c-\x1f]"
_EDGE_SPACE = rf"(?U)^{_SPACE}+|{_SPACE}+\z"
_BLANK = rf"(?U)\A{_SPACE}*({'|'.join(BLANK_MARKERS)})?{_SPACE}*\z"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_space(value: Column | str) -> Column:
    """Remove every kind of white space at both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(as_column(value), _EDGE_SPACE, "")


def blank_to_null(value: Column | str) -> Column:
    """Null where the trimmed text is a blank marker; other values keep their blanks."""
    value = as_column(value)
    return F.when(~value.rlike(_BLANK), value)


def strip_accents(value: Column | str) -> Column:
    return F.translate(F.upper(as_column(value)), ACCENTED, PLAIN)


def normalize_label(value: Column | str) -> Column:
    """Upper-case identifier of a human label: ``Valor (R$)`` -> ``VALOR_R``."""
    words = F.regexp_replace(strip_accents(value), "[^A-Z0-9]+", "_")
    return F.btrim(words, F.lit("_"))


def zero_fill(value: Column | str, width: int = 6) -> Column:
    """Left-pad a code with zeros; longer codes stay whole (``lpad`` would cut them)."""
    value = as_column(value)
    return F.when(F.length(value) < width, F.lpad(value, width, "0")).otherwise(value)


def regex_group(value: Column | str, pattern: str, group: int = 1) -> Column:
    """Captured group, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(as_column(value), pattern, group), F.lit(""))


def file_name(path: Column | str) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def top_folder(path: Column | str) -> Column:
    """First component of a relative path, empty for a file at the root."""
    path = as_column(path)
    return F.when(F.contains(path, F.lit("/")), F.substring_index(path, "/", 1)).otherwise("")


def starts_with_any(value: Column | str, prefixes: list[str]) -> Column:
    value = as_column(value)
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | F.startswith(value, F.lit(prefix))
    return hit


def period_digits(name: Column | str) -> Column:
    """Digits just before the extension, or the whole name where there are none."""
    name = as_column(name)
    return F.coalesce(regex_group(name, r"([0-9]+)\.\w+$"), name)
