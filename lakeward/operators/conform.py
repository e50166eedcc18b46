"""Bring tables to one shape: text cells, clean names, lineage, common columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.text import blank_to_null


def clean_name(name: str) -> str:
    """Column name without NUL characters and outer blanks."""
    return name.replace("\x00", "").strip()


def clean_column_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    if len({n.upper() for n in names}) < len(names):
        raise ValueError(f"column names collide once cleaned: {names}")
    return df.toDF(*names)


def all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def conform(df: DataFrame, lineage: Column | None = None, name: str = "_ARQUIVO_ORIGEM") -> DataFrame:
    """Text columns with blank markers as nulls; `lineage` is added under `name`."""
    clean = clean_column_names(df)
    cells = [blank_to_null(F.col(f"`{c}`").cast("string")).alias(c) for c in clean.columns]
    if lineage is not None:
        cells.append(lineage.alias(name))
    return clean.select(*cells)


def tag_file(df: DataFrame, name: str = "_ARQUIVO_ORIGEM") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def exclude_columns(df: DataFrame, *names: str) -> DataFrame:
    """All columns but these; unlike ``drop``, an unknown name is an error."""
    known = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in known]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.drop(*names)


def union_by_name(left: DataFrame, right: DataFrame, as_text: bool = True) -> DataFrame:
    """Bag union by column name; a column that one side lacks is null there.

    Every column becomes text, or with `as_text=False` only those whose types
    differ: Spark would otherwise cast text to numbers and fail on the first
    value that is none.
    """
    if as_text:
        left, right = all_to_string(left), all_to_string(right)
    else:
        left_types = {n.lower(): t for n, t in left.dtypes}
        clash = {n.lower() for n, t in right.dtypes if left_types.get(n.lower(), t) != t}
        left, right = _text_where(left, clash), _text_where(right, clash)
    return left.unionByName(right, allowMissingColumns=True)


def _text_where(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c.lower() in names else F.col(f"`{c}`") for c in df.columns]
    )


def align_to(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Columns in the order of `reference`, missing ones null, further ones kept last."""
    own = {c.lower(): c for c in df.columns}
    first = [
        F.col(f"`{own[c.lower()]}`").cast(t).alias(c) if c.lower() in own else F.lit(None).cast(t).alias(c)
        for c, t in reference.dtypes
    ]
    known = {c.lower() for c in reference.columns}
    return df.select(*first, *[F.col(f"`{c}`") for c in df.columns if c.lower() not in known])
