"""Replace revised units of a published table: by source file, by year, by snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.conform import union_by_name
from lakeward.operators.periods import latest_period
from lakeward.operators.sizing import join_small


def _key_text(key: str) -> Column:
    return F.upper(F.col(key).cast("string"))


def replaced_keys(delivered: DataFrame, key: str) -> DataFrame:
    """Distinct upper-cased keys of a delivery."""
    return delivered.select(_key_text(key).alias("_replaced")).where("_replaced is not null").distinct()


def not_in(existing: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among `keys`, case ignored.

    As with SQL ``NOT IN``, a row without a key is dropped. Key sets are small
    (file names, years) and broadcast once measured, so the table itself is not
    shuffled.
    """
    kept = existing.where(F.col(key).isNotNull())
    return join_small(kept, replaced_keys(keys, key), _key_text(key), "_replaced", "left_anti")


def merge_by_key(
    existing: DataFrame | None,
    delivered: DataFrame,
    key: str = "_ARQUIVO_ORIGEM",
    delivered_keys: DataFrame | None = None,
    as_text: bool = True,
) -> DataFrame:
    """Existing rows whose key was not delivered again, and all delivered rows.

    `delivered_keys` (column `key`) names the units that were read well, so that
    a unit without rows still replaces its old rows while a failed unit does not.
    Without it the keys are those of the delivered rows.
    """
    if existing is None:
        return delivered
    keys = delivered if delivered_keys is None else delivered_keys
    return union_by_name(not_in(existing, keys, key), delivered, as_text=as_text)


def replace_snapshot(deliveries: DataFrame, period: str, *group: str) -> DataFrame:
    """A registry keeps its latest period only, whole: every unit of that period."""
    return latest_period(deliveries, period, *group)


def prefer_final(rows: DataFrame, key: str, is_final: str) -> DataFrame:
    """Where a unit came both as final and as preliminary, its final rows only."""
    final = replaced_keys(rows.where(F.col(is_final)), key)
    preliminary = join_small(rows.where(~F.col(is_final)), final, _key_text(key), "_replaced", "left_anti")
    return rows.where(F.col(is_final)).unionByName(preliminary)
