"""Compare a listing with a ledger of what is already incorporated.

Both sides are (key, fingerprint). Keys are compared in upper case. Instead of a
join, both sides go through one aggregate by key: a single shuffle, merged in
each task first, so repeated or hot keys cost nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.periods import distinct_periods, top_n_periods


def compare(current: DataFrame, known: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """One row per key: current and known fingerprint, and on which sides it is."""

    def side(df: DataFrame, is_current: bool) -> DataFrame:
        mark = F.col(fingerprint)
        blank = F.lit(None).cast(df.schema[fingerprint].dataType)
        return df.where(F.col(key).isNotNull()).select(
            F.upper(key).alias(key),
            (mark if is_current else blank).alias("current"),
            (blank if is_current else mark).alias("known"),
            F.lit(is_current).alias("is_current"),
        )

    both = side(current, True).unionByName(side(known, False))
    return both.groupBy(key).agg(
        F.max("current").alias("current"),
        F.max("known").alias("known"),
        F.bool_or("is_current").alias("in_current"),
        F.bool_or(~F.col("is_current")).alias("in_known"),
    )


def _same():
    return F.col("current").eqNullSafe(F.col("known"))


def revision_diff(current: DataFrame, known: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """Keys that are new or whose fingerprint changed: (key, status)."""
    sides = compare(current, known, key, fingerprint)
    status = F.when(~F.col("in_known"), "new").when(~_same(), "changed")
    return sides.where("in_current").select(key, status.alias("status")).where("status is not null")


def snapshot_sync(current: DataFrame, known: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """What makes `known` equal to `current`: (key, action), action one of
    download, reuse, orphan."""
    sides = compare(current, known, key, fingerprint)
    action = (
        F.when(~F.col("in_current"), "orphan")
        .when(F.col("in_known") & _same(), "reuse")
        .otherwise("download")
    )
    return sides.select(key, action.alias("action"))


def any_changed(current: DataFrame, known: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """One row, one column: is any key new or changed?"""
    changed = F.col("in_current") & ~(F.col("in_known") & _same())
    return compare(current, known, key, fingerprint).agg(
        F.coalesce(F.bool_or(changed), F.lit(False)).alias("any_changed")
    )


def ledger_upsert(ledger: DataFrame, delivered: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """Ledger with the delivered keys; a delivered fingerprint replaces the old one."""
    sides = compare(delivered, ledger, key, fingerprint)
    return sides.select(
        key, F.when(F.col("in_current"), F.col("current")).otherwise(F.col("known")).alias(fingerprint)
    )


def ledger_record(ledger: DataFrame, asked: DataFrame, done: DataFrame, key: str = "key", fingerprint: str = "fingerprint") -> DataFrame:
    """Ledger after a run that asked for some files and read some of them well.

    A file that could not be read leaves the ledger, so that it is tried again whatever its size.
    """
    blank = F.lit(None).cast(ledger.schema[fingerprint].dataType)

    def side(df: DataFrame, name: str, mark) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(F.upper(key).alias(key), mark.alias(fingerprint), F.lit(name).alias("side"))

    mark = F.col(fingerprint)
    sides = side(ledger, "known", mark).unionByName(side(asked, "asked", blank)).unionByName(side(done, "done", mark))
    of = lambda name: F.max(F.when(F.col("side") == name, mark))
    merged = sides.groupBy(key).agg(
        of("known").alias("known"), of("done").alias("done"), F.bool_or(F.col("side") == "done").alias("is_done"),
        F.bool_or(F.col("side") == "asked").alias("is_asked"),
    )
    kept = merged.where(F.col("is_done") | ~F.col("is_asked"))
    return kept.select(key, F.when(F.col("is_done"), F.col("done")).otherwise(F.col("known")).alias(fingerprint))


def ledger_replace_prefix(
    ledger: DataFrame, prefix: str, delivered: DataFrame, key: str = "key", fingerprint: str = "fingerprint"
) -> DataFrame:
    """Ledger without the keys of one snapshot, then with the delivered keys."""
    kept = ledger.where(~F.startswith(F.upper(key), F.lit(prefix.upper())))
    return ledger_upsert(kept, delivered, key, fingerprint)


def affected_periods(
    inventory: DataFrame,
    ledger: DataFrame,
    period: str,
    margin: int = 0,
    key: str = "key",
    fingerprint: str = "fingerprint",
) -> DataFrame:
    """Periods with a new or changed file, and the `margin` latest periods."""
    keyed = inventory.where(F.col(key).isNotNull()).withColumn(key, F.upper(key))
    # The period travels through the same aggregate as the fingerprints.
    sides = (
        keyed.select(key, period, F.col(fingerprint).alias("current"), F.lit(None).cast(ledger.schema[fingerprint].dataType).alias("known"), F.lit(False).alias("in_known"))
        .unionByName(
            ledger.where(F.col(key).isNotNull()).select(
                F.upper(key).alias(key),
                F.lit(None).cast(inventory.schema[period].dataType).alias(period),
                F.lit(None).cast(inventory.schema[fingerprint].dataType).alias("current"),
                F.col(fingerprint).alias("known"),
                F.lit(True).alias("in_known"),
            )
        )
        .groupBy(key)
        .agg(
            F.max(period).alias(period),
            F.max("current").alias("current"),
            F.max("known").alias("known"),
            F.bool_or("in_known").alias("in_known"),
        )
    )
    changed = distinct_periods(sides.where(~(F.col("in_known") & _same())), period)
    if margin <= 0:
        return changed
    return changed.union(top_n_periods(inventory, period, margin)).distinct()


def dedup_case_insensitive(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key ignoring case: the first by `order` (by the key itself if none).

    A minimum instead of a window: tasks merge their copies before the shuffle,
    so a name with very many copies is not sorted in one task.
    """
    rank = F.struct(*(order or (key,)))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = F.min(F.struct(rank.alias("rank"), row.alias("row"))).alias("first")
    return df.groupBy(F.upper(key)).agg(first).select("first.row.*")
