"""Joins with a side whose size is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeward.session import settled_observed

# Bound of a broadcast side: its text width plus a fixed cost per cell.
BROADCAST_BYTES = 64 * 1024 * 1024
_CELL_COST = 24
# Tasks among which the rows of a hot key are spread.
SALTS = 64


def _width(df: DataFrame) -> Column:
    """Approximate bytes of a frame of scalar columns, as an aggregate."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + _CELL_COST for c in df.columns),
        F.lit(0),
    )
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """Approximate in-memory size of a frame of scalar columns (one aggregate job)."""
    return df.agg(_width(df)).first()[0]


def settled_with_size(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame, written once, and its approximate size, which is observed while it is written."""
    written, seen = settled_observed(df, "side", bytes=_width(df))
    return written, seen["bytes"] or 0


def join_small(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: str,
    how: str,
    limit: int | None = None,
) -> DataFrame:
    """Join a large left side with a side that is expected, but not known, to be small.

    The right side is written and measured in one job. Within `limit` bytes it is broadcast and the left side stays where
    it is. Beyond it the join shuffles, but for the hot keys: a key with more rows
    than a fair share of a shuffle partition (there are fewer of those than
    partitions) is joined with a broadcast of its few right rows, or if these too are beyond the limit
    with copies of them in several tasks, as are rows
    without a key, which all would meet in one task.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    right, size = settled_with_size(right)
    if size <= limit:
        return left.join(F.broadcast(right), left_key == F.col(right_key), how)
    hot = _hot_keys(left.select(left_key.alias("k")))
    is_hot = left_key.isNull() | left_key.isin(hot)
    hot_left, hot_right = left.where(is_hot), right.where(F.col(right_key).isin(hot))
    if hot and measured_bytes(hot_right) > limit:
        met = _salted(hot_left, hot_right, left_key, right_key, how)
    else:
        met = hot_left.join(F.broadcast(hot_right), left_key == F.col(right_key), how)
    return met.unionByName(left.where(~is_hot).join(right, left_key == F.col(right_key), how))


def _salted(left: DataFrame, right: DataFrame, left_key: Column, right_key: str, how: str) -> DataFrame:
    """A join whose left rows of one key are spread over SALTS tasks by a hash of the row, each with a copy of the right rows."""
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in left.columns)), F.lit(SALTS)).cast("int")
    spread = left.withColumn("_salt", salt)
    copies = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return spread.join(copies, (left_key == F.col(right_key)) & (F.col("_salt") == F.col("_copy")), how).drop("_salt", "_copy")


def _hot_keys(keys: DataFrame) -> list:
    """Keys with more than an even share of the rows per shuffle partition."""
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = keys.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    # Fewer than `partitions` keys can exceed an even share; the total is
    # observed in the same pass that finds the largest counts.
    seen = Observation()
    largest = counts.observe(seen, F.sum("n").alias("total")).orderBy(F.desc("n")).limit(partitions).collect()
    total = seen.get["total"] or 0
    return [row["k"] for row in largest if row["n"] * partitions > total]
