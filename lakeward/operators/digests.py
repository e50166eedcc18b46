"""Digests that add up: differences of two large tables found from sums, and a proof that a merged table is the sum of its files.

Sums of row hashes do not depend on the order of rows, count copies, and are merged inside tasks before they
are shuffled. What was replaced can be taken off and what is new added without reading the rest again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.ledger import compare
from lakeward.operators.merge import merge_by_key
from lakeward.operators.sizing import join_small
from lakeward.session import settled

# Leaves among which the keys of a group are dealt by their hash.
LEAVES = 1024
SUMS = ("n_rows", "high", "low")


def present_digest(df: DataFrame, *without: str) -> Column:
    """The halves of the MD5 of a row's values that are there, with their names: a column that is added as null changes nothing."""
    cells = [F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")) for c in sorted(df.columns) if c not in without]
    digest = F.md5(F.concat_ws("\x1f", *cells).cast("binary"))
    half = lambda first: F.conv(F.substring(digest, first, 16), 16, 10).cast("decimal(20,0)")
    return F.struct(half(1).alias("high"), half(17).alias("low"))


def source_digests(rows: DataFrame, source: str = "_ARQUIVO_ORIGEM") -> DataFrame:
    """(`source`, n_rows, high, low) of each source file, its name in upper case; rows without one are a group of their own."""
    hashed = rows.select(F.upper(F.col(source).cast("string")).alias(source), present_digest(rows, source).alias("_digest"))
    return hashed.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.sum(f"_digest.{h}").cast("decimal(38,0)").alias(h) for h in ("high", "low"))
    )


def digests_after(kept: DataFrame, delivered: DataFrame, source: str = "_ARQUIVO_ORIGEM", delivered_keys: DataFrame | None = None) -> DataFrame:
    """The digests of a table after `delivered` was merged into it by source (`merge_by_key`), without reading the table."""
    return merge_by_key(kept, source_digests(delivered, source), source, delivered_keys, as_text=False)


def total_of(digests: DataFrame) -> DataFrame:
    """One row: the digest of the whole table, the sum of those of its files."""
    return digests.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint" if c == "n_rows" else "decimal(38,0)").alias(c) for c in SUMS))


def audit(table: DataFrame, kept: DataFrame, source: str = "_ARQUIVO_ORIGEM") -> DataFrame:
    """(`source`, kept_rows, found_rows, status) of every source: `same`, `differs`, `lost` from the table or `unknown` to the digests.

    Both sides go through one aggregate by source, so a missing row, a row too many or another value shows on either side.
    """
    found = source_digests(table, source)

    def side(df: DataFrame, sign: int, name: str) -> DataFrame:
        return df.select(source, F.lit(name).alias("side"), F.col("n_rows"), *((F.col(h) * sign).cast("decimal(38,0)").alias(h) for h in ("high", "low")))

    rows_of = lambda name: F.coalesce(F.sum(F.when(F.col("side") == name, F.col("n_rows"))), F.lit(0)).cast("bigint")
    on = lambda name: F.bool_or(F.col("side") == name)
    met = side(kept, 1, "kept").unionByName(side(found, -1, "found")).groupBy(source)
    sums = met.agg(
        rows_of("kept").alias("kept_rows"), rows_of("found").alias("found_rows"), on("kept").alias("is_kept"), on("found").alias("is_found"),
        F.sum("high").alias("high"), F.sum("low").alias("low"),
    )
    agree = (F.col("kept_rows") == F.col("found_rows")) & (F.col("high") == 0) & (F.col("low") == 0)
    status = (
        F.when(~F.col("is_found"), F.when(F.col("kept_rows") == 0, "same").otherwise("lost"))
        .when(~F.col("is_kept"), "unknown")
        .when(agree, "same")
        .otherwise("differs")
    )
    return sums.select(source, "kept_rows", "found_rows", status.alias("status"))


def _differing(sides: DataFrame, place: str) -> DataFrame:
    """Places where the rows of the two sides do not add up to nothing."""
    sums = sides.groupBy(place).agg(F.sum("sign").alias("rows"), F.sum(F.col("mark") * F.col("sign")).alias("marks"))
    return sums.where("rows <> 0 or marks <> 0").select(F.col(place).alias("differs"))


def rows_to_compare(current: DataFrame, known: DataFrame, group: str, key: str = "key", fingerprint: str = "fingerprint", leaves: int = LEAVES) -> DataFrame:
    """The rows of both sides (key, fingerprint, is_current) that stand where the sides differ.

    First whole groups are compared by the sums of their hashes, then in those that differ the leaves to which
    the hash of the key deals their rows. Only sums are shuffled: groups once, leaves of differing groups once. Where
    the tables are partitioned by `group`, the second pass reads only partitions that differ.
    """

    def side(df: DataFrame, is_current: bool) -> DataFrame:
        name = F.upper(F.col(key).cast("string"))
        return df.where(F.col(key).isNotNull()).select(
            name.alias("key"),
            F.col(fingerprint).alias("fingerprint"),
            F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group"),
            F.xxhash64(name, F.col(fingerprint).isNull(), F.col(fingerprint)).cast("decimal(20,0)").alias("mark"),
            F.lit(1 if is_current else -1).alias("sign"),
        )

    sides = side(current, True).unionByName(side(known, False))
    groups = _differing(sides, "group")
    inside = join_small(sides, groups, F.col("group"), "differs", "left_semi")
    inside = inside.withColumn("leaf", F.concat("group", F.lit("/"), F.pmod(F.xxhash64("key"), F.lit(leaves)).cast("string")))
    rows = join_small(inside, _differing(inside, "leaf"), F.col("leaf"), "differs", "left_semi")
    return rows.select("key", "fingerprint", (F.col("sign") > 0).alias("is_current"))


def tree_diff(current: DataFrame, known: DataFrame, group: str, key: str = "key", fingerprint: str = "fingerprint", leaves: int = LEAVES) -> DataFrame:
    """(key, status) of keys that are `new`, `changed` or `gone`, as `revision_diff` and `snapshot_sync` tell them, for tables of any size.

    Rows are shuffled by key only in the leaves of a group that differ. A key that is in another group now counts by its
    fingerprint alone; where a key stands several times its largest fingerprint counts. Rows without a key are left out.
    """
    rows = settled(rows_to_compare(current, known, group, key, fingerprint, leaves), "differing")
    sides = compare(rows.where("is_current"), rows.where("not is_current"))
    changed = ~F.col("current").eqNullSafe(F.col("known"))
    status = F.when(~F.col("in_known"), "new").when(~F.col("in_current"), "gone").when(changed, "changed")
    return sides.select(F.col("key").alias(key), status.alias("status")).where("status is not null")
