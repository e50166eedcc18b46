"""Helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.session import settled

# A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
# Texts are hashed together in slices of about so many bytes.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_index(df: DataFrame, *order: Column, name: str = "index") -> DataFrame:
    """Number the rows from 0 in the given order, without one task for all of them.

    The range-sorted rows are written, each with its place in its partition; the driver
    sees one count per partition.
    """
    placed = settled(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    counts = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for p in range(max(counts, default=-1) + 1):
        offsets.append(before)
        before += counts.get(p, 0)
    start = F.get(F.lit(offsets) if offsets else F.array(F.lit(0)), part.cast("int")).cast("bigint")
    return placed.withColumn(name, start + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def blocks_for(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class SpanHash:
    """Hashes of any span of a sequence of 64-bit numbers, after one pass over it."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(_PRIME, n), out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of the texts, and where each text's words begin (one more entry at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = SpanHash(data.astype(np.uint64) + np.uint64(1)).of(starts, ends)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return hashes, np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts that together have about SLICE_BYTES."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > SLICE_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def utf8(texts) -> list[bytes]:
    """Texts of a batch as bytes; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def packed_numbers(values: np.ndarray) -> bytes:
    """Numbers from 0 on, byte by byte of all of them, compressed: high bytes and the columns of an ordered table have long runs."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    planes = np.ascontiguousarray(values, kind.newbyteorder("<")).reshape(-1, 1).view(np.uint8).T
    return bytes([kind.itemsize]) + zstandard.compress(planes.tobytes())


def numbers(data: bytes) -> np.ndarray:
    """What `packed_numbers` was given, as one row."""
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel()
