"""SimHash fingerprints, compared by bit planes with carry-save counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import utf8
from lakeward.llm.components import connected_components
from lakeward.session import settled

WORDS, SEED, RADIUS, BITS = 3, 42, 3, 64
# Fingerprints that differ in at most RADIUS bits agree in one of RADIUS + 1 blocks.
BLOCKS = RADIUS + 1
BLOCK_BITS = BITS // BLOCKS
# Fingerprints of one comparison task: a tile against a tile.
TILE = 4096
# Lanes compared at a time: a word of a bit plane holds 64.
_LANE_WORDS = 8


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """A bit is set if more than half of the shingles' hashes have it; no words: zero."""
    parts = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        digest, spans = xxhash.xxh64_intdigest, zip(starts.tolist(), (ends[words - 1 :] - 1).tolist(), strict=False)
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    found = np.array(hashes, "<u8")
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(found), 1 << 16):
        bits = np.unpackbits(found[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i, n in enumerate(count.tolist()) if 2 * n > len(found))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text").to_pylist())
        bits = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Fingerprints stored vertically: row i holds bit i of all, 64 fingerprints to a word."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(values)] = values
    by_bit = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little").T
    return np.packbits(np.ascontiguousarray(by_bit), axis=1, bitorder="little").view(np.uint64)


def within_radius(queries: np.ndarray, planes: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, lane) of at most RADIUS (3) differing bits.

    Each lane counts its differences in two carry-save planes and one that says that
    it has passed three. After every eighth bit the blocks of lanes that have all passed
    it for a query are abandoned.
    """
    words = planes.shape[1]
    masks = [(np.uint64(0) - ((queries >> np.uint64(i)) & np.uint64(1))) for i in range(BITS)]
    found_q, found_lane = [], []
    for at in range(0, words, _LANE_WORDS):
        block = planes[:, at : at + _LANE_WORDS]
        live = np.arange(len(queries))
        ones = np.zeros((len(queries), block.shape[1]), np.uint64)
        twos, over = np.zeros_like(ones), np.zeros_like(ones)
        for i in range(BITS):
            differs = block[i][None, :] ^ masks[i][live][:, None]
            carry = ones & differs
            ones ^= differs
            over |= twos & carry
            twos ^= carry
            if i % 8 == 7:
                keep = (over != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
                if not keep.all():
                    live, ones, twos, over = live[keep], ones[keep], twos[keep], over[keep]
                    if not len(live):
                        break
        if len(live):
            near = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little")
            q, lane = np.nonzero(near)
            lane = lane + at * 64
            real = lane < lanes
            found_q.append(live[q[real]])
            found_lane.append(lane[real])
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_lane)


class _Forest:
    """Union-find over the fingerprints of one tile pair, so that it emits a tree, not all its links."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def tile_links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two arrays of fingerprints."""
    values = np.unique(np.concatenate((left, right)))
    planes, forest = bit_planes(right), _Forest(len(values))
    where_l, where_r = np.searchsorted(values, left), np.searchsorted(values, right)
    for at in range(0, len(left), 512):
        q, lane = within_radius(left[at : at + 512], planes, len(right))
        a, b = where_l[at + q], where_r[lane]
        for x, y in zip(a[a != b].tolist(), b[a != b].tolist(), strict=True):
            forest.join(x, y)
    root = np.array([forest.root(i) for i in range(len(values))], np.int64)
    inner = root != np.arange(len(values))
    return values[inner], values[root[inner]]


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    bits = group["bits"].to_numpy(np.int64).view(np.uint64)
    left, right = bits[group["side"] != 1], bits[group["side"] != 0]
    a, b = tile_links(left, right) if len(left) and len(right) else (bits[:0], bits[:0])
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def near_links(distinct: DataFrame, total: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `bits` within the radius.

    Fingerprints meet by each of four 16-bit blocks, of which as many bits are used as keep
    groups near a tile; a larger group is cut into tiles and each pair of tiles is
    one task, so that no task holds a whole hot group.
    """
    used = int(min(BLOCK_BITS, max(0, np.ceil(np.log2(max(1, total) / (TILE / 2))))))
    block = lambda i: F.shiftright(F.shiftleft(F.col("bits"), BITS - BLOCK_BITS * (i + 1)), BITS - used) if used else F.lit(0)
    keyed = distinct.select(
        "bits", F.explode(F.array(*(F.struct(F.lit(i).alias("n"), block(i).cast("bigint").alias("v")) for i in range(BLOCKS)))).alias("k")
    ).select("bits", (F.col("k.n") * (1 << 20) + F.col("k.v")).alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    tiled = keyed.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("bits"), F.col("tiles")).cast("int"))
    # A tile meets itself (side 2) and, as left or right side, each other tile once.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda o: F.struct(
            F.least(o, F.col("tile")).alias("l"),
            F.greatest(o, F.col("tile")).alias("r"),
            F.when(o == F.col("tile"), 2).when(F.col("tile") < o, 0).otherwise(1).alias("side"),
        ),
    )
    work = tiled.select("key", "bits", F.explode(meets).alias("m")).select("key", "bits", "m.*")
    return work.groupBy("key", "l", "r").applyInPandas(_compare, "a long, b long")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id that can be reached over links of at most three
    differing bits. Null and empty texts, and texts of white space, have fingerprint zero and
    link like any other. A row without doc_id is fingerprinted and linked too, but never
    names a component; if none of its component has a doc_id, component_id is null. Repeated
    rows stay as they are. Other columns are not read. No rows: an empty result.
    """
    prints = settled(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_fingerprints, "doc_id long, bits long"), "fingerprints")
    distinct = settled(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct")
    links = near_links(distinct.select("bits"), distinct.count())
    found = connected_components(links)
    member = distinct.join(found, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("component", "bits").alias("component")
    )
    named = member.groupBy("component").agg(F.min("first").alias("component_id"))
    of = member.join(named, "component").select("bits", "component_id")
    return prints.join(of, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are the first of their component: the one with its smallest doc_id.

    Of rows with one doc_id the one with the smallest text stays. Rows without doc_id stay: nothing names them.
    """
    found = simhash_components(docs).where("doc_id is not null and doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(found, "doc_id", "left_semi")
    columns = docs.columns
    rest = [F.min(F.struct(F.col("text"), *(F.col(c) for c in columns if c not in ("doc_id", "text")))).alias("_row")]
    kept = named.groupBy("doc_id").agg(*rest)
    picked = kept.select(*(F.col("doc_id") if c == "doc_id" else F.col(f"_row.`{c}`").alias(c) for c in columns))
    return picked.unionByName(docs.where("doc_id is null"))
