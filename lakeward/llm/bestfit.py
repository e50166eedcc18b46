"""Best-fit packing of whole documents: large ones are matched in pairs, small ones fill the gaps.

Documents of one length are interchangeable, so the packing is planned on the counts of the lengths, of which there
are at most as many as a sequence has tokens, whatever the number of documents. The plan says which ranks of a length go to
which sequences; each document then finds its own place from its rank among those of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.packing import VOCABULARY, _encoding
from lakeward.operators.sizing import join_small
from lakeward.session import settled

CONTEXT, END = 1024, 2

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


@dataclass(frozen=True)
class Step:
    """Items of one length, from rank `first` on: `each` of them to every one of the next sequences from `sequence` on,
    one behind the other from `offset`."""

    length: int
    first: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], context: int = CONTEXT) -> list[Step]:
    """Places of `counts` (length -> number of items) in sequences of `context` tokens.

    An item of more than a third of a sequence is large; two fill one so far that no third fits. Large
    items are matched greedily, from the longest, each with the longest other that still fits. No other matching has more
    pairs: where one pairs the longest with a shorter item, or leaves it alone, the two partners can be exchanged.
    Then the small items, from the longest, go to the smallest gap that takes them, and to new sequences when none does.

    Sequences of equal filling are one range, so the work and the plan are bounded by the lengths, not by the counts.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    steps: list[Step] = []
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), by gap
    sequences = 0

    def place(length: int, first_sequence: int, number: int, each: int, gap: int) -> None:
        steps.append(Step(length, used[length], first_sequence, each, context - gap))
        used[length] += number * each
        left[length] -= number * each

    def keep(gap: int, first: int, number: int) -> None:
        if gap > 0 and number > 0:
            insort(gaps, (gap, first, number))

    large = sorted(n for n in left if 3 * n > context)
    while large:
        longest = large[-1]
        fits = bisect_left(large, context - longest + 1) - 1
        if fits < 0:
            number = left[longest]
            place(longest, sequences, number, 1, context)
            keep(context - longest, sequences, number)
        elif large[fits] == longest:
            # The longest fits with its like: all are paired with each other, but perhaps one.
            number = left[longest] // 2
            if number:
                place(longest, sequences, number, 2, context)
                keep(context - 2 * longest, sequences, number)
            sequences += number
            if not left[longest]:
                large.pop()
                continue
            partner = large[fits - 1] if fits else None
            place(longest, sequences, 1, 1, context)
            gap = context - longest
            if partner is not None:
                place(partner, sequences, 1, 1, gap)
                gap -= partner
                if not left[partner]:
                    large.remove(partner)
            keep(gap, sequences, 1)
            number = 1
        else:
            partner = large[fits]
            number = min(left[longest], left[partner])
            place(longest, sequences, number, 1, context)
            place(partner, sequences, number, 1, context - longest)
            keep(context - longest - partner, sequences, number)
            if not left[partner]:
                large.remove(partner)
        sequences += number
        if not left[longest]:
            large.remove(longest)

    for length in sorted((n for n in left if 3 * n <= context), reverse=True):
        while left[length]:
            at = bisect_left(gaps, (length, 0, 0))
            if at < len(gaps):
                gap, first, number = gaps.pop(at)
            else:
                each = context // length
                gap, first, number = context, sequences, max(1, -(-left[length] // each))
                sequences += number
            # The smallest gap that takes an item is, once it has one, again the smallest as long as it takes more.
            each = gap // length
            full = min(number, left[length] // each)
            if full:
                place(length, first, full, each, gap)
                keep(gap - full_width(length, each), first, full)
            if full < number:
                some = min(left[length], each)
                if some:
                    place(length, first + full, 1, some, gap)
                    keep(gap - some * length, first + full, 1)
                    full += 1
                keep(gap, first + full, number - full)
    return steps


def full_width(length: int, each: int) -> int:
    return length * each


class Places:
    """Where the items of a plan go, looked up for many at once."""

    def __init__(self, steps: list[Step]):
        steps = sorted(steps, key=lambda s: (s.length, s.first))
        column = lambda name: np.array([getattr(s, name) for s in steps], np.int64)
        self.length, self.first, self.sequence = column("length"), column("first"), column("sequence")
        self.each, self.offset = column("each"), column("offset")

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of items by length and rank."""
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own = length == n
            a, b = np.searchsorted(self.length, [n, n + 1])
            at[own] = a + np.searchsorted(self.first[a:b], rank[own], side="right") - 1
        beyond = rank - self.first[at]
        return self.sequence[at] + beyond // self.each[at], self.offset[at] + beyond % self.each[at] * length


def _pieces(vocabulary: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = _encoding(vocabulary)
        end = np.array([END], "<u4")
        part = TaskContext.get().partitionId()
        seen = np.zeros(CONTEXT + 1, np.int64)  # items of each length so far
        for batch in batches:
            rows: list[tuple] = []
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.concatenate((encoding.encode_to_numpy(text or "", disallowed_special=()).astype("<u4"), end))
                data, start = memoryview(ids.view(np.uint8)), 0
                # What is left over stands first, so that all other pieces fill a sequence.
                stop = (len(ids) - 1) % CONTEXT + 1
                for piece in range(-(-len(ids) // CONTEXT)):
                    length = stop - start
                    rows.append((name, piece, start, length, zlib.crc32(data[4 * start : 4 * stop]), part, int(seen[length])))
                    seen[length] += 1
                    start, stop = stop, stop + CONTEXT
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            names = [field.split()[0] for field in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return cut


def _placed(places: Places):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("base").to_numpy() + batch.column("nth").to_numpy()
            sequence, offset = places.of(length, rank)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def best_fit(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of all rows of `docs` (doc_id, text) in few sequences of at most 1024 ids.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is whole unless it is longer than a
    sequence; then its first piece has what is left over by whole sequences. A null or empty text is the end id alone. A row
    repeated, or without doc_id, is a document like any other. Names of special tokens in a text are ordinary text. Which of
    several documents of one length is placed where follows from the files' order, not from their rows. Other columns are not
    read. No rows: no pieces.

    The texts are read once and never shuffled. The driver sees the number of items of each length, and the plan that
    every task gets has a size bound by the lengths: each of its steps fills a range of sequences or ends one.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    pieces = settled(rows.mapInArrow(_pieces(vocabulary), _PIECES), "pieces")
    # The number of items of a length in a task, and so many stand in the tasks before it.
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    key = (F.col("part") * (CONTEXT + 1) + F.col("length")).alias("key")
    bases = counts.select(key, before.alias("base"))
    totals = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most CONTEXT rows
    places = Places(plan({r["length"]: r["n"] for r in totals}))
    ranked = join_small(pieces, bases, F.col("part") * (CONTEXT + 1) + F.col("length"), "key", "inner")
    chosen = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "base")
    return chosen.mapInArrow(
        _placed(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
