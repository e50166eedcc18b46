"""Packing of documents into training sequences by order-preserving dynamic programming."""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The vocabulary of byte_bpe_50k.json, in the form that its faster reader takes.
VOCABULARY = "byte_bpe_50k.tiktoken"
CONTEXT, END = 2048, 1
# Tokens that are packed together; a document is never divided between two such blocks.
BLOCK_TOKENS = 1 << 20
# A place in each so many tokens at which a window may end: the last end of a sentence, or
# where there is none any token.
STEP = 32
# What a cut costs, in tokens of padding.
SENTENCE_COST, TOKEN_COST, WINDOW_COST = 1.0, 24.0, 2.0
# Windows of these lengths need no padding.
WHOLE = tuple(1 << b for b in range(5, CONTEXT.bit_length() - 1))

_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@lru_cache(4)
def _encoding(vocabulary: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The tokenizer, and which ids end a sentence."""
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ends = np.zeros(max(ranks.values()) + 2, bool)
    ends[[i for word, i in ranks.items() if word.endswith((b".", b"!", b"?", b"\n"))]] = True
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ends


def places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows may end, rising, and what a cut there costs. The last place is the end of all."""
    n = len(ids)
    cost = np.full(n + 1, np.inf, np.float32)
    sentence = np.flatnonzero(ends[ids]) + 1
    cell = np.full((n + STEP) // STEP + 1, -1, np.int64)
    cell[sentence // STEP] = sentence  # the last of each cell stays
    empty = np.flatnonzero(cell < 0) * STEP
    tail = n - np.arange(CONTEXT // STEP) * STEP
    cost[empty[(empty > 0) & (empty < n)]] = TOKEN_COST
    cost[tail[tail > 0]] = TOKEN_COST
    cost[cell[cell > 0]] = SENTENCE_COST
    cost[doc_ends] = 0
    at = np.flatnonzero(np.isfinite(cost))
    return at, cost[at]


def windows(at: np.ndarray, cost: np.ndarray) -> list[int]:
    """The places that end windows, with the least padding and cuts.

    best[j], the least cost of all up to place j, is the smallest over i within one context of
    best[i] plus the padding of the window between. Without the part that depends on j alone this
    is a sliding minimum of best[i] + at[i], which a queue of rising values holds; a window of
    a whole length is a transition of its own, without padding.
    """
    position, price = [0, *at.tolist()], [0.0, *cost.tolist()]
    index = {p: i for i, p in enumerate(position)}
    best, back = [0.0] * len(position), [0] * len(position)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(position)):
        here = position[j]
        while position[queue[0][1]] < here - CONTEXT:
            queue.popleft()
        value, i = queue[0]
        value += CONTEXT - here
        for whole in WHOLE:
            k = index.get(here - whole)
            if k is not None and best[k] < value:
                value, i = best[k], k
        value += price[j] + WINDOW_COST
        best[j], back[j] = value, i
        value += here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], len(position) - 1
    while j:
        out.append(position[j])
        j = back[j]
    return out[::-1]


def pieces(docs: list[np.ndarray], ends: np.ndarray) -> dict[str, np.ndarray]:
    """The pieces of consecutive documents: document, start, length, checksum, window and offset there."""
    ids = np.concatenate(docs).astype("<u4")
    doc_ends = np.cumsum([len(d) for d in docs])
    cuts = np.array(windows(*places(ids, doc_ends, ends)), np.int64)
    stop = np.union1d(cuts, doc_ends)
    begin = np.concatenate(([0], stop[:-1]))
    doc, window = np.searchsorted(doc_ends, begin, side="right"), np.searchsorted(cuts, begin, side="right")
    data = memoryview(ids.view(np.uint8))
    sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    return {
        "doc": doc,
        "start": begin - np.concatenate(([0], doc_ends))[doc],
        "length": stop - begin,
        "ids_crc32": np.array(sums, np.int64),
        "window": window,
        "offset": begin - np.concatenate(([0], cuts))[window],
    }


def _packed(vocabulary: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, ends = _encoding(vocabulary)
        sequence = TaskContext.get().partitionId() << 33
        end = np.array([END], np.uint32)
        names, docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, size
            found = pieces(docs, ends)
            at = found.pop("doc")
            doc_tokens = np.array([len(d) for d in docs], np.int64)[at]
            window = found.pop("window")
            columns = [found["start"], found["length"], found["ids_crc32"], doc_tokens, window + sequence, found["offset"]]
            ids = pa.array([names[i] for i in at.tolist()], pa.int64())
            sequence += int(window[-1]) + 1
            names.clear()
            docs.clear()
            size = 0
            return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=_COLUMNS)

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                names.append(name)
                docs.append(np.concatenate((encoding.encode_to_numpy(text or "", disallowed_special=()), end)))
                size += len(docs[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
        if docs:
            yield flush()

    return pack


def packed(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of all rows of `docs` (doc_id, text) in sequences of at most 2048 ids.

    Rows are packed in the order of doc_id, those without one first. A null or empty text is the
    end id alone. A row repeated is packed again. Special tokens' names in a text are ordinary text.
    A block of about a million tokens is packed at a time, whatever the
    size of the input; its last windows are chosen among whole lengths too. Other columns are not read. No rows: no pieces.
    """
    digest = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id", digest).sortWithinPartitions("doc_id", digest)
    return ordered.mapInArrow(_packed(vocabulary), ", ".join(f"{c} long" for c in _COLUMNS))
