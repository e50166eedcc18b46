"""Removal of word passages that an earlier document holds already."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.automaton import SuffixAutomaton
from lakeward.llm.common import SpanHash, blocks_for, hashed_words, slices, utf8
from lakeward.session import settled

# Words of a window, and of the anchors that are chosen from it.
WINDOW, ANCHOR = 50, 25
# Words of reference passages in one automaton.
SHARD_WORDS = 1 << 17
# Passages of one hot anchor in a tile; each pair of tiles is a group of its own.
TILE = 1024

_RUNS = "anchor long, run long, doc_key long, doc_id long, start int, n int"


def _least_of_each(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchored_runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, anchor, run hash, start, windows) of each run of windows with one anchor.

    The anchor of a window is the smallest hash of the 25-word sequences in it. Equal
    windows have equal anchors, wherever they stand.
    """
    words, bounds = hashed_words(texts)
    if len(words) < WINDOW:
        return (np.zeros(0, np.int64),) * 5
    spans = SpanHash(words)
    at = np.arange(len(words) - ANCHOR + 1)
    least = _least_of_each(spans.of(at, at + ANCHOR), WINDOW - ANCHOR + 1)
    first = np.arange(len(least))
    owner = np.searchsorted(bounds, first, side="right") - 1
    inside = first + WINDOW <= bounds[owner + 1]
    first, owner, least = first[inside], owner[inside], least[inside]
    if not len(first):
        return (np.zeros(0, np.int64),) * 5
    new = np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])))
    head = np.flatnonzero(new)
    n = np.diff(np.concatenate((head, [len(first)])))
    start, owner = first[head], owner[head]
    run = spans.of(start, start + n + WINDOW - 1)
    return owner, least[head].view(np.int64), run.view(np.int64), start - bounds[owner], n


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, keys, ids = utf8(batch["text"]), batch["doc_key"].to_numpy(), batch["doc_id"].to_numpy()
        for a, b in slices(texts):
            owner, anchor, run, start, n = anchored_runs(texts[a:b])
            if len(owner):
                yield pd.DataFrame(
                    {"anchor": anchor, "run": run, "doc_key": keys[a:b][owner], "doc_id": ids[a:b][owner], "start": start, "n": n}
                )


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of the listed runs of each text."""
    for batch in batches:
        out = []
        for text, doc, runs in zip(utf8(batch["text"]), batch["doc_id"], batch["runs"], strict=True):
            words = text.split()
            out += [
                (r["anchor"], r["run"], doc, b" ".join(words[r["start"] : r["start"] + r["n"] + WINDOW - 1])) for r in runs
            ]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["anchor", "run", "doc_id", "passage"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["anchor", "run", "doc_id", "passage"])


def _matches(group: pd.DataFrame) -> pd.DataFrame:
    """One shard: an automaton of its references, over which all its passages are streamed."""
    automaton = SuffixAutomaton()
    numbers: dict[bytes, int] = {}
    number = lambda text: [numbers.setdefault(w, len(numbers)) for w in text.split(b" ")]
    reference = group[group["is_reference"]]
    for text, doc in zip(reference["passage"], reference["doc_id"], strict=True):
        automaton.add(number(text), doc)
    automaton.close()
    out = []
    streamed = group[group["is_streamed"]]
    for anchor, run, doc, text in zip(streamed["anchor"], streamed["run"], streamed["doc_id"], streamed["passage"], strict=True):
        least = automaton.least_documents(number(text), WINDOW)
        earlier = np.array([x is not None and x < doc for x in least])
        edge = np.flatnonzero(np.diff(np.concatenate(([False], earlier, [False])).astype(np.int8)))
        out += [(anchor, run, doc, a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
    return pd.DataFrame(out, columns=["anchor", "run", "doc_id", "skip", "n"]).astype(
        {"anchor": "int64", "run": "int64", "doc_id": "int64", "skip": "int32", "n": "int32"}
    )


def _earlier_in_first(passages: DataFrame) -> DataFrame:
    """Stretches of windows of each passage that a passage of a smaller document holds.

    Passages can only share a window if they share its anchor, so shards are made
    by anchor; each holds about SHARD_WORDS words. An anchor with very many different passages is cut
    into tiles: tile l as references meets tile r as streamed passages.
    """
    passages = settled(passages, "passages")
    sizes = settled(
        passages.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")), "anchors"
    )
    shards = blocks_for(passages.count() * 64, SHARD_WORDS)
    work = passages.join(sizes, "anchor").withColumn("tile", F.pmod(F.xxhash64("run"), F.col("tiles")).cast("int"))
    one = work.where("tiles = 1").select(
        F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), F.lit(0).alias("l"), F.lit(0).alias("r"),
        F.lit(True).alias("is_reference"), F.lit(True).alias("is_streamed"), "anchor", "run", "doc_id", "passage",
    )
    others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    many = work.where("tiles > 1")
    cells = [
        F.lit(-1).cast("bigint").alias("shard"), F.col("l"), F.col("r"),
        (F.col("side") == 0).alias("is_reference"), (F.col("side") == 1).alias("is_streamed"), F.col("anchor"), F.col("run"),
        F.col("doc_id"), F.col("passage"),
    ]
    left = many.withColumn("l", F.col("tile")).withColumn("r", others).withColumn("side", F.lit(0)).select(*cells)
    right = many.withColumn("r", F.col("tile")).withColumn("l", others).withColumn("side", F.lit(1)).select(*cells)
    key = F.when(F.col("shard") < 0, F.col("anchor")).otherwise(F.lit(0))
    rows = one.unionByName(left).unionByName(right).withColumn("hot", key)
    # As many tasks as shards: by their bytes alone the shuffle would put many in one.
    keys = ["shard", "hot", "l", "r"]
    return rows.repartition(shards, *keys).groupBy(*keys).applyInPandas(
        _matches, "anchor long, run long, doc_id long, skip int, n int"
    )


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(doc_key, spans): the stretches of windows of each document that also start in a document with a smaller doc_id."""
    light = keyed.where("doc_id is not null").mapInPandas(_runs, _RUNS)
    # Written, so that the joins with them are of two shuffled sides: those of a hot anchor can then be split.
    twice = light.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    shared_anchor = settled(twice.select("anchor"), "shared_anchors")
    shared = settled(light.join(shared_anchor, "anchor", "left_semi"), "runs")
    # The same run in several documents: all but the first lose it whole.
    first = settled(
        shared.groupBy("anchor", "run").agg(F.min(F.struct("doc_id", "doc_key", "start", "n")).alias("at")), "first_runs"
    )
    # The first document of a run can lose windows only to another run of that anchor.
    unequal = first.groupBy("anchor").agg(F.min("run").alias("a"), F.max("run").alias("b")).where("a < b")
    several = settled(unequal.select("anchor"), "several_runs")
    listed = (
        first.join(several, "anchor", "left_semi")
        .groupBy(F.col("at.doc_key").alias("doc_key"))
        .agg(F.collect_list(F.struct("anchor", "run", "at.start", "at.n")).alias("runs"))
    )
    passages = keyed.join(listed, "doc_key").mapInPandas(_passages, "anchor long, run long, doc_id long, passage binary")
    stretches = _earlier_in_first(passages).distinct()
    owners = first.select("anchor", "run", F.col("at.doc_id").alias("first_doc"))
    later = shared.join(owners, ["anchor", "run"]).where("doc_id > first_doc").select("doc_key", "start", "n")
    own = (
        shared.join(stretches.withColumnRenamed("n", "m"), ["anchor", "run", "doc_id"])
        .select("doc_key", (F.col("start") + F.col("skip")).cast("int").alias("start"), F.col("m").alias("n"))
    )
    return later.unionByName(own).groupBy("doc_key").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def _keep_mask(n_words: int, spans) -> np.ndarray:
    """False for each word that a listed window covers."""
    change = np.zeros(n_words + 1, np.int64)
    for s in spans:
        change[s["start"]] += 1
        change[s["start"] + s["n"] + WINDOW - 1] -= 1
    return np.cumsum(change[:-1]) == 0


def _cleaned(text: bytes, spans) -> tuple[bytes, int, int]:
    """The kept words, joined by one space, the number of words, and of those removed."""
    words = text.split()
    total = len(words)
    if spans is not None and len(spans):
        keep = _keep_mask(total, spans)
        words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
    return b" ".join(words), total, total - len(words)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text").to_pylist())
        rows = [_cleaned(*x) for x in zip(texts, batch.column("_spans").to_pylist(), strict=True)]
        total, gone = (pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))
        digest = pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), total, gone, digest], names=names)


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, texts = batch.schema.get_field_index("text"), []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
            if spans:
                text = _cleaned(text.encode(), spans)[0].decode()
            texts.append(text)
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))


def with_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with the windows (_spans) that repeat an earlier document.

    A null or empty text has no words. Rows without doc_id have no place in the order: they
    neither lose words nor take any from others. Rows with one doc_id count as one document,
    so they take nothing from each other. A document of fewer than 50 words keeps
    them all. Other columns pass through. No rows: an empty result.
    """
    keyed = docs.withColumn("_doc_key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(keyed.select(F.col("_doc_key").alias("doc_key"), "doc_id", "text"))
    return keyed.join(spans.toDF("_doc_key", "_spans"), "_doc_key", "left").drop("_doc_key")


def kept_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; see `with_repeats`."""
    rows = with_repeats(docs.select(F.col("doc_id").cast("bigint"), "text"))
    return rows.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`docs` without the words that repeat an earlier document; n_chars follows the text.

    All rows and columns stay; a text whose words all repeat becomes empty, and one that
    loses nothing keeps its white space too.
    """
    found = with_repeats(docs)
    out = found.mapInArrow(_shorten, found.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
