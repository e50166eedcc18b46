"""Quality by importance resampling: documents are drawn by how much likelier target texts make them.

Two bags of hashed words and word pairs are counted, one of target texts, one of all texts. The
logarithm of their ratio, summed over a document, is its importance; with Gumbel noise
added, the largest values are a sample without replacement in proportion to the importances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import hashed_words, mixed, slices, utf8, with_index
from lakeward.llm.toxicity import held_out
from lakeward.operators.sizing import join_small
from lakeward.session import settled

BUCKETS = 10_000
# Added to each bucket of both bags.
SMOOTHING = 1.0


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each word and of each pair of neighbouring words, letters A-Z in lower case."""
    words, bounds = hashed_words([t.lower() for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pair = mixed(words[:-1] * np.uint64(31) + words[1:]) if len(words) > 1 else words[:0]
    same = owner[1:] == owner[:-1]
    bucket = (np.concatenate((words, pair[same])) % np.uint64(BUCKETS)).astype(np.int64)
    return np.concatenate((owner, owner[1:][same])), bucket


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        texts, wanted = utf8(batch["text"]), batch["wanted"].to_numpy(bool)
        for a, b in slices(texts):
            owner, bucket = grams(texts[a:b])
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[wanted[a:b][owner]], minlength=BUCKETS)
    found = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": found, "raw": raw[found], "target": target[found]})


def log_ratios(rows: DataFrame) -> np.ndarray:
    """The logarithm of target over raw share of each bucket, from all of `rows` (text, wanted)."""
    bags = rows.mapInPandas(_bags, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = bags.toPandas()  # at most BUCKETS rows
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[found["bucket"]] += found["raw"]
    target[found["bucket"]] += found["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _weighed(ratios: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text").to_pylist())
            parts = []
            for a, b in slices(texts):
                owner, bucket = grams(texts[a:b])
                parts.append(np.bincount(owner, weights=ratios[bucket], minlength=b - a))
            weight = pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), weight], names=["doc_id", "digest", "log_weight"])

    return weigh


def gumbel(*seed: Column) -> Column:
    """Standard Gumbel noise that follows from the seed."""
    u = (F.pmod(F.xxhash64(*seed, F.lit("gumbel")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The documents drawn from `docs` (doc_id, text): doc_id, log_weight, key, held_out.

    Target texts are the documents labelled quality 1, without the held-out fold. Drawn are `share` of all rows, by default the
    share of quality 1 among the labels that may be used. Null and empty texts have weight 0. Equal keys are ordered by doc_id.
    Rows without doc_id are drawn like any other, repeated rows together or one after the other. Without labels of quality 1 nothing is drawn; no rows: an empty result.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("quality") == 1).cast("int")), F.lit(0))).first()
    wanted = known.where("quality = 1").select(F.col("doc_id").alias("of"), F.lit(True).alias("wanted"))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    marked = join_small(rows, wanted, F.col("doc_id"), "of", "left").select("text", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    ratios = log_ratios(marked)
    own = rows.withColumn("digest", F.xxhash64("text"))
    weighed = own.mapInArrow(_weighed(ratios), "doc_id long, digest long, log_weight double")
    keyed = settled(weighed.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), F.col("digest"))), "keys")
    drawn = round(keyed.count() * (share if share is not None else good / n if n else 0)) if good else 0
    placed = with_index(keyed.select("doc_id", "log_weight", "key"), F.desc("key"), F.col("doc_id"), name="_place")
    return placed.where(F.col("_place") < drawn).select("doc_id", "log_weight", "key", held_out(F.col("doc_id")).alias("held_out"))
