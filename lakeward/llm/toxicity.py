"""Toxicity of whole texts: disguised words are restored, then scored by what labelled texts hold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import SpanHash, mixed, slices
from lakeward.llm.noisy import character_model, restored, tokens
from lakeward.session import settled

# The classifier is fitted on about so many labelled rows at most, chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
FOLDS = 5
BUCKETS = 1 << 20
# Letters of the beginnings of words that are features, and of the pieces inside them.
PREFIXES, PIECE = range(3, 9), 5
# Standard errors by which the evidence of a feature is lowered, and the toxic texts that it needs.
CAUTION, LEAST_TOXIC = 1.0, 2
# Tokens whose score a task remembers.
REMEMBERED = 300_000


def held_out(doc_id: Column) -> Column:
    """Rows that the labels must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each feature: the whole word, its beginnings, and the pieces inside it."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.concatenate(([0], np.cumsum(length)[:-1])).astype(np.int64)
    spans, index = SpanHash(codes + np.uint64(1)), np.arange(len(words))
    owners, hashes = [index], [spans.of(start, start + length) ^ np.uint64(1)]
    for n in PREFIXES:
        of = index[length >= n]
        owners.append(of)
        hashes.append(spans.of(start[of], start[of] + n) ^ np.uint64(2))
    at = np.arange(max(0, len(codes) - PIECE + 1))
    owner = np.searchsorted(start, at, side="right") - 1
    inside = at + PIECE <= start[owner] + length[owner] if len(at) else np.zeros(0, bool)
    owners.append(owner[inside])
    hashes.append(spans.of(at[inside], at[inside] + PIECE) ^ np.uint64(3))
    return np.concatenate(owners), (mixed(np.concatenate(hashes)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _words_of(found: set[str], costs: np.ndarray, memory: dict[str, list[str]]) -> set[str]:
    out: set[str] = set()
    for token in found:
        words = memory.get(token)
        if words is None:
            if len(memory) > REMEMBERED:
                memory.clear()
            words = memory[token] = restored(token, costs)
        out.update(words)
    return out


def _counted(costs: np.ndarray):
    """Of each bucket, the documents that have it, by fold and label."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2 * FOLDS, BUCKETS), np.int32)
        rows = np.zeros(2 * FOLDS, np.int64)
        memory: dict[str, list[str]] = {}
        for batch in batches:
            for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"], strict=True):
                cell = int(fold) * 2 + int(toxic)
                rows[cell] += 1
                words = list(_words_of(tokens(text or ""), costs, memory))
                if words:
                    seen[cell, np.unique(word_features(words)[1])] += 1
        found = np.flatnonzero(seen.any(axis=0))
        # The numbers of documents stand beside the buckets, as one of their own.
        cells = [*seen[:, found].T.tolist(), rows.tolist()]
        yield pd.DataFrame({"bucket": [*found.tolist(), -1], "cell": cells})

    return count


def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """How much more often toxic texts have each feature, as a cautious logarithm of odds; 0 if not surely."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return np.where(toxic >= LEAST_TOXIC, np.maximum(odds - CAUTION * error, 0), 0).astype(np.float32)


@dataclass
class Summary:
    """What a text is judged by: its two worst words and how many it has."""

    weights: np.ndarray
    costs: np.ndarray

    def __post_init__(self):
        self.memory: dict[str, float] = {}

    def _learn(self, missing: list[str]) -> None:
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        words, owner = [], []
        for i, token in enumerate(missing):
            for word in restored(token, self.costs):
                words.append(word)
                owner.append(i)
        score = np.zeros(len(missing), np.float32)
        if words:
            of, bucket = word_features(words)
            np.maximum.at(score, np.asarray(owner)[of], self.weights[bucket])
        self.memory.update(zip(missing, score.tolist(), strict=True))

    def of(self, texts: list[str]) -> np.ndarray:
        found = [tokens(t) for t in texts]
        known = self.memory
        missing = {t for f in found for t in f if t not in known}
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = set().union(*found)
        if missing:
            self._learn(sorted(missing))
        out = np.zeros((len(texts), 3))
        for i, f in enumerate(found):
            if f:
                scores = [known[t] for t in f]
                first = max(scores)
                out[i, 0] = first
                if first:
                    out[i, 1] = sorted(scores)[-2] if len(scores) > 1 else 0.0
                out[i, 2] = np.log1p(len(f))
        return out


def _sliced(texts: list[str], summary: Summary) -> np.ndarray:
    parts = [summary.of(texts[a:b]) for a, b in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, 3))


@dataclass
class ToxicityModel:
    costs: np.ndarray
    weights: np.ndarray
    # Of the logistic function: intercept, then one for each column of the summary.
    line: np.ndarray

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.line[0] + summary @ self.line[1:], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method. With one label only, that label's smoothed share."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-6
        return np.array([np.log(share / (1 - share)), *np.zeros(x.shape[1])])
    design = np.column_stack((np.ones(len(x)), x))
    ridge = np.diag([1e-6, *np.full(x.shape[1], 0.05)])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model of labels.toxic, learned from rows that are not held out.

    The language model counts the texts of all documents. The classifier is fitted on a sample of
    about `train_rows` labelled documents, each with the first of its texts. Rows without doc_id or label are not
    learned from; of several labels of a document the worst counts. Texts are the only input.
    """
    spark = docs.sparkSession
    costs = character_model(docs)
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    steps = 1 << 20
    kept = min(steps, steps * train_rows // max(1, known.count()))
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(steps))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(FOLDS)).cast("int")
    # About `train_rows` rows of three numbers: small at any size of the input. Of the rows of one doc_id one is learned from.
    drawn = F.broadcast(known.where(place < kept).withColumn("fold", fold))
    sample = docs.where("doc_id is not null").select("doc_id", "text").join(drawn, "doc_id")
    sample = settled(sample.groupBy("doc_id", "toxic", "fold").agg(F.min("text").alias("text")).select("text", "toxic", "fold"), "sample")
    cells = [F.sum(F.col("cell")[i]).alias(f"c{i}") for i in range(2 * FOLDS)]
    in_toxic = sum((F.col(f"c{2 * f + 1}") for f in range(FOLDS)), F.lit(0))
    # Only features of at least LEAST_TOXIC toxic texts have a weight.
    counted = (
        sample.mapInPandas(_counted(costs), "bucket long, cell array<int>")
        .groupBy("bucket")
        .agg(*cells)
        .where((in_toxic >= LEAST_TOXIC) | (F.col("bucket") < 0))
        .toPandas()
    )
    counts = counted.drop(columns="bucket").to_numpy(np.float64).reshape(-1, FOLDS, 2)
    bucket = counted["bucket"].to_numpy()
    rows = counts[bucket == -1].sum(axis=0)
    bucket, counts = bucket[bucket >= 0], counts[bucket >= 0]

    def weights(left_out: int | None) -> np.ndarray:
        use = [f for f in range(FOLDS) if f != left_out]
        c, n = counts[:, use].sum(axis=1), rows[use].sum(axis=0)
        out = np.zeros(BUCKETS, np.float32)
        out[bucket] = _evidence(c[:, 1], c[:, 0], n[1], n[0])
        return out

    # Each row is summed up by what the other folds say, as a new text will be.
    shared = spark.sparkContext.broadcast((costs, [weights(f) for f in range(FOLDS)]))

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs, by_fold = shared.value
        summaries = [Summary(w, costs) for w in by_fold]
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                s = _sliced([t or "" for t in part["text"]], summaries[fold])
                yield pd.DataFrame({"a": s[:, 0], "b": s[:, 1], "c": s[:, 2], "toxic": part["toxic"].to_numpy()})

    found = sample.mapInPandas(summed, "a double, b double, c double, toxic int").toPandas()
    shared.unpersist()
    found = found.sort_values(list(found.columns))
    line = _logistic(found[["a", "b", "c"]].to_numpy(np.float64), (found["toxic"] > 0).to_numpy(np.float64))
    return ToxicityModel(costs, weights(None), line)


def with_scores(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """`docs` with the score of its text column; null and empty texts score as texts without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        summary = Summary(model.weights, model.costs)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            score = model.score(_sliced(texts, summary))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    schema = docs.select("*", F.lit(0.0).cast("double").alias(name)).schema
    return docs.mapInArrow(scored, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text).

    Without documents the result is empty; without toxic labels no text is predicted toxic.
    Repeated rows are scored alike. Other columns are not read. A row without doc_id is not held out.
    """
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns."""
    return with_scores(docs, fit(docs, labels), "_toxicity").where("_toxicity < 0.5").drop("_toxicity")
