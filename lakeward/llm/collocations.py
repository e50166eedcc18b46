"""Collocations: phrases whose words meet more often than their parts alone would make them.

All suffixes of the pieces of text, to a depth of four words, are routed by their leading words to buckets and sorted there by
multikey three-way quicksort. A partition of equal words is a phrase and its size the phrase's count; partitions
that are too small are abandoned, since nothing below them can be frequent.

A bucket that turns out too large (one word may lead a third of all suffixes) is not sorted but dealt anew by one more
leading word; the counts of the leads that it had until then are summed aside.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import mixed, numbers, packed_numbers, utf8
from lakeward.operators.sizing import join_small
from lakeward.session import settled

# Words of a phrase, occurrences that it needs, unit of the scores, phrases shown of a language.
DEPTH, LEAST, UNIT, SHOWN = 4, 30, 2_000_000, 2000
# A phrase is left out if a longer one around it has so many hundredths of its occurrences.
COVERED = 80
# Bytes of text that are sorted together in a task, bytes of text for each bucket, and suffixes that are too many for one.
BLOCK_BYTES, BUCKET_BYTES, TOO_MANY = 16 << 20, 8 << 20, 2 << 20
# Partitions of fewer pointers are sorted at once.
SMALL = 1 << 12

# What ends a piece, and a byte that no text has.
ENDS, BREAK = b".,;:!?\x0a\x0b\x0c\x0d", b"\xff"
_ENDED = bytes.maketrans(ENDS, b"\n" * len(ENDS))
_PAYLOAD = "route long, lang string, words binary, suffixes binary, weights binary, size long"
_PHRASES = "lang string, depth int, phrase string, f long"


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all pieces of the texts, with a BREAK behind each piece."""
    return (b"\n".join(texts) + b"\n").lower().translate(_ENDED).replace(b"\n", b" " + BREAK + b" ").split()


def suffixes_of(word: np.ndarray) -> np.ndarray:
    """The first DEPTH words of the suffix at each word (0: a break), as columns; 0 behind the end of the piece."""
    starts = np.flatnonzero(word)
    padded = np.concatenate((word, np.zeros(DEPTH, word.dtype)))
    columns = np.empty((DEPTH, len(starts)), word.dtype)
    for d in range(DEPTH):
        columns[d] = padded[starts + d]
        if d:
            columns[d][columns[d - 1] == 0] = 0
    return columns


def combined(columns: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, each once, with their summed weights."""
    if not columns.shape[1]:
        return columns, weights
    order = np.lexsort(columns[::-1])
    columns = columns[:, order]
    start = np.flatnonzero(np.concatenate(([True], (columns[:, 1:] != columns[:, :-1]).any(axis=0))))
    return columns[:, start], np.add.reduceat(weights[order], start)


def _lead_hash(lang: str, names: np.ndarray, columns: np.ndarray, level: int) -> np.ndarray:
    """A number for the first `level` words of each suffix, the same in every task. `names` are the hashes of the words."""
    out = np.full(columns.shape[1], xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1), np.uint64)
    for d in range(level):
        out = mixed(out * np.uint64(31) + names[columns[d]])
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of the words; place 0, which is no word, has 0."""
    return np.fromiter((xxhash.xxh64_intdigest(w) if i else 0 for i, w in enumerate(words)), np.uint64, len(words))


def _payloads(lang: str, words: list[bytes], columns: np.ndarray, weights: np.ndarray, level: int, buckets: int) -> pa.RecordBatch:
    """The suffixes (in order, each once) dealt to buckets by their first `level` words, each bucket with its own words."""
    route = (_lead_hash(lang, _hashes(words), columns, level) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(route, kind="stable")
    bounds = np.searchsorted(route[order], np.arange(buckets + 1))
    rows = []
    for r in range(buckets):
        own = order[bounds[r] : bounds[r + 1]]
        if not len(own):
            continue
        used, local = np.unique(columns[:, own], return_inverse=True)
        if used[0]:  # place 0 is the end of a piece, also where no suffix is short
            used, local = np.concatenate(([0], used)), local + 1
        local, weight = local.reshape(DEPTH, -1), weights[own]
        rows.append((r, lang, zstandard.compress(b"\n".join(words[u] for u in used[1:].tolist())), packed_numbers(local), packed_numbers(weight), len(own)))
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    columns_out = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    names = [field.split()[0] for field in _PAYLOAD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns_out, kinds, strict=True)], names=names)


def _unpacked(words: bytes, suffixes: bytes, weights: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    return [BREAK, *zstandard.decompress(words).split(b"\n")], numbers(suffixes).reshape(DEPTH, -1), numbers(weights).astype(np.int64)


def _routed(buckets: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in texts.items():
                number: dict[bytes, int] = defaultdict(count().__next__)
                number[BREAK]  # noqa: B018 - takes place 0
                word = np.concatenate([np.fromiter(map(number.__getitem__, words_of([t])), np.int32) for t in own])
                columns = suffixes_of(word)
                n = columns.shape[1]
                if not n:
                    continue
                columns, weights = combined(columns, np.ones(n, np.int64))
                yield _payloads(lang, list(number), columns, weights, 1, buckets)
                # All words of the block, under a route that is no bucket.
                total = [[-1], [lang], [b""], [b""], [b""], [n]]
                kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
                names = [field.split()[0] for field in _PAYLOAD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(total, kinds, strict=True)], names=names)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text").to_pylist()), strict=True):
                texts.setdefault(lang, []).append(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield from flush()
                    texts, size = {}, 0
        yield from flush()

    return read


def frequent(columns: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a suffix that begins with it, words, occurrences) of each phrase with `least` occurrences.

    Multikey three-way quicksort of pointers: a partition is split by one word into smaller, equal and larger
    ones. The equal ones are sorted on by their next word, the others by the same. Partitions of less weight are abandoned.
    """
    todo = [(np.arange(columns.shape[1]), 0)]
    while todo:
        pointer, d = todo.pop()
        key = columns[d][pointer]
        if len(pointer) <= SMALL:
            order = np.argsort(key, kind="stable")
            pointer, key = pointer[order], key[order]
            start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sums = np.add.reduceat(weights[pointer], start)
            stop = np.concatenate((start[1:], [len(key)]))
            equal = [(pointer[start[i] : stop[i]], int(sums[i])) for i in np.flatnonzero((sums >= least) & (key[start] > 0)).tolist()]
        else:
            some = np.sort(key[:: max(1, len(key) // 9)])
            pivot = some[len(some) // 2]
            for rest in (pointer[key < pivot], pointer[key > pivot]):
                if len(rest) and weights[rest].sum() >= least:
                    todo.append((rest, d))
            middle = pointer[key == pivot]
            total = int(weights[middle].sum())
            equal = [(middle, total)] if pivot > 0 and total >= least else []
        for own, total in equal:
            yield int(own[0]), d + 1, total
            if d + 1 < DEPTH:
                todo.append((own, d + 1))


def _sorted_bucket(level: int, least: int):
    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        for lang, own in rows.groupby("lang", sort=False):
            number: dict[bytes, int] = defaultdict(count().__next__)
            number[BREAK]  # noqa: B018 - takes place 0
            parts, weights = [], []
            for words, suffixes, weight in zip(own["words"], own["suffixes"], own["weights"], strict=True):
                names, columns, w = _unpacked(words, suffixes, weight)
                place = np.fromiter(map(number.__getitem__, names), np.int32, len(names))
                parts.append(place[columns])
                weights.append(w)
            columns, names = np.concatenate(parts, axis=1), list(number)
            parts.clear()
            for at, depth, f in frequent(columns, np.concatenate(weights), least):
                if depth >= level:
                    found.append((lang, depth, b" ".join(names[i] for i in columns[:depth, at].tolist()).decode("utf-8"), f))
        return pd.DataFrame(found, columns=["lang", "depth", "phrase", "f"]).astype(object)

    return sort


def _leads(level: int):
    """Counts of the first `level` words in each row of a bucket that is dealt anew."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["lang", "words", "suffixes", "weights"]).to_pylist():
                names, columns, weights = _unpacked(row["words"], row["suffixes"], row["weights"])
                columns = columns.copy()
                columns[level:] = 0
                columns, weights = combined(columns, weights)
                whole = columns[level - 1] > 0
                phrases = [b" ".join(names[i] for i in c).decode("utf-8") for c in columns[:level, whole].T.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["lang"]] * len(phrases), pa.string()),
                        pa.array([level] * len(phrases), pa.int32()),
                        pa.array(phrases, pa.string()),
                        pa.array(weights[whole], pa.int64()),
                    ],
                    names=["lang", "depth", "phrase", "f"],
                )

    return read


def _dealt_anew(level: int, buckets: int):
    """The suffixes of a bucket with more than `level` words, routed by one more of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["lang", "words", "suffixes", "weights"]).to_pylist():
                names, columns, weights = _unpacked(row["words"], row["suffixes"], row["weights"])
                on = columns[level] > 0
                yield _payloads(row["lang"], names, columns[:, on], weights[on], level + 1, buckets)

    return read


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, depth, phrase, f) of all phrases of up to DEPTH words with `least` occurrences, and (lang, n): all words.

    `docs` (lang, text). Each round sorts the buckets that are small enough and deals the others anew; the last one
    knows all words of a suffix, so that only equal suffixes, which were summed before, can meet in its buckets.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    rows = settled(docs.mapInArrow(_routed(buckets), _PAYLOAD), "suffixes")
    totals = rows.where("route < 0").groupBy("lang").agg(F.sum("size").alias("n"))
    rows, found = rows.where("route >= 0"), []

    def sort(part: DataFrame, level: int) -> DataFrame:
        # A task for each bucket: several in one would hold their rows at once.
        return settled(part.repartition(buckets, "route").groupBy("route").applyInPandas(_sorted_bucket(level, least), _PHRASES), "phrases")

    for level in range(1, DEPTH + 1):
        sizes = settled(rows.groupBy("route").agg(F.sum("size").alias("total")), "sizes")
        large = sizes.where(F.col("total") > TOO_MANY).select(F.col("route").alias("large"))
        n, among = sizes.where(F.col("total") > TOO_MANY).agg(F.count(F.lit(1)), F.coalesce(F.sum("total"), F.lit(0))).first()
        if not n or level == DEPTH:
            found.append(sort(rows, level))
            break
        marked = join_small(rows, large, F.col("route"), "large", "left")
        small, rest = marked.where("large is null").drop("large"), marked.where("large is not null").drop("large")
        found.append(sort(small, level))
        leads = rest.mapInArrow(_leads(level), _PHRASES).groupBy("lang", "depth", "phrase").agg(F.sum("f").alias("f"))
        found.append(settled(leads.where(F.col("f") >= least), "leads"))
        buckets = max(1, -(-4 * among // TOO_MANY))
        rows = settled(rest.mapInArrow(_dealt_anew(level, buckets), _PAYLOAD), "suffixes")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out, totals


def _part(first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _key(phrase: Column) -> Column:
    """A phrase of a language as one key; a phrase has no line break."""
    return F.concat(F.col("lang"), F.lit("\n"), phrase)


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """`candidates` (lang, depth, phrase, f) without those inside a longer one that has `covered` hundredths of their occurrences."""
    longer = candidates.where("depth > 2").withColumn("length", F.explode(F.expr("sequence(2, depth - 1)")))
    inner = longer.withColumn("start", F.explode(F.expr("sequence(1, depth - length + 1)")))
    around = inner.select("lang", _part(F.col("start"), F.col("length")).alias("phrase"), F.col("f").alias("outer"))
    most = around.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    wide = lambda c, factor: F.col(c).cast("decimal(20,0)") * F.lit(factor).cast("decimal(10,0)")
    kept = F.coalesce(wide("outer", 100) < wide("f", covered), F.lit(True))
    return candidates.join(most, ["lang", "phrase"], "left").where(kept).drop("outer")


def scored(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """`candidates` (lang, depth, phrase, f) with the score of their lowest-scoring cut: lang, phrase, a, l, r, score."""
    counts = phrases.select(_key(F.col("phrase")).alias("key"), "f")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, depth - 1)")))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", _part(1, F.col("k")).alias("head"), _part(F.col("k") + 1, F.col("depth") - F.col("k")).alias("tail"))
    left = join_small(cuts, counts.withColumnsRenamed({"key": "head_key", "f": "l"}), _key(F.col("head")), "head_key", "inner")
    both = join_small(left, counts.withColumnsRenamed({"key": "tail_key", "f": "r"}), _key(F.col("tail")), "tail_key", "inner")
    over = F.lit(UNIT).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
    under = F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)")
    best = F.min(F.struct(F.call_function("div", over, under).alias("score"), "k", "l", "r")).alias("best")
    return both.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, shown: int = SHOWN) -> DataFrame:
    """The first `shown` collocations of each language of `docs` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Null texts are empty; null languages are `und`. A repeated row counts again. Equal scores are ordered by occurrences, then by
    phrase. A language without frequent phrases has no rows. Other columns are not read. No rows: an empty result.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    phrases, totals = phrase_counts(rows, least)
    candidates = settled(uncovered(phrases.where("depth > 1")), "candidates")
    ranked = settled(scored(candidates, phrases), "scored")
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # A language may have a third of all candidates: parts of it are ranked before the best of each meet.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranked.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    first = dealt.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= shown)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= shown)
    known = join_small(last, totals.withColumnRenamed("lang", "of"), F.col("lang"), "of", "inner")
    return known.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
lengths AS (SELECT unnest([1, 2, 3, 4]) AS depth),
grams AS (
  SELECT lang, depth, unnest(list_transform(range(1, len(w) - depth + 2), lambda i: array_to_string(w[i:i + depth - 1], ' '))) AS phrase
  FROM words, lengths WHERE len(w) >= depth),
phrases AS (SELECT lang, depth, phrase, count(*) AS f FROM grams GROUP BY lang, depth, phrase HAVING count(*) >= 30),
candidates AS (SELECT lang, depth, phrase, string_split(phrase, ' ') AS w, f FROM phrases WHERE depth > 1),
inside AS (
  SELECT c.lang, array_to_string(w[s.start:s.start + s.size - 1], ' ') AS phrase, max(f) AS around
  FROM candidates c, (SELECT unnest([1, 2, 3, 1, 2]) AS start, unnest([2, 2, 2, 3, 3]) AS size) s
  WHERE s.size < depth AND s.start + s.size - 1 <= depth GROUP BY 1, 2),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.around IS NULL OR 100::HUGEINT * i.around < 80::HUGEINT * c.f),
cuts AS (
  SELECT k.lang, k.phrase, k.f AS a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * k.f) // (l.f + r.f) AS score
  FROM kept k JOIN (SELECT unnest([1, 2, 3]) AS cut) ON cut < k.depth
  JOIN phrases l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:cut], ' ')
  JOIN phrases r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[cut + 1:k.depth], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, cast(n AS BIGINT) AS n, cast(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
