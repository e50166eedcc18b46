"""How the sources of a language differ in the terms that they use, from counts of white-space chunks.

Texts are cut at white space alone, in blocks; each block gives each distinct chunk once with its counts. Each chunk that
is distinct among all texts is then cut into terms once, and its terms are joined back to the counts.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import numbers, packed_numbers
from lakeward.operators.sizing import join_small
from lakeward.session import settled

# Documents of a language that must hold a term, added counts, unit of the shares, and terms shown of a group.
LEAST, ADDED, UNIT, SHOWN = 30, 5, 1_000_000_000, 50
# Bytes of text whose chunks are counted together in a task, and bytes of text for each bucket of chunks.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
# Cells (sources x terms) of a language that are compared in one group, at least the square of the sources.
CELLS = 1 << 14

# The chunks of a block in one bucket, by language: their names, documents, ids of documents where they are few, and for each
# chunk the number of its sources, these (places in `sources`) and its occurrences in each.
_BLOCKS = "bucket long, lang string, sources array<string>, chunks binary, documents binary, ids binary, spread binary, used binary, times binary, first long"
_TERMS = "bucket long, lang string, chunk string, term string, times long, documents long"
_FOUND = "lang string, source string, term string, n long, id long"
# Letters A-Z in lower case; every other ASCII character ends a term.
_LETTERS = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))


def _starts(key: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))


def _counted(
    langs: list[str], sources: list[str], parts: list[np.ndarray], counts: list[np.ndarray], names: list[bytes], first_id: int, least: int, buckets: int
) -> Iterator[tuple]:
    """The distinct chunks of a block by language and bucket. `parts` has the distinct chunks (places in `names`) of each document,
    `counts` their occurrences."""
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    width, chunk, times = len(names), np.concatenate(parts), np.concatenate(counts)
    bucket = np.fromiter((xxhash.xxh64_intdigest(name) % buckets for name in names), np.int64, width)
    # Chunks in the order of their bucket, then of their names, which are alike side by side.
    order = sorted(range(width), key=names.__getitem__)
    order = np.array(order, np.int64)[np.argsort(bucket[order], kind="stable")]
    place = np.empty(width, np.int32)
    place[order] = np.arange(width)
    lang_of, lang = np.unique(np.array(langs, object), return_inverse=True)
    source_of, source = np.unique(np.array(sources, object), return_inverse=True)
    # Small numbers are sorted faster.
    source, lang = source.astype(np.min_scalar_type(len(source_of))), lang.astype(np.min_scalar_type(len(lang_of)))
    rows = np.lexsort((source[doc], place[chunk], lang[doc]))
    doc, chunk, times = doc[rows], chunk[rows], times[rows]
    key = lang[doc].astype(np.int64) * width + place[chunk]
    start = _starts(key)
    documents = np.diff(np.concatenate((start, [len(key)])))
    few = documents < least
    ids, id_end = doc[np.repeat(few, documents)], np.cumsum(np.where(few, documents, 0))
    each = _starts(key * len(source_of) + source[doc])
    used, totals = source[doc[each]], np.add.reduceat(times, each)
    use_end = np.searchsorted(each, np.concatenate((start[1:], [len(key)])))
    spread = np.diff(np.concatenate(([0], use_end)))
    own, of_lang = chunk[start], key[start] // width
    cuts = np.concatenate((_starts(of_lang * buckets + bucket[own]), [len(start)]))
    for a, b in itertools.pairwise(cuts.tolist()):
        i, u = (slice(int(end[a - 1]) if a else 0, int(end[b - 1])) for end in (id_end, use_end))
        yield (
            int(bucket[own[a]]), lang_of[of_lang[a]], source_of.tolist(), zstandard.compress(b"\n".join(names[c] for c in own[a:b].tolist())),
            packed_numbers(documents[a:b]), packed_numbers(ids[i]), packed_numbers(spread[a:b]), packed_numbers(used[u]), packed_numbers(totals[u]), first_id,
        )


def _chunks(least: int, buckets: int):
    kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), *[pa.binary()] * 6, pa.int64()]
    names = [field.split()[0] for field in _BLOCKS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_id = TaskContext.get().partitionId() << 33
        langs, sources, parts, counts, size = [], [], [], [], 0
        number: dict[bytes, int] = defaultdict(count().__next__)

        def block() -> pa.RecordBatch:
            columns = zip(*_counted(langs, sources, parts, counts, list(number), first_id, least, buckets), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            # The bytes of one text at a time, not the texts of a batch.
            texts = batch.column("text").cast(pa.binary())
            for lang, source, held in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
                text = held.as_py() or b""
                chunks = Counter(text.split())
                if not chunks:
                    continue
                langs.append(lang)
                sources.append(source)
                parts.append(np.fromiter(map(number.__getitem__, chunks), np.int32, len(chunks)))
                counts.append(np.fromiter(chunks.values(), np.int32, len(chunks)))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield block()
                    first_id += len(parts)
                    langs, sources, parts, counts, size = [], [], [], [], 0
                    number = defaultdict(count().__next__)
        if parts:
            yield block()

    return read


def chunk_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, int]:
    """The chunks of blocks of texts, dealt to buckets by their names, with documents, their ids if they are fewer than
    `least`, and occurrences by source; and the number of buckets."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    return docs.select("lang", "source", "text").mapInArrow(_chunks(least, buckets), _BLOCKS), buckets


def terms_of(chunk: bytes) -> dict[str, int]:
    """The terms of a chunk, counted."""
    return Counter(chunk.translate(_LETTERS).decode("utf-8").split(" "))


def _cut(rows: pd.DataFrame) -> pd.DataFrame:
    """The terms of the chunks of a bucket, each cut once, with the documents of the chunk by language."""
    held: dict[bytes, dict[str, int]] = defaultdict(dict)
    for lang, chunks, documents in zip(rows["lang"], rows["chunks"], rows["documents"], strict=True):
        for chunk, n in zip(zstandard.decompress(chunks).split(b"\n"), numbers(documents).tolist(), strict=True):
            of = held[chunk]
            of[lang] = of.get(lang, 0) + n
    bucket, out = rows["bucket"].iloc[0], []
    for chunk, of in held.items():
        name = chunk.decode("utf-8")
        for term, times in terms_of(chunk).items():
            if term:
                out += [(bucket, lang, name, term, times, n) for lang, n in of.items()]
    return pd.DataFrame(out, columns=["bucket", "lang", "chunk", "term", "times", "documents"]).astype(object)


def _joined(blocks: pd.DataFrame, wanted: pd.DataFrame, least: int) -> pd.DataFrame:
    """Occurrences by source of the wanted terms of a bucket, and the documents of the chunks of doubtful ones."""
    terms: dict[str, dict[bytes, list]] = defaultdict(dict)
    for lang, chunk, term, times, doubtful in wanted[["lang", "chunk", "term", "times", "doubtful"]].itertuples(index=False):
        terms[lang].setdefault(chunk.encode(), []).append((term, times, doubtful))
    sums: dict[tuple[str, str, str], int] = defaultdict(int)
    documents: set[tuple[str, str, int]] = set()
    for row in blocks.itertuples(index=False):
        known = terms.get(row.lang, {})
        names = zstandard.decompress(row.chunks).split(b"\n")
        n, spread, used, times = (numbers(x).astype(np.int64) for x in (row.documents, row.spread, row.used, row.times))
        ids, end = numbers(row.ids).astype(np.int64), np.cumsum(spread)
        few = np.cumsum(np.where(n < least, n, 0))
        for i, name in enumerate(names):
            for term, within, doubtful in known.get(name, ()):
                for u in range(int(end[i] - spread[i]), int(end[i])):
                    sums[row.lang, row.sources[used[u]], term] += within * int(times[u])
                if doubtful:
                    documents.update((row.lang, term, int(d) + row.first) for d in ids[few[i] - n[i] : few[i]])
    out = [(lang, source, term, n, None) for (lang, source, term), n in sums.items()]
    out += [(lang, None, term, None, d) for lang, term, d in documents]
    return pd.DataFrame(out, columns=["lang", "source", "term", "n", "id"]).astype({"lang": object, "source": object, "term": object, "n": "Int64", "id": "Int64"})


def term_counts(blocks: DataFrame, buckets: int, least: int = LEAST) -> DataFrame:
    """(lang, source, term, n) of the terms that stand in `least` documents of a language.

    A term stands in at least as many documents as its commonest chunk, and at most in as many as all its chunks
    together. Only where these two do not decide are its documents counted one by one; each chunk of such a term
    stands in fewer than `least` documents, so there are few and no key is hot.
    """
    dealt = blocks.repartition(buckets, "bucket").groupBy("bucket")
    terms = settled(dealt.applyInPandas(_cut, _TERMS), "terms")
    highest = F.sum("documents").alias("high")
    bounds = terms.groupBy("lang", "term").agg(F.max("documents").alias("low"), highest).where(F.col("high") >= least)
    bounds = settled(bounds.select("lang", "term", (F.col("low") < least).alias("doubtful")), "bounds")
    wanted = terms.join(bounds, ["lang", "term"]).repartition(buckets, "bucket").groupBy("bucket")
    found = settled(dealt.cogroup(wanted).applyInPandas(lambda a, b: _joined(a, b, least), _FOUND), "found")
    exact = found.where("id is not null").select("lang", "term", "id").distinct().groupBy("lang", "term").agg(F.count(F.lit(1)).alias("held"))
    few = exact.where(F.col("held") < least).select("lang", "term")
    summed = found.where("n is not null").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    return summed.join(few, ["lang", "term"], "left_anti")


def _share(occurrences: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (occurrences + ADDED) / (total + ADDED * terms)), exact beyond 64 bits."""
    over = (occurrences + ADDED).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    under = (total + F.lit(ADDED) * terms).cast("decimal(20,0)")
    return F.call_function("div", over, under) + 1


def _distances(rows: pd.DataFrame) -> pd.DataFrame:
    """The distances between the sources of a language, over the terms of one bucket."""
    heads = rows[rows["term"].isna()].sort_values("source")
    cells = rows[rows["term"].notna()]
    names, base = heads["source"].to_numpy(object), heads["share"].to_numpy(np.int64)
    place = {name: i for i, name in enumerate(names)}
    term, known = pd.factorize(cells["term"])
    shares = np.repeat(base[:, None], len(known), axis=1)
    shares[cells["source"].map(place).to_numpy(np.int64), term] = cells["share"].to_numpy(np.int64)
    n = len(names)
    apart = np.array([np.abs(shares - own).sum(axis=1) for own in shares], np.int64).reshape(n, n)
    source, item = np.nonzero(~np.eye(n, dtype=bool))
    lang = heads["lang"].iloc[0]
    return pd.DataFrame({"lang": [lang] * len(source), "source": names[source], "item": names[item], "part_value": apart[source, item]}).astype({c: object for c in ("lang", "source", "item")})


def pair_distances(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value): the summed distance of the shares of two sources of a language over its kept terms.

    `groups` (lang, source, absent: the share of a term that the source lacks, buckets) and `cells` (lang, source, term, share: those
    that it has, buckets). The terms of a language are dealt to buckets of a bounded number of cells. A bucket
    compares all sources of the language over its terms, so nothing is paired term by term.
    """
    heads = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("share"),
        F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
    )
    dealt = cells.withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")).select(heads.columns)
    parts = heads.unionByName(dealt).groupBy("lang", "bucket").applyInPandas(
        _distances, "lang string, source string, item string, part_value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("value"))


def _pair(first: str, second: str) -> Column:
    """Two texts as one key."""
    return F.concat(F.length(first).cast("string"), F.lit(":"), F.col(first), F.col(second))


def divergence(docs: DataFrame, least: int = LEAST, shown: int = SHOWN) -> DataFrame:
    """How the (lang, source) groups of `docs` (lang, source, text) differ: lang, source, part, item, value, rank.

    Part `pair` has each other source of the language with its distance, part `term` the terms that the group uses
    more than the language, the first `shown` of them. Null texts, languages and sources are empty ones. A repeated row is a document of
    its own, with or without doc_id. A group without terms has all shares alike; a language without kept terms has distances 0. Equal values are
    ordered by item. Other columns are not read. No rows: an empty result.
    """
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    blocks, buckets = chunk_counts(rows, least)
    by_term = term_counts(settled(blocks, "chunks"), buckets, least)
    # One row per source of the language in such a window.
    in_lang = F.sum("n").over(Window.partitionBy("lang", "term"))
    cells = settled(by_term.withColumn("lang_n", in_lang), "cells")

    found = rows.select("lang", "source").distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = found.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    known = sizes.join(cells.groupBy("lang").agg(F.count_distinct("term").alias("v")), "lang", "left").join(of_lang, "lang", "left")
    v, n = F.coalesce("v", F.lit(0)), F.coalesce("total", F.lit(0))
    cells_of = F.col("sources") * F.col("v") / F.greatest(F.lit(CELLS), F.col("sources") * F.col("sources"))
    per_lang = known.withColumn("v", v).withColumn("buckets", F.greatest(F.lit(1), F.ceil(cells_of)).cast("int"))
    with_totals = found.join(totals, ["lang", "source"], "left").withColumn("total", n)
    groups = join_small(with_totals, per_lang.withColumnRenamed("lang", "of"), F.col("lang"), "of", "inner").drop("of")
    empty = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v"))).otherwise(0)
    groups = settled(groups.withColumn("absent", empty).withColumn("key", _pair("lang", "source")), "groups")

    facts = groups.select("key", "total", "lang_total", "v", "buckets")
    told = join_small(cells, facts, _pair("lang", "source"), "key", "inner")
    share, usual = _share(F.col("n"), F.col("total"), F.col("v")), _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    told = settled(told.select("lang", "source", "term", "buckets", share.alias("share"), usual.alias("usual")), "shares")

    pairs = pair_distances(groups, told).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    more = told.where(F.col("share") > F.col("usual"))
    words = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pairs, words)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= shown))


AUDIT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
used AS (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
  FROM groups g LEFT JOIN cells c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
usual AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (max(t.lang_total) + 5 * max(v)) AS q
  FROM cells JOIN sizes USING (lang) JOIN (SELECT lang, sum(total) AS lang_total FROM totals GROUP BY lang) t USING (lang)
  GROUP BY lang, term),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.total + 5 * v) AS p
  FROM totals t JOIN kept k ON t.lang = k.lang JOIN sizes s ON t.lang = s.lang
  LEFT JOIN cells c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, p - q FROM shares s JOIN usual u ON s.lang = u.lang AND s.term = u.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts)
SELECT lang, source, part, item, cast(value AS BIGINT) AS value, cast(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 50
"""
