"""Document fingerprints of closed syncmers, with DataFrame functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A k-mer is so many words; its inner substrings are its words. It is an anchor if the
# smallest hash of these is that of its first or its last word.
KMER = 3
# Anchors match if their places differ by so many words at most, or this share of the longer text.
SHIFT, SHIFT_SHARE = 16, 0.125
# Documents of one range of doc_id, and the most ranges.
RANGE_ROWS, RANGES = 1000, 2000

WORDS = r"[\x20\x09-\x0D]+"


def anchors(text: Column) -> Column:
    """The anchors of a text as an array of (hash, place), in the order of their hashes.

    Whether a k-mer is an anchor depends on its own words alone, so an edit touches only the anchors that
    span it. A text of fewer than KMER words is one anchor, of all its words; one
    without words has none.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), WORDS), lambda w: w != "")
    return F.transform(F.array(words), _anchors_of_words)[0]


def _anchors_of_words(words: Column) -> Column:
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(F.array(hashed), _anchors_of_hashes)[0]


def _anchors_of_hashes(hashed: Column) -> Column:
    n = F.size(hashed)

    def word(i: Column, offset: int) -> Column:
        return F.get(hashed, i + (offset - 1))

    def at_edge(i: Column) -> Column:
        inside = [word(i, j) for j in range(1, KMER - 1)]
        return F.least(word(i, 0), word(i, KMER - 1)) <= (F.least(*inside) if len(inside) > 1 else inside[0])

    def anchor(i: Column) -> Column:
        return F.struct(F.xxhash64(*(word(i, j) for j in range(KMER))).alias("h"), i.alias("p"))

    many = F.transform(F.filter(F.sequence(F.lit(1), n - (KMER - 1)), at_edge), anchor)
    whole = F.array(F.struct(F.xxhash64(hashed).alias("h"), F.lit(1).alias("p")))
    return F.when(n >= KMER, many).when(n > 0, whole).otherwise(F.slice(whole, 1, 0))


def sketch(text: Column) -> Column:
    """All anchors of a text in the order of their hashes, each hash once, at its first place."""
    found = F.array_sort(anchors(text))
    return F.transform(F.array(found), lambda a: _first_of_each(a))[0]


def _first_of_each(found: Column) -> Column:
    return F.filter(found, lambda x, i: (i == 0) | (x["h"] != F.get(found, i - 1)["h"]))


def written(marks: Column) -> Column:
    """A sketch as text: hash@place, from the smallest hash."""
    return F.array_join(F.transform(marks, lambda x: F.concat(F.lower(F.lpad(F.hex(x["h"]), 16, "0")), F.lit("@"), x["p"].cast("string"))), " ")


def likeness(a: Column, b: Column, tolerance: Column) -> Column:
    """The share of the anchors of both sketches together that both hold at like places.

    Two sketches without anchors are alike (1), one without is unlike any other (0). A hash stands once in a
    sketch, so one that both hold stands twice in a row when they are sorted together.
    """
    merged = F.array_sort(F.concat(a, b))
    return F.transform(F.array(merged), lambda m: _shared(m, tolerance))[0]


def _shared(merged: Column, tolerance: Column) -> Column:
    def again(x: Column, i: Column) -> Column:
        return (i > 0) & (x["h"] == F.get(merged, i - 1)["h"])

    common = F.filter(merged, again)
    near = F.filter(merged, lambda x, i: again(x, i) & (x["p"] - F.get(merged, i - 1)["p"] <= tolerance))
    both = F.size(merged) - F.size(common)
    return F.when(both == 0, 1.0).otherwise(F.size(near) / both)


def _ranges(docs: DataFrame) -> list[int]:
    """The largest doc_id of each range, falling; the first is the largest of all.

    A bounded summary of the doc_ids chooses them; every row is placed by them.
    """
    n, top = docs.agg(F.count("doc_id"), F.max("doc_id")).first()
    if not n:
        return []
    cuts = min(RANGES, math.ceil(n / RANGE_ROWS))
    shares = F.array(*(F.lit(i / cuts) for i in range(1, cuts)))
    inner = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * RANGES))).first()[0] if cuts > 1 else []
    return sorted({top, *inner}, reverse=True)


def with_next(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) with their sketch (own), and next_text and its sketch (following).

    The next document is that of the next smaller doc_id, after the last the first.

    Rows without doc_id come last; rows of one doc_id follow each other by a hash of their text. Each row is sent
    to its range of doc_ids; the largest doc_id of a range is sent to the range before it too,
    to end it, so that one shuffle of the texts is enough and no task holds all of them.
    """
    tops = _ranges(docs)
    last = len(tops)
    own = F.size(F.filter(F.array(*map(F.lit, tops)), lambda t: t >= F.col("doc_id"))) - 1 if tops else F.lit(0)
    own = F.coalesce(F.when(F.col("doc_id").isNotNull(), own), F.lit(last)).cast("int")
    has_unnamed = docs.where("doc_id is null").limit(1).count() > 0
    final = last if has_unnamed or not tops else last - 1
    is_top = F.col("doc_id").isin(tops) if tops else F.lit(False)
    # (range, kind): kind 0 is the row itself, 1 ends the range before, 2 ends the whole order.
    sent = F.filter(
        F.array(
            F.struct(own.alias("part"), F.lit(0).alias("kind")),
            F.when(is_top & (own > 0), F.struct((own - 1).alias("part"), F.lit(1).alias("kind"))),
            F.when(is_top & (own == 0), F.struct(F.lit(final).alias("part"), F.lit(2).alias("kind"))),
        ),
        lambda x: x.isNotNull(),
    )
    ends = docs.select("doc_id", "text", F.explode(sent).alias("to")).select("doc_id", "text", "to.*")
    if has_unnamed and tops:
        # The first row without doc_id ends the range of the smallest ones.
        first = docs.where("doc_id is null").orderBy(F.xxhash64("text")).limit(1)
        ends = ends.unionByName(first.select("doc_id", "text", F.lit(last - 1).alias("part"), F.lit(1).alias("kind")))
    if has_unnamed and not tops:
        first = docs.orderBy(F.xxhash64("text")).limit(1)
        ends = ends.unionByName(first.select("doc_id", "text", F.lit(last).alias("part"), F.lit(2).alias("kind")))
    order = Window.partitionBy("part").orderBy("kind", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    # The sketches are made where the ranges are, and read again for the document before.
    placed = ends.repartition("part").withColumn("own", sketch(F.col("text")))
    found = {"next_text": F.lead("text").over(order), "following": F.lead("own").over(order)}
    return placed.withColumns(found).where("kind = 0").drop("part", "kind")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of `docs` (doc_id, text), and their likeness after an edit.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text
    has its last third replaced by the beginning of the next document. Null and empty texts are empty, with an empty
    fingerprint. A single document is its own next. Repeated rows are documents that follow each other. Other columns
    are not read. No rows: an empty result.
    """
    rows = with_next(docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text")))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - third)"), F.expr("substring(next_text, 1, third)"))
    rows = rows.withColumn("n_chars", n).withColumn("third", third).withColumn("edited", edited)
    marked = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "own", sketch(F.col("edited")).alias("changed"), "following",
    )
    # Words are at least two characters with their space, as a bound of places.
    tolerance = F.greatest(F.lit(float(SHIFT)), F.col("n_chars") / 6 * SHIFT_SHARE)
    return marked.select(
        "doc_id", F.col("n_chars").cast("bigint"), "edited_sha256", written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed"), tolerance).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), tolerance).alias("near_next"),
    )
