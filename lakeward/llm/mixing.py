"""Mixing sources to target weights by Pareto order sampling of whole documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import WORD, with_index
from lakeward.operators.sizing import join_small
from lakeward.session import settled

# Weights of the sources in their order, repeating; the mix has SHARE times all words, and a
# document is taken at most MOST times.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
# Bins of the sampling order in which the cut of a source is looked for.
BINS = 4096
# Each walk down the order at least halves what a source misses, or takes all that it may.
ROUNDS = 10


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _random(name: Column) -> Column:
    """A number between 0 and 1 that follows from the document's name alone."""
    digits = F.substring(F.md5(F.concat(name, F.lit("/mix")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def target_sizes(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """`sources` (source, source_size) with the words that each gives the mix (target).

    Sources are ordered by code point, null last, and weighed in turn. What a source
    lacks (`most` times its size) is shared again among the others by weight until
    none is above. A round is one aggregate that finds the level of a unit of
    weight from whole numbers; only its sums reach the driver.
    """
    cycle = F.array(*map(F.lit, weights))
    ordered = with_index(sources, F.col("source").asc_nulls_last(), name="_place")
    weighed = ordered.withColumn("weight", F.get(cycle, (F.col("_place") % len(weights)).cast("int"))).withColumn(
        "ceiling", F.col("source_size") * most
    )
    total, level = share * (weighed.agg(F.sum("source_size")).first()[0] or 0), 0.0
    while True:
        full = F.col("ceiling") <= F.col("weight") * F.lit(level)
        filled, unfilled = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("ceiling"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if not unfilled or (total - filled) / unfilled <= level:
            break
        level = (total - filled) / unfilled
    target = F.least(F.col("ceiling").cast("double"), F.col("weight") * F.lit(level))
    return weighed.select("source", "source_size", target.alias("target"))


def _cap(words: Column) -> Column:
    """Documents of at most this size are drawn in a round that may take `words`: half of them."""
    return F.floor(words / 2).cast("bigint")


def _rank(u: Column, words: Column) -> Column:
    """Random odds by inclusion odds. A document above half of the rest has no odds: it stands behind all others."""
    tilt = (F.col("mean") - words) / F.col("longest")
    chance = F.col("q") + F.col("q") * (1 - F.col("q")) * tilt
    odds = lambda p: p / (1 - p)
    return F.when(words > _cap(F.col("rest")), F.lit(float("inf"))).when(F.col("q") >= 1, F.lit(0.0)).otherwise(odds(u) / odds(chance))


def _with_rest(units: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """One row per source: target, certain `copies`, the words still missing (`rest`) and what the inclusion shares follow from.

    `q` is the share of the words of the documents that may be drawn (those of at most half of the
    rest). A document's own share is q + q(1-q)(mean-size)/longest, where `mean` is their mean size by words: the shares times
    the sizes sum up to the rest, and short documents are drawn rather than long ones, so that the same words come from more documents.
    """
    by_source = units.groupBy("key", "source").agg(F.sum("words").alias("source_size"))
    targets = target_sizes(by_source.select("source", "source_size"), weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = settled(
        targets.withColumn("copies", F.floor(ratio))
        .withColumn("rest", F.round(F.col("target") - F.col("copies") * F.col("source_size")).cast("bigint"))
        .withColumn("key", _key()),
        "targets",
    )
    open_ = join_small(units.select(F.col("key").alias("of"), "words"), plan.select("key", "rest"), F.col("of"), "key", "inner").where(F.col("words") <= _cap(F.col("rest")))
    exact = F.col("words").cast("decimal(19,0)")
    seen = open_.groupBy("key").agg(F.sum("words").alias("drawable"), F.sum(exact * exact).cast("double").alias("squares"), F.max("words").alias("longest"))
    share_ = F.when(F.col("drawable") > F.col("rest"), F.col("rest") / F.col("drawable")).otherwise(1.0)
    mean = F.when(F.col("drawable") > 0, F.col("squares") / F.col("drawable")).otherwise(0.0)
    odds = seen.select("key", F.greatest("longest", F.lit(1)).alias("longest"), "drawable", mean.alias("mean"))
    return plan.join(odds, "key", "left").withColumn("q", share_).drop("drawable")


def _round(ranked: DataFrame, open_: DataFrame) -> DataFrame:
    """One walk down the order of the sources in `open_` (key, rest, gap, after): each with `cap`, `stop` and the `gap` that is left.

    Documents of at most `cap` words from the place `after` on are taken before the first that passes the gap, `stop`
    (null: none does). It is looked for in the one bin of the order in which the sum passes, so no task sorts a whole source.
    """
    place = F.struct("rank", "name")
    drawable = (F.col("words") <= F.col("cap")) & (F.col("after").isNull() | (place >= F.col("after")))
    of = ranked.withColumnRenamed("key", "of")
    open_ = open_.withColumn("cap", _cap(F.col("gap")))
    bins = join_small(of, open_, F.col("of"), "key", "inner").where(drawable).groupBy("key", "bin").agg(F.sum("words").alias("in_bin"), F.first("gap").alias("gap"))
    upto = F.sum("in_bin").over(Window.partitionBy("key").orderBy("bin"))
    first = F.min(F.when(F.col("upto") > F.col("gap"), F.struct("bin", (F.col("upto") - F.col("in_bin")).alias("before"))))
    cuts = bins.withColumn("upto", upto).groupBy("key").agg(first.alias("at"), F.max("upto").alias("total"))
    cuts = settled(open_.join(cuts, "key", "left"), "cuts")

    edge = join_small(of, cuts.where("at is not null"), F.col("of"), "key", "inner").where(drawable & (F.col("bin") == F.col("at.bin")))
    edge = edge.withColumn("upto", F.col("at.before") + F.sum("words").over(Window.partitionBy("key").orderBy("rank", "name")))
    stops = edge.groupBy("key").agg(
        F.min(F.when(F.col("upto") > F.col("gap"), place)).alias("stop"), F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto"))).alias("within")
    )
    taken = F.when(F.col("at").isNull(), F.coalesce("total", F.lit(0))).otherwise(F.coalesce("within", "at.before"))
    return settled(cuts.join(stops, "key", "left").select("key", "rest", "cap", "stop", (F.col("gap") - taken).alias("gap")), "round")


def _units(sizes: DataFrame) -> DataFrame:
    """What is drawn: the rows of one name and source together."""
    together = sizes.groupBy(_key().alias("key"), "source", "name").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    return settled(together, "units")


def sampling_plan(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source of `units`: its target, and how it is met.

    Each document gives floor(target / source_size) certain whole copies. What is left of the
    target is drawn by Pareto order sampling: documents are ordered by random odds divided
    by the odds of their inclusion shares (`_with_rest`), and those of at most half of what is missing are taken
    whole in this order before the first that passes it. The next round goes on from there with documents of at most half of what is
    missing now, so each round at least halves it or takes all that it may; rounds end when less than
    1 / 2**ROUNDS of the rest is missing. Then the document whose size comes nearest to what is still missing (`extra`) is
    taken if that brings the sum nearer.
    """
    plan = settled(_with_rest(units, weights, share, most), "shares")
    met = join_small(units.select(F.col("key").alias("of"), "name", "words"), plan.where("rest > 0").drop("source"), F.col("of"), "key", "inner")
    met = met.withColumn("rank", _rank(_random(F.col("name")), F.col("words")))
    odd = F.when(F.col("rank") < float("inf"), F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
    ranked = settled(met.select("key", odd.alias("bin"), "rank", "name", "words"), "ranked")

    none = F.lit(None).cast("struct<rank: double, name: string>")
    open_ = plan.where("rest > 0").select("key", "rest", F.col("rest").alias("gap"), none.alias("after"))
    rounds = []
    for _ in range(ROUNDS):
        rounds.append(_round(ranked, open_))
        open_ = rounds[-1].where(F.col("stop").isNotNull() & (F.col("gap") * (1 << ROUNDS) > F.col("rest"))).select("key", "rest", "gap", F.col("stop").alias("after"))
        if open_.isEmpty():
            break
    walked = reduce(DataFrame.unionAll, rounds).groupBy("key").agg(F.collect_list(F.struct("cap", "stop")).alias("rounds"), F.min("gap").alias("gap"))
    walked = settled(walked, "walked")
    left = join_small(ranked.withColumnRenamed("key", "of"), walked.where("gap > 0"), F.col("of"), "key", "inner").where(~_drawn())
    off = F.abs(F.col("gap") - F.col("words"))
    extra = left.where(off < F.col("gap")).groupBy("key").agg(F.min(F.struct(off.alias("off"), "rank", "name")).alias("best"))
    return settled(
        plan.join(walked.drop("gap"), "key", "left").join(extra.select("key", F.col("best.name").alias("extra")), "key", "left"),
        "plan",
    )


def _key() -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _drawn() -> Column:
    """Whether one of the rounds takes a document (rank, name, words)."""
    place = F.struct("rank", "name")
    took = F.exists("rounds", lambda r: (F.col("words") <= r["cap"]) & (r["stop"].isNull() | (place < r["stop"])))
    return F.coalesce(took, F.lit(False))


def _times(rows: DataFrame, units: DataFrame) -> DataFrame:
    """`rows` (name, source, size) with the plan of their source and the `times` that each is taken."""
    whole = lambda: F.concat("name", F.lit("/"), _key())
    repeated = units.where("rows > 1").select(whole().alias("whole"), F.col("words").alias("together"))
    met = join_small(rows, repeated, whole(), "whole", "left").withColumn("words", F.coalesce("together", "size"))
    met = join_small(met, sampling_plan(units).drop("source"), _key(), "key", "inner").withColumn("rank", _rank(_random(F.col("name")), F.col("words")))
    sampled = (F.col("rest") > 0) & (_drawn() | F.coalesce(F.col("name") == F.col("extra"), F.lit(False)))
    return met.withColumn("times", F.col("copies") + sampled.cast("bigint"))


def _named(docs: DataFrame) -> Column:
    """The name by which a document is drawn: its doc_id, or without one a digest of its text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, name and size in words of every row of `docs`."""
    return docs.select("doc_id", "source", _named(docs).alias("name"), word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every row of `docs` (doc_id, text, source).

    A null or empty text has size 0 and gives no words. Null is a source of its own. A source
    without words has target 0. Rows of one doc_id are drawn together. Other columns are not read. No rows: an empty result.
    """
    sizes = settled(sized(docs), "sizes")
    rows = _times(sizes, _units(sizes))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """`docs` with each row as often as the mix takes it, its columns unchanged."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    own = docs.select(whole, "source", _named(docs).alias("name"), word_count(F.col("text")).alias("size"))
    rows = _times(own, _units(own.drop("_row"))).where("times > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_n")).select("_row.*")


# One round in SQL: rows of the sources still open, what they take, and what is open then.
_ROUND_SQL = """
walk{n} AS MATERIALIZED (
  SELECT u.key, u.rank, u.name, u.words, o.rest, o.gap, sum(u.words) OVER (PARTITION BY u.key ORDER BY u.rank, u.name) AS upto
  FROM ranked u JOIN open{before} o ON u.key = o.key
  WHERE u.words <= o.gap // 2 AND (u.rank > o.after_rank OR (u.rank = o.after_rank AND u.name >= o.after_name))),
open{n} AS MATERIALIZED (
  SELECT key, rest, gap, stop.rank AS after_rank, stop.name AS after_name
  FROM (SELECT key, rest, cast(gap - coalesce(max(upto) FILTER (upto <= gap), 0) AS BIGINT) AS gap,
               min({{'rank': rank, 'name': name}}) FILTER (upto > gap) AS stop
        FROM walk{n} GROUP BY key, rest, walk{n}.gap)
  WHERE stop IS NOT NULL AND gap * {finest} > rest)"""

# The same rows in SQL: the level is the first at which all sources that it fills are full.
_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(cast(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS name,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
src AS (SELECT source, cast(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 2 AS ceiling,
         [3, 1, 2][1 + cast((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS weight
  FROM src),
filled AS (
  SELECT ceiling, weight,
         sum(ceiling) OVER w - ceiling AS ceilings_before,
         sum(weight) OVER (ORDER BY ceiling * 1.0 / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS weights_after
  FROM weighed
  WINDOW w AS (ORDER BY ceiling * 1.0 / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT arg_min((1.5 * (SELECT sum(source_size) FROM src) - ceilings_before)::DOUBLE / weights_after, ceiling * 1.0 / weight) AS unit
  FROM filled
  WHERE (1.5 * (SELECT sum(source_size) FROM src) - ceilings_before)::DOUBLE / weights_after < ceiling::DOUBLE / weight),
targets AS (
  SELECT source, source_size, least(ceiling::DOUBLE, weight * coalesce(unit, 'infinity'::DOUBLE)) AS target FROM weighed, level),
shares AS (
  SELECT *, coalesce('=' || source, '') AS key,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies,
         cast(round(target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size) AS BIGINT) AS rest
  FROM targets),
units AS MATERIALIZED (
  SELECT coalesce('=' || source, '') AS key, name, cast(sum(size) AS BIGINT) AS words FROM sized GROUP BY ALL),
drawable AS (
  SELECT s.key, s.rest, max(words) AS longest,
         CASE WHEN sum(words) > s.rest THEN s.rest::DOUBLE / sum(words)::DOUBLE ELSE 1.0::DOUBLE END AS q,
         CASE WHEN sum(words) > 0 THEN sum(words::HUGEINT * words)::DOUBLE / sum(words)::DOUBLE ELSE 0.0::DOUBLE END AS mean
  FROM units u JOIN shares s ON u.key = s.key
  WHERE words <= s.rest // 2
  GROUP BY s.key, s.rest),
chances AS (
  SELECT u.key, u.name, u.words, words <= s.rest // 2 AS may, d.q,
         (('0x' || substr(md5(u.name || '/mix'), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u,
         d.q + d.q * (1 - d.q) * ((d.mean - u.words) / greatest(d.longest, 1)) AS chance
  FROM units u JOIN shares s ON u.key = s.key LEFT JOIN drawable d ON u.key = d.key
  WHERE s.rest > 0),
ranked AS MATERIALIZED (
  SELECT key, name, words,
         CASE WHEN NOT may THEN 'infinity'::DOUBLE WHEN q >= 1 THEN 0.0::DOUBLE ELSE (u / (1 - u)) / (chance / (1 - chance)) END AS rank
  FROM chances),
open0 AS MATERIALIZED (
  SELECT key, rest, rest AS gap, -1.0::DOUBLE AS after_rank, '' AS after_name FROM shares WHERE rest > 0),
ROUNDS,
drawn AS MATERIALIZED (WALKED),
gaps AS (
  SELECT s.key, s.rest - coalesce(sum(d.words), 0) AS gap FROM shares s LEFT JOIN drawn d ON s.key = d.key WHERE s.rest > 0 GROUP BY s.key, s.rest),
extras AS (
  SELECT key, name FROM (
    SELECT u.key, u.name, row_number() OVER (PARTITION BY u.key ORDER BY abs(gap - u.words), rank, u.name) AS n
    FROM (SELECT * FROM ranked u ANTI JOIN drawn d ON u.key = d.key AND u.name = d.name) u JOIN gaps g ON u.key = g.key
    WHERE abs(gap - u.words) < gap)
  WHERE n = 1),
sampled AS (SELECT key, name FROM drawn UNION ALL SELECT key, name FROM extras)
SELECT z.doc_id, cast(z.size AS BIGINT) AS size, s.source_size, s.target,
       cast(z.size * (s.copies + CASE WHEN t.name IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS taken
FROM sized z JOIN shares s ON z.source IS NOT DISTINCT FROM s.source
LEFT JOIN sampled t ON t.key = s.key AND t.name = z.name
"""
MIX_SQL = _MIX_SQL.replace(
    "\nROUNDS", ",".join(_ROUND_SQL.format(n=n, before=n - 1, finest=1 << ROUNDS) for n in range(1, ROUNDS + 1))
).replace("WALKED", " UNION ALL ".join(f"SELECT key, name, words FROM walk{n} WHERE upto <= gap" for n in range(1, ROUNDS + 1)))
