"""Joins that add names, places and populations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.text import as_column, zero_fill
from lakeward.operators.sizing import join_small
from lakeward.session import settled, settled_observed

UNMAPPED = "(não mapeado no registro)"  # fixed value: label of what has no source


def left_enrich(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, width: int = 6
) -> DataFrame:
    """Left join on codes padded with zeros on both sides; the right code is dropped.

    The left code is shown padded. A code that the right side repeats repeats
    the left row.
    """
    places = right.withColumn("_code", zero_fill(right_key, width)).drop(right_key)
    rows = left.withColumn(left_key, zero_fill(left_key, width))
    return join_small(rows, places, F.col(left_key), "_code", "left").drop("_code")


def first_substring_match(
    name: Column | str, entries: Sequence[tuple[str, str]], longest: bool = False
) -> Column:
    """Id of the first fragment, in the order given, that the name contains.

    With `longest` the longest contained fragment counts instead. The entries
    become one conditional expression, so the rows are neither joined nor
    shuffled. Null where nothing matches.
    """
    name = as_column(name)
    ordered = sorted(entries, key=lambda e: -len(e[0])) if longest else list(entries)
    if not ordered:
        return F.lit(None).cast("string")
    found = F
    for fragment, target in ordered:
        found = found.when(F.contains(name, F.lit(fragment)), F.lit(target))
    return found


# First letters of a fragment that are looked for in names before the whole of it.
START = 3
# Places in a name whose windows are made together, and letters of the names of one task.
BLOCK, TASK_LETTERS = 1024, 1 << 20


def _windows(name: Column, most: int) -> Column:
    """The distinct strings of at most `most` letters that begin somewhere in the first BLOCK letters of a text."""
    places = F.sequence(F.lit(1), F.least(F.char_length(name), F.lit(BLOCK)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(name, i, F.lit(most))))


def _candidates(known: DataFrame, fragments: DataFrame, letters: int) -> DataFrame:
    """(_id, _held): strings in the names (_id, _name; not empty) that have the beginning and the length of a fragment (_fragment; not empty)."""
    size = F.char_length("_fragment")
    starts = fragments.groupBy(F.left("_fragment", F.lit(START)).alias("_start")).agg(F.collect_set(size).alias("_lengths"))
    sizes = fragments.groupBy(F.least(size, F.lit(START)).alias("n")).agg(F.max(size).alias("most")).collect()  # at most START rows
    most = max((row["most"] for row in sizes), default=1)
    dealt = known.repartition(max(1, -(-letters // TASK_LETTERS)), "_id")
    blocks = dealt.select("_id", "_name", F.explode(F.sequence(F.lit(1), F.char_length("_name"), F.lit(BLOCK))).alias("_at"))
    cut = blocks.select("_id", F.substring("_name", F.col("_at"), F.lit(BLOCK + most - 1)).alias("_block"))
    windows = cut.select("_id", F.explode(_windows(F.col("_block"), most)).alias("_window"))
    begins = [F.when(F.char_length("_window") >= n, F.left("_window", F.lit(n))) for n in sorted(row["n"] for row in sizes) or [START]]
    begun = windows.select("_id", "_window", F.explode(F.array_compact(F.array(*begins))).alias("_begin"))
    met = join_small(begun, starts, F.col("_begin"), "_start", "inner").select("_id", "_window", F.explode("_lengths").alias("_length"))
    return met.where(F.col("_length") <= F.char_length("_window")).select("_id", F.left("_window", F.col("_length")).alias("_held"))


def fragment_matches(
    names: DataFrame,
    name: str,
    dictionary: DataFrame,
    fragment: str = "fragment",
    target: str = "target",
    priority: str = "priority",
    longest: bool = False,
    as_name: str = "match",
) -> DataFrame:
    """`names` with the target of the first fragment, by priority, that the name contains, from a table of fragments.

    For dictionaries that are no list in the code: thousands of fragments or more. A place in a name is compared by equality
    with the fragments that share its first START letters, once for each length that these have, so a name meets only
    fragments that it holds: the work is that of the names' letters times those lengths, however many fragments and names
    there are. Each different name is matched once, and fragments are compared by their places in the order. With `longest` the longest
    contained fragment counts, of equally long ones the first. Equal priorities go by fragment, then by target; a fragment without priority comes last. An empty
    fragment is in every name; null names and fragments match nothing.
    """
    length = F.lit(0) - F.char_length(fragment) if longest else F.lit(0)
    order = F.struct(length.alias("length"), F.col(priority).isNull().alias("last"), F.col(priority).alias("priority"), F.col(fragment).alias("fragment"), F.col(target).alias("target"))
    best = dictionary.where(F.col(fragment).isNotNull()).groupBy(F.col(fragment).alias("_fragment")).agg(F.min(order).alias("_order"))
    # Numbers that grow in the order, with gaps.
    ranked = best.orderBy("_order").select("_fragment", F.monotonically_increasing_id().alias("_rank"), F.col("_order.target").alias(as_name))
    first = settled(ranked, "fragments")
    known, seen = settled_observed(
        names.where(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct().select("_name", F.monotonically_increasing_id().alias("_id")),
        "names", letters=F.sum(F.char_length("_name")),
    )
    fragments = first.where("_fragment <> ''")
    held = _candidates(known.where("_name <> ''"), fragments, seen["letters"] or 0)
    met = join_small(settled(held, "held"), fragments.select("_fragment", "_rank"), F.col("_held"), "_fragment", "inner")
    found = met.groupBy(F.col("_id").alias("_of")).agg(F.min("_rank").alias("_least"))
    empty = first.where("_fragment = ''").select("_rank").first()
    least = join_small(known, found, F.col("_id"), "_of", "inner" if empty is None else "left")
    if empty is not None:
        least = least.withColumn("_least", F.least("_least", F.lit(empty[0])))
    matched = join_small(least.select("_name", "_least"), first.select("_rank", as_name), F.col("_least"), "_rank", "inner")
    return join_small(names, matched.select("_name", as_name), F.col(name), "_name", "left").drop("_name")


def dimension_lookup(df: DataFrame, dimension: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Add the columns of a keyed dimension; with `strict` an unknown key fails the job."""
    marked = dimension.withColumnRenamed(key, "_known")
    joined = join_small(df, marked, F.col(key), "_known", "left")
    if strict:
        message = F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        checked = F.when(F.col("_known").isNotNull(), F.col(key)).otherwise(F.raise_error(message))
        joined = joined.withColumn(key, checked)
    return joined.drop("_known")


def unmapped_folders(catalogue: DataFrame, folder: str = "diretorio", name: str = "nome_fonte") -> DataFrame:
    return catalogue.where(F.startswith(name, F.lit("(não mapeado"))).select(folder).distinct()


def municipality(code: Column | str) -> Column:
    """Codes have six or seven digits (the last a check digit): compare six."""
    return F.substring(as_column(code), 1, 6)


def rate_per(
    events: DataFrame,
    population: DataFrame,
    place: str,
    year: str | None = None,
    people: str = "population",
    per: int = 100_000,
    weight: str | None = None,
) -> DataFrame:
    """Events, population and rate per `per` inhabitants, by place (and year).

    Events are counted first (or `weight`, an existing count, is summed), so the
    join sees one row per place and year however many events one place has. Places without a population
    stay, with a null population and rate.
    """
    keys = [place] if year is None else [place, year]
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counts = events.groupBy(*keys).agg(total.cast("bigint").alias("events"))
    rate = F.lit(float(per)) * F.col("events") / F.nullif(F.col(people), F.lit(0))
    return counts.join(population, [k for k in keys if k in population.columns], "left").select(
        *keys, "events", F.col(people).cast("bigint").alias("population"), F.round(rate, 2).alias("rate")
    )


def rate_carried(
    events: DataFrame,
    population: DataFrame,
    place: str,
    year: str,
    people: str = "population",
    per: int = 100_000,
    reach: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rates where years without a population take that of the place's nearest year, of two equally near ones the earlier.

    Columns: place, year, events, population, population_year, carried (another year's), rate. With `reach` a
    year further away than that counts for nothing. Events are counted and a place's populations are put
    together first, one of each year at most, so the join sees a row per place and year of events. Two different populations of one place and
    year fail. Places or years that are null, and places without any population, stay with a null rate.
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counts = events.groupBy(place, year).agg(total.cast("bigint").alias("events"))
    known = population.where(F.col(year).isNotNull() & F.col(people).isNotNull()).groupBy(place, year)
    yearly = known.agg(F.min(people).alias("_least"), F.max(people).alias("_most"))
    message = F.concat(F.lit("several populations of "), F.col(place).cast("string"), F.lit(" in "), F.col(year).cast("string"))
    one = F.when(F.col("_least") < F.col("_most"), F.raise_error(message).cast("bigint")).otherwise(F.col("_least").cast("bigint"))
    of_place = yearly.groupBy(F.col(place).alias("_place")).agg(F.collect_list(F.struct(F.col(year).alias("year"), one.alias("people"))).alias("_years"))
    met = join_small(counts, of_place, F.col(place), "_place", "left")
    asked = F.col(year)
    far = F.transform("_years", lambda x: F.struct(F.abs(x["year"] - asked).alias("far"), x["year"].alias("year"), x["people"].alias("people")))
    near = F.when(asked.isNotNull(), F.array_min(far))
    if reach is not None:
        near = F.when(near["far"] <= reach, near)
    rate = F.lit(float(per)) * F.col("events") / F.nullif(F.col("_near.people"), F.lit(0))
    return met.withColumn("_near", near).select(
        place, year, "events", F.col("_near.people").alias("population"), F.col("_near.year").alias("population_year"),
        (F.col("_near.far") > 0).alias("carried"), F.round(rate, 2).alias("rate"),
    )


def rate_per_municipality(
    events: DataFrame,
    population: DataFrame,
    code: str,
    population_code: str,
    year: str,
    people: str = "population",
    per: int = 100_000,
) -> DataFrame:
    """Rates by municipality and year where either side has codes of six or of seven digits.

    Both are compared by their first six digits. Two codes of one year that share these would
    add up two places, or one place twice, so they fail.
    """
    codes = population.groupBy(municipality(population_code).alias(code), year).agg(
        F.sum(people).alias(people), F.count_distinct(population_code).alias("_codes")
    )
    message = F.concat(F.lit("several codes for municipality "), F.col(code), F.lit(" in "), F.col(year).cast("string"))
    checked = F.when(F.col("_codes") > 1, F.raise_error(message)).otherwise(F.col(people))
    whole = codes.withColumn(people, checked).drop("_codes")
    return rate_per(events.withColumn(code, municipality(code)), whole, code, year, people, per)
