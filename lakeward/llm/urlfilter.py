"""URL filtering against dated lists: each capture is judged by the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeward.session import settled

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, without user, port and final dot; null if it has none."""
    found = F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit("."))
    return F.when(found != "", found)


def suffixes(host: Column) -> Column:
    """A host and all domains above it, the most specific first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def intervals(events: DataFrame) -> DataFrame:
    """(entry, since, until) of `events` (entry, day, added): when each entry is on the list.

    An entry is on the list from a day on which it was added, of that day, to its next event; until is null
    if there is none. Of the events of one day an addition wins. There is one row per entry and
    day at most before they are ordered, so the window of an entry is bounded by the calendar. Events
    without entry or day are left out.
    """
    daily = events.where("entry is not null and day is not null").groupBy("entry", "day").agg(F.max("added").alias("added"))
    following = F.lead("day").over(Window.partitionBy("entry").orderBy("day"))
    states = daily.select("entry", F.col("day").alias("since"), following.alias("until"), "added")
    return states.where("added").drop("added")


def judged(captures: DataFrame, events: DataFrame) -> DataFrame:
    """`captures` (host, fetched, and any others) with blocked, entry and since.

    entry is the most specific list entry that covers the host and was active on the day of the fetch, since the day
    from which it was. A capture without host or date is not blocked. The join goes by entry
    and month, by merging: the intervals grow with the lists and are never broadcast. An interval stands once in each month that it touches up to the last fetch, so the captures of a
    hot host are spread over the months, and they are reduced to one row per host and day before. Repeated
    captures stay. No captures: an empty result.
    """
    visits = settled(captures.where("host is not null and fetched is not null").select("host", "fetched").distinct(), "visits")
    last = visits.agg(F.max("fetched")).first()[0]
    month = lambda day: F.trunc(day, "month")
    end = F.least(F.date_sub("until", 1), F.lit(last).cast("date"))
    active = (
        intervals(events)
        .where(F.col("since") <= F.lit(last).cast("date"))
        .withColumn("month", F.explode(F.sequence(month("since"), month(end), F.expr("interval 1 month"))))
    )
    asked = visits.withColumn("entry", F.explode(suffixes(F.col("host")))).withColumn("month", month("fetched"))
    hits = (
        asked.join(active.hint("merge"), ["entry", "month"])
        .where((F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
        .groupBy("host", "fetched")
        .agg(F.max_by(F.struct("entry", "since"), F.length("entry")).alias("hit"))
    )
    judged = captures.join(hits, ["host", "fetched"], "left")
    return judged.select(
        *(F.col(c) for c in captures.columns), F.col("hit").isNotNull().alias("blocked"), "hit.entry", "hit.since"
    )


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def listing_of(hosts: DataFrame) -> DataFrame:
    """List events (entry, day, added) that follow from the hosts: a quarter are listed, another quarter have their domain listed.

    Each is added on a day of the year, taken off one to three months later, and half are added again.
    """
    n = _number(F.col("host"))
    entry = F.when(n % 4 == 0, F.col("host")).when(n % 4 == 1, F.regexp_replace("host", r"^[^.]*\.", ""))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (n % 300).cast("int"))
    gone = F.date_add(start, (F.lit(30) + F.floor(n / 300) % 60).cast("int"))
    dated = hosts.select(entry.alias("entry"), n.alias("n"), start.alias("start"), gone.alias("gone")).where("entry is not null")
    event = lambda day, added: F.struct(day.alias("day"), F.lit(added).alias("added"))
    again = F.when(F.col("n") % 8 < 4, event(F.date_add("gone", 20), True))
    rows = F.array(event(F.col("start"), True), event(F.col("gone"), False), again)
    return dated.select("entry", F.explode(F.filter(rows, lambda e: e.isNotNull())).alias("e")).select("entry", "e.*")


def filter_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, host, fetched, blocked, entry and since of every row of `pages`.

    The tables have neither lists nor dates: a page is taken as fetched on a day of 2024 that follows from its page_id,
    and the list's events follow from the hosts.
    """
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int"))
    captures = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), day.alias("fetched"))
    hosts = captures.where("host is not null").select("host").distinct()
    return judged(captures, listing_of(hosts)).select("page_id", "url", "host", "fetched", "blocked", "entry", "since")


# The same rows in SQL: every interval of every suffix of the host, the longest entry first.
FILTER_SQL = r"""
WITH captures AS (
  SELECT page_id, url,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host,
         DATE '2024-01-01' + cast(((page_id % 366) + 366) % 366 AS INTEGER) AS fetched
  FROM pages),
hosts AS (SELECT host, ('0x' || substr(md5(host), 1, 8))::BIGINT AS n FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)),
dated AS (
  SELECT CASE n % 4 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]*\.', '') END AS entry, n,
         DATE '2024-01-01' + cast(n % 300 AS INTEGER) AS start_day,
         DATE '2024-01-01' + cast(n % 300 AS INTEGER) + cast(30 + (n // 300) % 60 AS INTEGER) AS gone
  FROM hosts),
events AS (
  SELECT entry, start_day AS day, true AS added FROM dated WHERE entry IS NOT NULL
  UNION ALL SELECT entry, gone, false FROM dated WHERE entry IS NOT NULL
  UNION ALL SELECT entry, gone + 20, true FROM dated WHERE entry IS NOT NULL AND n % 8 < 4),
daily AS (SELECT entry, day, bool_or(added) AS added FROM events GROUP BY entry, day),
states AS (SELECT entry, day AS since, lead(day) OVER (PARTITION BY entry ORDER BY day) AS until, added FROM daily),
hits AS (
  SELECT c.host, c.fetched, arg_max(s.entry, length(s.entry)) AS entry, arg_max(s.since, length(s.entry)) AS since
  FROM (SELECT DISTINCT host, fetched FROM captures) c
  JOIN states s ON (c.host = s.entry OR ends_with(c.host, '.' || s.entry))
   AND s.added AND c.fetched >= s.since AND (s.until IS NULL OR c.fetched < s.until)
  GROUP BY c.host, c.fetched)
SELECT c.page_id, c.url, c.host, c.fetched, h.entry IS NOT NULL AS blocked, h.entry, h.since
FROM captures c LEFT JOIN hits h ON c.host = h.host AND c.fetched = h.fetched
"""
