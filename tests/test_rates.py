from __future__ import annotations

import pytest

from lakeward.operators.enrich import rate_carried
from tests.conftest import rows_of


def tables(spark, events, population):
    return spark.createDataFrame(events, "place string, year int"), spark.createDataFrame(population, "place string, year int, population long")


EVENTS = [("a", 1979)] * 3 + [("a", 2002), ("a", 2005), ("a", None), ("b", 2003), ("c", 2003), (None, 2003)]
PEOPLE = [("a", 2001, 100), ("a", 2003, 200), ("a", 2003, 200), ("b", 2003, 0), ("d", 2003, 5), ("a", None, 9), ("a", 2004, None)]


def test_the_nearest_year_is_carried(spark):
    got = rows_of(rate_carried(*tables(spark, EVENTS, PEOPLE), "place", "year", per=100))
    assert got == sorted([
        ("a", 1979, 3, 100, 2001, True, 3.0), ("a", 2002, 1, 100, 2001, True, 1.0), ("a", 2005, 1, 200, 2003, True, 0.5),
        ("a", None, 1, None, None, None, None), ("b", 2003, 1, 0, 2003, False, None), ("c", 2003, 1, None, None, None, None),
        (None, 2003, 1, None, None, None, None),
    ], key=repr)


def test_reach_and_empty_tables(spark):
    rows = {r["year"]: r for r in rate_carried(*tables(spark, EVENTS, PEOPLE), "place", "year", reach=2).where("place = 'a'").collect()}
    assert rows[1979]["rate"] is None and rows[1979]["events"] == 3 and rows[2005]["population_year"] == 2003
    assert rate_carried(*tables(spark, [], PEOPLE), "place", "year").collect() == []
    assert rows_of(rate_carried(*tables(spark, EVENTS[:1], []), "place", "year")) == [("a", 1979, 1, None, None, None, None)]


def test_two_populations_of_one_year_fail(spark):
    with pytest.raises(Exception, match="several populations of a in 2001"):
        rate_carried(*tables(spark, EVENTS, [*PEOPLE, ("a", 2001, 101)]), "place", "year").collect()
