"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakeward.operators.catalogue import file_catalogue
from lakeward.plans import registry
from tests.conftest import SF_DIR

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


# The scale that queries are held against elsewhere, too: at the smallest one every month has rows of every kind of key.
LARGER = SF_DIR.replace("sf0.001", "sf0.01")
BOTH = ["lake_profile", "file_catalogue", "rebuild_partitions", "merge_by_source_in_months", "scan_month_range"]
CASES = [(name, LARGER) for name in sorted(oracle_sql())] + [(name, SF_DIR) for name in BOTH]


@pytest.fixture(scope="module")
def duck():
    connections = {}
    for sf_dir in (SF_DIR, LARGER):
        connections[sf_dir] = duckdb.connect()
        for name in TABLES:
            connections[sf_dir].execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connections


def plain(value):
    if isinstance(value, float | decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


@pytest.mark.parametrize(("name", "sf_dir"), CASES)
def test_query_equals_its_sql(spark, duck, name, sf_dir):
    df = queries()[name](spark, sf_dir)
    result = duck[sf_dir].sql(oracle_sql()[name])
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    assert sorted(df.columns) == [result.columns[i] for i in order]
    assert [TYPES[dict(df.dtypes)[result.columns[i]]] for i in order] == [str(result.types[i]) for i in order]
    got = sorted(repr([plain(v) for v in row]) for row in df.select(*sorted(df.columns)).collect())
    want = sorted(repr([plain(row[i]) for i in order]) for row in result.fetchall())
    assert want, "the SQL must give rows"
    assert got == want


def test_entry_and_registry(spark):
    assert entry(spark).columns == ["n_name", "ano", "events", "population", "rate"]
    assert set(oracle_sql()) <= set(queries())


def test_file_catalogue_lists_every_table(spark):
    found = file_catalogue(spark, SF_DIR, registry.FILE_FRAGMENTS, registry.source_dimension(spark), registry.FOLDER_SOURCES)
    rows = found.collect()
    assert [r["arquivo"] for r in rows] == sorted(f"{t}.parquet" for t in TABLES)
    assert all(r["tamanho_bytes"] > 0 and r["num_registros"] > 0 for r in rows)
