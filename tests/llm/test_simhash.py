from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.llm import simhash
from lakeward.llm.components import connected_components
from lakeward.llm.queries import QUERIES
from tests.conftest import rows_of
from tests.llm import brute
from tests.llm.conftest import SF_DIR


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB é\t\n\x0b\x1c ", max_size=60))
def test_fingerprint_equals_the_plain_one(text):
    assert simhash.fingerprint(text.encode()) == brute.simhash(text)


def test_whole_table_equals_brute_force(spark, documents):
    assert rows_of(QUERIES["op10_simhash"](spark, SF_DIR)) == sorted(brute.components(documents), key=repr)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 700])
def test_bit_planes_find_all_pairs_within_the_radius(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 1 << 63, max(1, n // 5), dtype=np.uint64)
    noise = np.zeros(n, np.uint64)
    for _ in range(4):
        noise ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    values = base[rng.integers(0, len(base), n)] ^ noise
    q, lane = simhash.within_radius(values, simhash.bit_planes(values), n)
    want = {(i, j) for i in range(n) for j in range(n) if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert set(zip(q.tolist(), lane.tolist())) == want


def test_tiles_of_a_hot_group_lose_no_link(spark, monkeypatch):
    # Fingerprints that agree in their lower 48 bits meet in one group, which is cut into tiles.
    monkeypatch.setattr(simhash, "TILE", 8)
    values = [(i ^ (i >> 1)) << 48 for i in range(60)]  # a Gray code: each links with the next
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "bits long"), len(values))
    found = {r["component"] for r in connected_components(links).collect()}
    assert len(found) == 1


def test_odd_rows(spark, make_docs):
    rows = [(5, "one two three four"), (2, "ONE two\tthree  four"), (9, None), (7, ""), (3, " \n "), (None, "one two three four"), (5, "one two three four"), (8, "x"), (1, "word " * 50_000)]
    docs = make_docs(rows)
    assert rows_of(simhash.simhash_components(docs)) == sorted(brute.components(rows), key=repr)
    assert rows_of(simhash.simhash_components(docs.where("false"))) == []
    clash = docs.withColumn("fingerprint", docs.lang).withColumn("bits", docs.n_chars).withColumn("component_id", docs.doc_id)
    kept = simhash.near_dedup(clash)
    assert kept.columns == clash.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 3), (False, 8), (True, 0)]


def test_components_of_a_chain_a_star_and_a_loop(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    links = spark.createDataFrame([*chain, *star, (200, 201), (201, 200), (300, 300)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert connected_components(links.where("false")).collect() == []
