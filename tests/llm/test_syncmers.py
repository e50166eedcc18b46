from __future__ import annotations

import hashlib

import pytest

from lakeward.llm import syncmers
from lakeward.llm.queries import QUERIES
from tests.conftest import plan_of, rows_of
from tests.llm import syncmer_reference as plain
from tests.llm.conftest import SF_DIR


def want(docs):
    return sorted(((a, b, hashlib.sha256(c.encode()).hexdigest(), *rest) for a, b, c, *rest in plain.rows(docs)), key=repr)


def test_whole_table_equals_the_plain_version(spark, documents):
    rows = rows_of(QUERIES["op7_syncmers"](spark, SF_DIR))
    assert rows == want(documents)
    assert sum(r[5] > r[6] for r in rows) > 0.95 * len(rows)


def test_several_ranges(spark, documents, make_docs, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 7)
    docs = [(d * 3 - 100, t) for d, t in documents[:60]]
    assert rows_of(syncmers.fingerprints(make_docs(docs))) == want(docs)


@pytest.mark.parametrize("n", [1, 2])
def test_few_documents_follow_themselves(spark, make_docs, n):
    docs = [(5, "one two three four five six"), (4, "x")][:n]
    assert rows_of(syncmers.fingerprints(make_docs(docs))) == want(docs)


def test_odd_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "é \U0001f600 z\x1cy"), (5, "same " * 30_000), (6, "a b"), (7, "word")]
    table = make_docs(docs)
    assert rows_of(syncmers.fingerprints(table.withColumn("own", table.lang).withColumn("part", table.lang))) == want(docs)
    assert syncmers.fingerprints(table.where("false")).collect() == []


def test_rows_without_or_with_one_id(spark, make_docs):
    docs = make_docs([(3, "a b c d"), (None, "e f g h"), (None, None), (3, "a b c d"), (1, "i j k l")])
    rows = syncmers.fingerprints(docs).collect()
    assert len(rows) == 5
    prints = {}
    for r in rows:
        prints.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    # The copy of document 3 that stands first is followed by the other one.
    assert sorted(r["near_next"] for r in rows if r["doc_id"] == 3) == [0.0, 1.0]
    only = syncmers.fingerprints(make_docs([(None, "a b c d"), (None, "e f g h")])).collect()
    assert [r["near_next"] for r in only] == [0.0, 0.0]


def test_no_python_in_the_plan(spark):
    plan = plan_of(QUERIES["op7_syncmers"](spark, SF_DIR))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_all_anchors_of_long_texts_count(spark, make_docs):
    # Two long texts that share nothing but 50 words at one place, and one with a single word replaced.
    first, second = ([f"{c}{i}" for i in range(20_000)] for c in "ab")
    second[500:550] = first[500:550]
    changed = first[:9_000] + ["new"] + first[9_001:]
    docs = [(3, " ".join(second)), (2, " ".join(first)), (1, " ".join(changed))]
    rows = {r["doc_id"]: r for r in syncmers.fingerprints(make_docs(docs)).collect()}
    assert 0 < rows[3]["near_next"] < 0.01 and 0.99 < rows[2]["near_next"] < 1
    assert rows[2]["fingerprint"] != rows[1]["fingerprint"]
    assert rows_of(syncmers.fingerprints(make_docs(docs))) == want(docs)
