from __future__ import annotations

from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from lakeward.llm import mixing
from tests.conftest import rows_of


def in_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    given = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "source": [r[2] for r in rows]})
    con.register("given", given)
    con.execute("INSERT INTO documents SELECT * FROM given")
    return sorted(con.execute(mixing.MIX_SQL).fetchall(), key=repr)


def targets(sizes):
    """Targets by sharing again and again, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * unit > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * unit for s in open_}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


ROWS = [(i, "w " * (7 * i % 31 + 1), f"s{i * i % 7}") for i in range(300)]
ROWS += [(1000 + i, "x\ty\x0bz z " * (i % 5), None) for i in range(40)]
ROWS += [(2000, None, "empty"), (2001, "", "empty"), (2002, " \n", "é"), (2003, "one", "é"), (3, "w " * 22, "s2"), (None, "a b c", "s1"), (2004, "v " * 20_000, "s3")]


def test_equals_its_sql_and_meets_the_targets(spark, make_docs):
    got = rows_of(mixing.mix(make_docs(ROWS)))
    assert got == in_sql(ROWS)
    source = {r[0]: r[2] for r in ROWS}
    sizes, taken, stated, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for doc_id, size, source_size, target, words in got:
        s = source[doc_id]
        sizes[s] += size
        taken[s] += words
        stated[s] = target
        largest[s] = max(largest[s], size)
        assert words in (0, size, 2 * size) and source_size >= size
    want = targets(dict(sizes))
    assert stated == pytest.approx(want)
    assert all(abs(taken[s] - stated[s]) <= largest[s] for s in sizes)
    assert sum(stated.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_and_order_does_not_matter(spark, make_docs):
    docs = make_docs(ROWS)
    assert rows_of(mixing.mix(docs.repartition(5))) == rows_of(mixing.mix(docs.orderBy("text")))


def test_mixed_documents_are_repeated_whole(spark, make_docs):
    docs = make_docs(ROWS[:200])
    clash = docs.withColumn("name", docs.lang).withColumn("times", docs.n_chars).withColumn("rank", docs.lang)
    out = mixing.mixed_documents(clash)
    assert out.columns == clash.columns
    counted = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["taken"]}
    assert counted == want


def test_empty_tables(spark, make_docs):
    assert mixing.mix(make_docs(ROWS[:1]).where("false")).collect() == []
    assert rows_of(mixing.mix(make_docs([(1, None, None), (2, "", "a")]))) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert rows_of(mixing.mix(make_docs([(1, "a b", "a")]))) == in_sql([(1, "a b", "a")])


def missed(rows, source):
    """What a source lacks or has too much, as a share of what its certain copies leave open, by the SQL."""
    of = {r[0]: r[2] for r in rows}
    mine = [r for r in in_sql(rows) if of[r[0]] == source]
    rest = mine[0][3] - mine[0][3] // mine[0][2] * mine[0][2]
    return abs(sum(r[4] for r in mine) - mine[0][3]) / rest


@pytest.mark.parametrize("long_share", [0.09, 0.3, 0.6])
def test_a_very_long_document_does_not_end_the_drawing(long_share):
    # The other source is filled to twice its size, so a fifth of the words of `b` is drawn.
    long = round(1500 * long_share / (1 - long_share))
    misses = []
    for drawing in range(50):
        base = drawing * 10_000
        rows = [(base + i, "w w " if i % 2 else "w ", "b") for i in range(1000)] + [(base + 1000, "w " * long, "b")]
        rows.append((base + 1001, "w " * round((1500 + long) * 0.6), "a"))
        misses.append(missed(rows, "b"))
    misses.sort()
    assert misses[-5] <= 0.005 and misses[-1] <= 0.02


def test_inclusion_follows_the_size_and_its_words_sum_up_to_the_rest(spark, make_docs):
    rows = [(i, "w " * (1 + 9 * (i % 3 == 0)), "a") for i in range(3000)]
    taken = {d: t > s for d, s, _, _, t in in_sql(rows)}
    short = [taken[d] for d, t, _ in rows if len(t) == 2]
    long = [taken[d] for d, t, _ in rows if len(t) > 2]
    # q = 1/2, mean by words 8.5, longest 10: shares 1/2 + 1/4 * 0.75 and 1/2 - 1/4 * 0.15.
    assert sum(short) / len(short) == pytest.approx(0.6875, abs=0.04)
    assert sum(long) / len(long) == pytest.approx(0.4625, abs=0.04)
    # By the random number alone the same documents would not come first.
    units = mixing._units(mixing.sized(make_docs(rows)))
    drawn = {int(r["name"]) for r in mixing._times(mixing.sized(make_docs(rows)), units).where("times > 1").collect()}
    assert drawn == {d for d, t in taken.items() if t}
    u = {int(r[0]): r[1] for r in units.select("name", mixing._random(units.name)).collect()}
    by_number = sorted(u, key=u.get)[: len(drawn)]
    assert len(drawn - set(by_number)) > 100


def test_rows_of_one_id_are_drawn_together(spark, make_docs):
    rows = ROWS[:100] + [(5000, "a b c d", "s1")] * 30 + [(5000, "e f", "s1"), (None, "a b", "s1"), (None, "a b", "s1")]
    got = rows_of(mixing.mix(make_docs(rows)))
    assert got == in_sql(rows)
    assert len({t // s for d, s, _, _, t in got if d == 5000}) == 1
