from __future__ import annotations

import numpy as np
import pytest

from lakeward.llm import ann
from lakeward.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


def brute(rows, every=20, k=20):
    """query -> its nearest (vec_id, score), ties to the smaller id."""
    kept = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            kept[i] = np.array(v, np.float32).astype(np.float64)
    ids = np.array(sorted(kept))
    if not len(ids):
        return {}
    matrix = np.array([kept[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        scores = (matrix * kept[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want]
    return float(np.mean(hits))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_recall_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got, want = found(QUERIES["op4_nearest"](spark, SF_DIR)), brute(rows)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95
    exact = {q: dict(w) for q, w in brute(rows, k=len(rows)).items()}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q, near in got.items() for i, s in near)


@pytest.mark.parametrize("kind", ["spread", "lengths", "clusters"])
def test_recall_with_many_cells_and_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16))
    if kind == "lengths":
        x *= rng.lognormal(0, 0.6, 1500)[:, None]
    if kind == "clusters":
        x = rng.standard_normal((30, 16))[rng.integers(0, 30, 1500)] + 0.3 * x
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got, want = found(ann.nearest(table(spark, rows))), brute(rows)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95


def test_equal_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    one, two = [1.0, 0.0, 0.5], [0.0, 1.0, 0.25]
    rows = [(i, one if i % 3 else two) for i in range(400)]
    assert found(ann.nearest(table(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [1.0, None]), (120, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, -0.0])]
    clash = table(spark, rows).selectExpr("*", "1 AS cell", "2 AS part", "vec_id AS query", "embedding AS vector")
    got = found(ann.nearest(clash))
    assert got == {0: [(1, 4.0), (2, -1.0)]}
    assert ann.nearest(table(spark, rows).where("false")).collect() == []
    assert ann.nearest(table(spark, [(0, [1.0])])).collect() == []
    assert ann.nearest(table(spark, [(3, [1.0]), (7, [2.0])])).collect() == []


def test_chi_square_stop():
    assert ann.chi_square_share(7.344, 8) == pytest.approx(0.5, abs=1e-3)
    assert ann.stop_factor(0.05, 8) == pytest.approx(15.507, abs=1e-2)


def test_tree_bounds_the_distance_of_its_leaves():
    rng = np.random.default_rng(1)
    points, queries = rng.standard_normal((500, ann.DIMENSIONS)), rng.standard_normal((7, ann.DIMENSIONS))
    tree = ann.KdTree(points)
    assert sorted(np.concatenate(tree.rows).tolist()) == list(range(500)) and max(map(len, tree.rows)) <= ann.LEAF
    for i, row in enumerate(tree.distances(queries)):
        for bound, rows in zip(row, tree.rows):
            assert (((points[rows] - queries[i]) ** 2).sum(axis=1) >= bound - 1e-12).all()


def test_search_stops_early_on_clusters():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 16)) * 4
    x = centres[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 16))
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    places = x @ ann.projection(17)[:-1]
    tree = ann.KdTree(places)
    asked = []
    real = np.einsum
    try:
        np.einsum = lambda how, q, v: (asked.append(len(q) * len(v)), real(how, q, v))[1]
        owner, scores, ids = ann.search(tree, x, np.arange(4000), x[:50], places[:50], np.full(50, np.inf), np.full(50, 2.0))
    finally:
        np.einsum = real
    exact = np.argsort(-(x[:50] @ x.T), axis=1)[:, :20]
    hit = np.mean([len(set(ids[owner == i]) & set(exact[i])) / 20 for i in range(50)])
    assert hit >= 0.95 and sum(asked) < 0.5 * 50 * 4000


def test_cells_within_a_ball():
    rng = np.random.default_rng(2)
    points = rng.standard_normal((800, ann.DIMENSIONS))
    cells = ann.Cells(points, 16)
    cell = cells.of(points)
    assert cells.count == 16
    for q in rng.standard_normal((10, ann.DIMENSIONS)):
        near = ((points - q) ** 2).sum(axis=1) <= 4.0
        assert set(cell[near].tolist()) <= set(cells.within(q, 4.0))


def test_stop_loses_two_percent_of_neighbours_at_most():
    assert ann.chi_square_share(ann.stop_factor()) >= 0.98 - 1e-9
    # Differences of vectors, as the projection in use places them.
    gaps = np.random.default_rng(6).standard_normal((50_000, 65))
    ratio = ((gaps @ ann.projection(65)) ** 2).sum(axis=1) / (gaps**2).sum(axis=1)
    assert np.mean(ratio > ann.stop_factor()) <= 0.02
