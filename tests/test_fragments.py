"""Fragments from a table, and hashes of files in ranges."""

from __future__ import annotations

import hashlib
import random

import pytest

from lakeward.operators import enrich, sizing
from lakeward.operators.enrich import fragment_matches
from lakeward.sources.files import content_hashes
from tests.conftest import plan_of, rows_of


def plain(names, entries, longest):
    out = []
    for i, name in names:
        held = [e for e in entries if name is not None and e[0] is not None and e[0] in name]
        held.sort(key=lambda e: (-len(e[0]) if longest else 0, e[2] is None, e[2] or 0, e[0], e[1]))
        out.append((i, name, held[0][1] if held else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("longest", [False, True])
@pytest.mark.parametrize("empty", [False, True])
def test_equals_looking_at_all(spark, longest, empty):
    rng = random.Random(3)
    word = lambda least, most: "".join(rng.choices("abcé", k=rng.randint(least, most)))
    names = [(i, word(0, 9)) for i in range(300)] + [(300, None), (301, ""), (302, "abc" * 2_000), (303, "same"), (304, "same")]
    entries = [(word(1, 5), f"t{i}", rng.choice([1, 2, 3, None])) for i in range(150)] + [(None, "no", 0), ("sam", "s", 9), ("same", "l", 9)]
    if empty:
        entries += [("", "any", 2), ("", "later", 3)]
    left = spark.createDataFrame(names, "i int, nome string")
    right = spark.createDataFrame(entries, "fragment string, target string, priority int")
    found = fragment_matches(left, "nome", right, longest=longest)
    assert found.columns == ["i", "nome", "match"] and rows_of(found) == plain(names, entries, longest)


def test_no_fragments_and_no_names(spark):
    names = spark.createDataFrame([(1, "a")], "i int, nome string")
    none = spark.createDataFrame([], "fragment string, target string, priority int")
    assert rows_of(fragment_matches(names, "nome", none)) == [(1, "a", None)]
    assert fragment_matches(names.where("false"), "nome", none).collect() == []


def test_no_name_meets_all_fragments(spark):
    names = spark.range(2000).selectExpr("cast(id as string) as nome")
    entries = spark.range(2000).selectExpr("concat(id, 'x') as fragment", "id as target", "id as priority")
    plan = plan_of(fragment_matches(names, "nome", entries))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_names_meet_only_what_they_hold(spark, monkeypatch):
    """Twice the names and fragments, of few different letters, are twice the rows in every join."""
    counts = []
    real = enrich.join_small
    monkeypatch.setattr(enrich, "join_small", lambda *a, **k: (found := real(*a, **k), counts.append(found.count()))[0])

    def most(n):
        counts.clear()
        names = spark.range(n).selectExpr("concat('file/', id % 25, '/', id) as nome")
        entries = spark.range(n).selectExpr("concat(id % 25, '/', id div 10) as fragment", "cast(id as string) as target", "id as priority")
        assert fragment_matches(names, "nome", entries).where("match is not null").count() > n // 30
        return max(counts)

    few, many = most(3_000), most(12_000)
    assert many < 6 * few and many < 30 * 12_000


@pytest.mark.parametrize("longest", [False, True])
def test_long_names_in_blocks_and_shuffled_joins(spark, monkeypatch, longest):
    monkeypatch.setattr(enrich, "BLOCK", 5)
    monkeypatch.setattr(enrich, "TASK_LETTERS", 300)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    rng = random.Random(5)
    word = lambda least, most: "".join(rng.choices("ab\n\U0001f600\U0001f601?", k=rng.randint(least, most)))
    names = [(i, word(0, 40)) for i in range(120)] + [(200, None), (201, ""), (202, "b"), (203, "ab")]
    entries = [(word(1, 16), f"t{i}", rng.choice([1, 2, None])) for i in range(200)] + [("", "any", 5)]
    entries += [(name[2:30], f"u{i}", 1) for i, name in names[:40] if name[2:]] + [("b" * 60, "never", 0)]
    left = spark.createDataFrame(names, "i int, nome string")
    right = spark.createDataFrame(entries, "fragment string, target string, priority int")
    assert rows_of(fragment_matches(left, "nome", right, longest=longest)) == plain(names, entries, longest)


def test_hashes_of_ranges(spark, tmp_path):
    data = {"small": b"123", "even": bytes(range(200)), "large": random.Random(1).randbytes(1000), "other": b"x" * 1000}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    md5 = lambda b: hashlib.md5(b).hexdigest()

    def want(content):
        parts = [content[i : i + 100] for i in range(0, len(content), 100)]
        return md5(content) if len(parts) < 2 else md5("".join(map(md5, parts)).encode()) + f"-{len(parts)}"

    found = {r["name"]: r["md5"] for r in content_hashes(spark, str(tmp_path), range_bytes=100).collect()}
    assert found == {n: want(c) for n, c in data.items()}
    whole = {r["name"]: r["md5"] for r in content_hashes(spark, str(tmp_path)).collect()}
    assert whole == {n: md5(c) for n, c in data.items()}
    # One changed byte in the last range, in the same size.
    (tmp_path / "large").write_bytes(data["large"][:-1] + b"?")
    again = {r["name"]: r["md5"] for r in content_hashes(spark, str(tmp_path), range_bytes=100).collect()}
    assert [n for n in found if found[n] != again[n]] == ["large"]
