from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.llm import collocations as co
from tests.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def counts(texts):
    found = Counter()
    for text in texts:
        for w in pieces(text):
            for d in range(1, 5):
                found.update(tuple(w[i : i + d]) for i in range(len(w) - d + 1))
    return found


def want(docs, least, shown=2000):
    """The contract in plain Python: docs are (lang, text)."""
    out = []
    for lang in {lang for lang, _ in docs}:
        f = counts([t for own, t in docs if own == lang])
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        covered = set()
        for p, c in candidates.items():
            for d in range(2, len(p)):
                for i in range(len(p) - d + 1):
                    if 100 * c >= 80 * f[p[i : i + d]]:
                        covered.add(p[i : i + d])
        rows = []
        for p, a in candidates.items():
            if p not in covered:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [("und" if lang is None else lang, i, p, a, le, r, n, s) for i, (s, a, p, le, r) in enumerate(rows[:shown], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocabulary = ["the", "The", "of", "a", "New", "York", "é", "b", "x\x00y", "c\x1c", "Ärger"]
    out = []
    for i in range(300):
        words = [w + rng.choice(["", "", "", ".", ",", " \t", "\n"]) for w in rng.choices(vocabulary, [9, 5, 5, 4, 3, 3, 1, 1, 1, 1, 1], k=rng.randint(0, 40))]
        out.append((rng.choice(["en", "en", "de", None, ""]), " ".join(words)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(lang, text, 0) for lang, text in rows], "lang string, text string, phrase int")


def test_equals_the_plain_version(spark, texts):
    rows = rows_of(co.collocations(table(spark, texts).repartition(5), least=8))
    assert rows == want(texts, 8) and len(rows) > 20


def test_ranks_are_cut_per_language(spark, texts):
    assert rows_of(co.collocations(table(spark, texts), least=8, shown=3)) == want(texts, 8, 3)


@pytest.mark.parametrize("limit", [1, 100])
def test_large_buckets_are_dealt_anew(spark, texts, monkeypatch, limit):
    """Buckets of any size give the same counts: with a limit of 1 every suffix goes through all levels."""
    monkeypatch.setattr(co, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(co, "TOO_MANY", limit)
    phrases, _ = co.phrase_counts(table(spark, texts).na.fill("und", ["lang"]).select("lang", "text"), 8)
    found = {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in phrases.collect()}
    expected = {}
    for lang in {lang for lang, _ in texts}:
        name = "und" if lang is None else lang
        expected |= {(name, p): c for p, c in counts([t for own, t in texts if own == lang]).items() if c >= 8}
    assert found == expected and phrases.count() == len(found)


def test_several_blocks_in_a_task(spark, texts, monkeypatch):
    monkeypatch.setattr(co, "BLOCK_BYTES", 400)
    monkeypatch.setattr(co, "BUCKET_BYTES", 3000)
    docs = texts * 3
    assert rows_of(co.collocations(table(spark, docs).repartition(4), least=30)) == want(docs, 30)


def test_odd_rows(spark):
    rows = [("en", None), (None, None), ("en", ""), ("en", " \t\n .,;"), ("en", "one"), (None, "a b " * 20_000), ("", "q " * 500), ("en", "y" * 100_000)]
    rows += [("fr", "l'été est là")] * 31
    assert rows_of(co.collocations(table(spark, rows))) == want(rows, 30)
    assert co.collocations(table(spark, rows).where("false")).collect() == []
    assert co.collocations(table(spark, rows[:5])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=9), min_size=1, max_size=30), st.integers(1, 4), st.sampled_from([4, 1 << 12]))
def test_quicksort_finds_all_frequent_prefixes(words, least, small):
    co.SMALL, kept = small, co.SMALL
    try:
        word = np.array(list(itertools.chain.from_iterable([*w, 0] for w in words)), np.int32)
        columns = co.suffixes_of(word)
        columns, weights = co.combined(columns, np.ones(columns.shape[1], np.int64))
        found = {tuple(columns[:d, at].tolist()): f for at, d, f in co.frequent(columns, weights, least)}
    finally:
        co.SMALL = kept
    expected = Counter(tuple(w[i : i + d]) for w in words for d in range(1, 5) for i in range(len(w) - d + 1))
    assert found == {p: c for p, c in expected.items() if c >= least}


def test_scores_beyond_64_bits(spark):
    big = 1 << 61
    phrases = spark.createDataFrame(
        [("en", 1, "a", big + 1), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 5), ("en", 3, "a b c", big // 5 * 4), ("en", 1, "c", big), ("en", 2, "b c", big)],
        "lang string, depth int, phrase string, f long",
    )
    kept = co.uncovered(phrases.where("depth > 1"))
    # 100 * f(a b c) is below 80 * f(b c), but not below 80 * f(a b): exact only beyond 64 bits.
    assert sorted(r["phrase"] for r in kept.collect()) == ["a b c", "b c"]
    rows = {r["phrase"]: r for r in co.scored(phrases.where("depth > 1"), phrases).collect()}
    assert rows["a b"]["score"] == 2_000_000 * (big - 5) // (2 * big + 8)
    low = min((2_000_000 * (big // 5 * 4) // (x + y), k, x, y) for k, x, y in [(1, big + 1, big), (2, big - 5, big)])
    assert (rows["a b c"]["score"], rows["a b c"]["l"], rows["a b c"]["r"]) == (low[0], low[2], low[3])
