from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import zlib

from lakeward.llm import toxicity
from lakeward.llm.noisy import CLASSES, character_model, classes_of, decode, lattice, restored, tokens

BAD = ["idiot", "moron", "stupid", "trash", "pathetic", "loser"]
GOOD = "the of and to in is was that for with on are this be have from word house river garden green yellow paper window".split()


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(GOOD, k=rng.randint(20, 80))
        bad = i % 6 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark, make_docs):
    docs, labels = corpus()
    model = toxicity.fit(make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return model


def test_held_out_documents_are_told_apart(spark, make_docs):
    docs, labels = corpus()
    rows = toxicity.toxicity(make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r["predicted"] == labels[r["doc_id"]][2] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


@pytest.mark.parametrize(
    ("written", "meant"),
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"), ("stuuupid", "stupid"), ("tr@sh!!!", "trash"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("iiddiioott", "idiot"), ("p@th3t1c", "pathetic"), ("l-o-s-e-r", "loser")],
)
def test_disguised_words_are_restored_and_scored(fitted, written, meant):
    assert [w for t in tokens(written) for w in restored(t, fitted.costs)] == [meant]
    summary = toxicity.Summary(fitted.weights, fitted.costs)
    text = f"the house is {written} and the river was green"
    plain = "the house is green and the river was yellow"
    shown, clean = fitted.score(summary.of([text, plain]))
    assert shown > 0.5 > clean


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("!diot", "idiot"), ("$$tupid", "stupid"), ("+rash", "trash"), ("(!diot)", "idiot"), ("i\td\ti\to\tt", "idiot"), ("i  d  i  o  t", "idiot"),
        ("what-an-1d10t-the-house-is-that-was-for-the-river-and-the-garden", "idiot"), ("i.d.i.o.t." * 8, "idiot"), ("m0r0n" + "x" * 2 + "yzw" * 30, "moron"),
    ],
)
def test_disguises_at_edges_apart_and_in_long_tokens(fitted, written, meant):
    read = [w for t in tokens(written) for w in restored(t, fitted.costs)]
    assert any(meant in w for w in read)
    assert len(read) < 100


def brute(token, costs):
    """Cost of the best path, by going through all."""
    best = np.inf
    for path in itertools.product(*lattice(token), [(" ", 0.0)]):
        x, y, total = 0, 0, 0.0
        for emitted, extra in path:
            total += extra
            for z in classes_of(emitted) if emitted else []:
                total += float(costs[x, y, z])
                x, y = y, int(z)
        best = min(best, total)
    return best


@pytest.mark.parametrize("token", ["1d10t", "$$h1t", "s.t-u_p", "llool", "|i|l", "a", "tr@@@sh!!", "i d i"])
def test_the_decoded_path_is_the_best_of_all(fitted, token):
    text = decode(token, fitted.costs)
    options = [*lattice(token), [(" ", 0.0)]]
    mine = min(
        sum(e for _, e in path) + lm(path, fitted.costs)
        for path in itertools.product(*options)
        if "".join(t for t, _ in path) == text
    )
    assert mine == pytest.approx(brute(token, fitted.costs), abs=1e-4)


def lm(path, costs):
    x, y, total = 0, 0, 0.0
    for z in classes_of("".join(t for t, _ in path)):
        total += float(costs[x, y, z])
        x, y = y, int(z)
    return total


def test_a_repeated_id_brings_one_row_to_the_driver(spark, make_docs):
    docs = make_docs([(7, f"the house {i}") for i in range(500)] + [(i, "idiot house") for i in range(100, 160)])
    labels = spark.createDataFrame([(7, 1, 0)] + [(i, 1, 1) for i in range(100, 160)], "doc_id long, quality int, toxic int")
    seen = []
    logistic = toxicity._logistic
    toxicity._logistic = lambda x, y: seen.append(len(y)) or logistic(x, y)
    try:
        toxicity.fit(docs, labels)
    finally:
        toxicity._logistic = logistic
    assert seen[0] <= 61


def test_plain_words_and_numbers_stay(fitted):
    read = {word: restored(word, fitted.costs) for word in ["garden", "house's", "2024", "3.14", "and/or", "***", "(window)."]}
    assert read == {
        "garden": ["garden"], "house's": ["house", "s"], "2024": [], "3.14": ["3", "14"], "and/or": ["and", "or"], "***": [], "(window).": ["window"],
    }


def test_language_model_is_a_distribution_over_all_documents(spark, make_docs):
    costs = character_model(make_docs([(1, "aab"), (2, None), (3, "")]))
    assert costs.shape == (CLASSES,) * 3
    assert np.allclose(np.exp(-costs.astype(float)).sum(axis=2), 1, atol=1e-4)
    assert costs[0, 1, 1] < costs[0, 1, 2]  # after the first a comes a, not b


def test_odd_rows(spark, make_docs):
    docs, labels = corpus(120)
    odd = [(1000, None), (1001, ""), (None, "you idiot moron"), (0, docs[0][1]), (1002, "x" * 200_000), (1003, "a b c " * 5000), (1004, "퟿\U0001f600")]
    labelled = spark.createDataFrame([*labels, (None, 1, 1), (1001, 1, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    table = make_docs([*docs, *odd])
    rows = toxicity.toxicity(table.withColumn("score", table.lang), labelled).collect()
    assert len(rows) == len(docs) + len(odd)
    assert all(r["score"] is not None for r in rows)
    assert toxicity.toxicity(table.where("false"), labelled).collect() == []
    none = toxicity.toxicity(table, labelled.where("false")).collect()
    assert len(none) == len(rows) and not any(r["predicted"] for r in none)
    kept = toxicity.without_toxic(table, labelled)
    assert kept.columns == table.columns
