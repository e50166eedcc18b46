from __future__ import annotations

import random

import numpy as np

from lakeward.llm import quality

WORDS = "river house green window paper street garden music number letter".split()


def tables(spark, make_docs, n=400):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = " ".join(rng.choices(WORDS, k=60)) if good else " ".join(rng.choices(["$$", "click", "buy", "##"], k=60))
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_bags_equal_a_plain_count():
    texts = [b"One two one", b"", b"  two\tONE ", b"x"]
    owner, bucket = quality.grams(texts)
    assert np.bincount(owner, minlength=4).tolist() == [5, 0, 3, 1]
    by_text = [bucket[owner == i].tolist() for i in range(4)]
    words = {"one": by_text[0][0], "two": by_text[0][1]}
    assert by_text[0][:3] == [words["one"], words["two"], words["one"]]
    assert by_text[2][:2] == [words["two"], words["one"]]
    assert by_text[2][2] == by_text[0][4]  # the pair (two, one)


def test_target_like_documents_are_drawn(spark, make_docs):
    docs, table, labels = tables(spark, make_docs)
    drawn = quality.resample(table, labels).collect()
    good = sum(r["doc_id"] % 4 != 0 for r in drawn)
    assert good >= 0.95 * len(drawn)
    assert len(drawn) == len({r["doc_id"] for r in drawn})
    half = quality.resample(table, labels, share=0.5).collect()
    assert len(half) == 200
    lowest = min(r["key"] for r in half)
    assert {r["doc_id"] for r in half} <= {r["doc_id"] for r in drawn}
    assert all(r["key"] <= lowest for r in drawn if r["doc_id"] not in {h["doc_id"] for h in half})


def test_noise_is_gumbel(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(quality.gumbel(quality.F.col("id"))).collect()])
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.var() - np.pi**2 / 6) < 0.08


def test_odd_rows(spark, make_docs):
    docs, table, labels = tables(spark, make_docs, 40)
    odd = make_docs([(100, None), (101, ""), (None, "river house"), (1, docs[1][1]), (102, "word " * 40_000)])
    full = table.unionByName(odd).withColumn("key", table.lang).withColumn("wanted", table.lang)
    assert len(quality.resample(full, labels, share=1.0).collect()) == 45
    assert quality.resample(full.where("false"), labels).collect() == []
    assert quality.resample(full, labels.where("quality = 0")).collect() == []
    assert quality.resample(full, labels.where("false")).collect() == []
