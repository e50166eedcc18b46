from __future__ import annotations

import pytest

import corpus_pipeline
from lakeward.llm import mixing, simhash, substrings, toxicity
from tests.llm import brute
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """What each stage wrote, after the documents themselves."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out.append(docs)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_and_their_columns(written):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "source_mix", "packing"]
    assert all(df.columns == written[0].columns for df in written[1:-1])


def test_toxic_documents_go(spark, written):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rejected = {r["doc_id"] for r in toxicity.toxicity(written[0], labels).collect() if r["predicted"]}
    assert sorted(pairs(written[1])) == sorted(p for p in pairs(written[0]) if p[0] not in rejected)


def test_one_document_of_each_component_stays(written):
    before = pairs(written[1])
    first = {c for _, _, c in brute.components(before)}
    assert sorted(pairs(written[2])) == sorted(p for p in before if p[0] in first)


def test_repeated_passages_go(written):
    before, after = dict(pairs(written[2])), dict(pairs(written[3]))
    assert set(before) == set(after)
    for doc_id, _, gone, _ in brute.kept(list(before.items())):
        if gone:
            assert len(after[doc_id].split()) == len(before[doc_id].encode().split()) - gone
        else:
            assert after[doc_id] == before[doc_id]


def test_sources_are_mixed(written):
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(written[3]).collect() if r["taken"]}
    counts = {r["doc_id"]: r["count"] for r in written[4].where("text != ''").groupBy("doc_id").count().collect()}
    assert counts == taken


def test_all_is_packed(written):
    rows = written[5].groupBy("doc_id").sum("length").collect()
    assert {r["doc_id"] for r in rows} == {d for d, _ in pairs(written[4])}


def test_run_equals_its_stages(spark, written):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == written[-1].columns
    size = lambda df: df.selectExpr("count(*)", "sum(length)", "sum(cast(ids_crc32 as decimal(38)) )").first()
    assert size(got)[1] == size(written[-1])[1]


def test_empty_documents(spark, written, tmp_path):
    empty = written[0].where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, empty, SF_DIR)
    assert empty.collect() == []
    assert simhash.near_dedup(empty).collect() == substrings.remove_repeats(empty).collect() == []


def test_repeated_rows_and_rows_without_id_pass_all_stages(spark, written, tmp_path):
    some = written[0].where("doc_id < 60")
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4
    odd = spark.createDataFrame(
        [(None, text, "en", None, 1)] * 12 + [(5001, "one two three four", None, "s", 1)] * 9 + [(None, None, None, None, None), (5002, "", "en", "s", 0), (5003, None, "en", "s", 0)],
        written[0].schema,
    )
    docs = some.unionByName(odd)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
    assert kept["toxicity"].where("doc_id = 5001").count() == 9
    assert kept["near_duplicates"].where("doc_id = 5001").count() >= 1
    texts = {r["text"] for r in kept["near_duplicates"].collect()}
    assert {"one two three four", text} <= texts
    # A row is taken as a whole, at most twice, and rows of one id alike.
    counted = kept["source_mix"].groupBy("doc_id", "text").count().collect()
    before = {(r["doc_id"], r["text"]): r["count"] for r in kept["repeated_passages"].groupBy("doc_id", "text").count().collect()}
    assert all(r["count"] in (before[r["doc_id"], r["text"]], 2 * before[r["doc_id"], r["text"]]) for r in counted)
    pieces = kept["packing"].groupBy("sequence_id").sum("length").collect()
    assert pieces and all(r[1] <= 2048 for r in pieces)
