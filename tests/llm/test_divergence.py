from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest

from lakeward.llm import divergence as dv
from tests.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def want(docs, least, shown=50):
    """The contract in plain Python: docs are (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(TERM, (text or "").translate(LOWER))) for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted(t for t, n in held.items() if n >= least)
        v = len(kept)
        groups = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            groups[s].update(t for t in terms if held[t] >= least)
        together = sum(groups.values(), Counter())

        def shares(count):
            n = sum(count.values())
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (n + 5 * v) for t in kept}

        usual, p = shares(together), {s: shares(c) for s, c in groups.items()}
        for s, count in groups.items():
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(p[s][t] - usual[t], t) for t in kept if count[t] and p[s][t] > usual[t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, shown)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(rows[:most], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(7)
    words = ["The", "the,", "(the)", "of", "Of-the", "été", "Été", "x1y", "don't", "…dots…", "a_b", "12", "--", "z\x00z", "rare"]
    out = []
    for _ in range(400):
        text = rng.choice([" ", "\n", "\t\x0b "]).join(rng.choices(words, [5, 3, 2, 4, 2, 3, 2, 2, 2, 1, 1, 2, 1, 1, 0.1], k=rng.randint(0, 12)))
        out.append((rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "B", None, "", "é"]), text))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "c") for r in rows], "lang string, source string, text string, chunk string")


@pytest.mark.parametrize("least", [1, 5, 30])
def test_equals_the_plain_version(spark, docs, least):
    rows = rows_of(dv.divergence(table(spark, docs).repartition(6), least))
    assert rows == want(docs, least) and len(rows) > 30


def test_terms_that_only_documents_decide(spark, docs, monkeypatch):
    """The bounds of the chunks leave terms open: some are then kept, some are not."""
    monkeypatch.setattr(dv, "BUCKET_BYTES", 500)
    df = table(spark, docs).na.fill("", ["lang", "source"]).repartition(7)
    held = Counter((lang or "", t) for lang, _, text in docs for t in set(re.findall(TERM, text.translate(LOWER))))
    assert dv.terms_of("Of-the…THE".encode()) == {"of": 1, "the…the": 1}
    for least in (5, 20, 40, 60):
        blocks, buckets = dv.chunk_counts(df, least)
        assert buckets > 10
        kept = dv.term_counts(blocks, buckets, least).select("lang", "term").distinct()
        assert rows_of(kept) == sorted((k for k, n in held.items() if n >= least), key=repr)


def test_several_blocks_and_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK_BYTES", 300)
    monkeypatch.setattr(dv, "BUCKET_BYTES", 700)
    assert rows_of(dv.divergence(table(spark, docs).repartition(3), 5)) == want(docs, 5)


def test_blocks_need_little_memory(monkeypatch):
    """A task holds one block and one text at a time, not all texts of a batch."""
    monkeypatch.setattr(dv, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(6_000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 6_000, "source": ["a", "b"] * 3_000, "text": texts})
    del texts
    tracemalloc.start()
    rows = sum(out.num_rows for out in dv._chunks(30, 4)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4 * -(-batch.column("text").nbytes // dv.BLOCK_BYTES) and peak < 80_000_000, peak


def test_few_terms_are_shown(spark, docs):
    assert rows_of(dv.divergence(table(spark, docs), 5, shown=2)) == want(docs, 5, 2)


def test_many_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(dv, "CELLS", 7)
    assert rows_of(dv.divergence(table(spark, docs), 5)) == want(docs, 5)


def test_odd_rows(spark):
    rows = [("en", "a", None), (None, None, None), ("en", "b", ""), ("en", "b", "1 2 3 ."), ("en", "c", "word " * 50_000), ("de", "x", "y" * 100_000), ("de", "z", "y")]
    rows += [("fr", "a", "mot")] * 31 + [("fr", "", "\U0001f600mot")] * 30
    assert rows_of(dv.divergence(table(spark, rows))) == want(rows, 30)
    assert rows_of(dv.divergence(table(spark, rows), 1)) == want(rows, 1)
    assert dv.divergence(table(spark, rows).where("false")).collect() == []


def test_shares_beyond_64_bits(spark):
    big = 1 << 61
    row = spark.range(1).select(dv._share(dv.F.lit(big), dv.F.lit(big + 12345), dv.F.lit(17)).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * (big + 5) // (big + 12345 + 85)
