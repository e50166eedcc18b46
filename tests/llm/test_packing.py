from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeward.llm import packing
from lakeward.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.encode_special_tokens = True
    return out


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, tokenizer):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    padding = total = 0
    for spans in by_sequence.values():
        spans.sort()
        assert all(o == sum(n for _, n in spans[:i]) for i, (o, _) in enumerate(spans))
        n = sum(n for _, n in spans)
        assert 0 < n <= packing.CONTEXT
        total += n
        padding += 0 if n & (n - 1) == 0 else packing.CONTEXT - n
    texts = {}
    for doc_id, text in docs:
        texts.setdefault(doc_id, []).append(ids_of(tokenizer, text))
    assert set(texts) == set(by_doc)
    for doc_id, copies in texts.items():
        pieces = sorted((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc_id])
        assert sum(p[2] for p in pieces) == sum(map(len, copies))
        if len(copies) == 1:
            ids = np.array(copies[0], "<u4")
            at = 0
            for n, start, length, crc in pieces:
                assert (n, start) == (len(ids), at)
                assert crc == zlib.crc32(ids[at : at + length].tobytes())
                at += length
    return padding / max(1, total + padding)


def test_whole_table_round_trip(spark, documents, tokenizer):
    assert check(QUERIES["op8_packing"](spark, SF_DIR).collect(), documents, tokenizer) < 0.02


def test_odd_rows(spark, make_docs, tokenizer):
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "x" * 30_000), (5, "word " * 20_000), (None, "one"), (7, "two"), (7, "two"), (1 << 60, "\U0001f600́  \t\n")]
    docs = make_docs(rows)
    assert check(packing.packed(docs.withColumn("start", docs.lang)).collect(), rows, tokenizer) < 0.05
    assert packing.packed(docs.where("false")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer_file(text):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not _kept else _kept[0]
    own.encode_special_tokens = True
    _kept[:] = [own]
    assert packing._encoding(packing.VOCABULARY)[0].encode_to_numpy(text, disallowed_special=()).tolist() == own.encode(text, add_special_tokens=False).ids


_kept: list = []


def test_windows_are_the_cheapest(monkeypatch):
    monkeypatch.setattr(packing, "CONTEXT", 16)
    monkeypatch.setattr(packing, "WHOLE", (4, 8))
    rng = np.random.default_rng(2)
    for _ in range(60):
        at = np.unique(np.concatenate((np.arange(5, 40, 5), rng.integers(1, 40, 4), [40])))
        cost = rng.integers(0, 5, len(at)).astype(float)
        price = {0: 0.0} | dict(zip(at.tolist(), cost.tolist()))

        def total(cuts):
            spans = [b - a for a, b in itertools.pairwise([0, *cuts])]
            if max(spans) > 16:
                return float("inf")
            return sum(price[c] + packing.WINDOW_COST for c in cuts) + sum(0 if n in (4, 8, 16) else 16 - n for n in spans)

        best = min(total([*inner, 40]) for k in range(len(at)) for inner in itertools.combinations(at[:-1].tolist(), k))
        assert total(packing.windows(at, cost)) == best
